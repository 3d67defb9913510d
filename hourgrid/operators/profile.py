"""Data-quality profile of one raw source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.calendar import (
    LocalWindow,
    hour_of_number,
    hour_series,
    ntz,
    utc_hour_number,
)
from hourgrid.functions.scoring import count_where, rounded, special_dimension
from hourgrid.operators.classify import SPECIAL, SpecialValues, time_disposition
from hourgrid.session import require_utc


def raw_states(
    events: DataFrame,
    window: LocalWindow,
    ts_col: str = "pickup_ts",
    zone_col: str = "zone_raw",
    month_col: str | None = None,
) -> DataFrame:
    """Mergeable state of all raw rows: count, first and last time of each cell.

    A cell is a raw zone, a local hour, the UTC hour or the label that the timestamp
    decides, and the source month. Every section of the profile and the aggregation
    fold these cells, so raw events are read once. Cells are combined before the
    exchange, and there are never more of them than rows.
    """
    require_utc(events.sparkSession)
    ts = F.col(ts_col).cast("timestamp_ntz")
    month = F.lit(window.label) if month_col is None else F.col(month_col)
    rejected = time_disposition(ts, window, None if month_col is None else month)
    return (
        events.select(
            F.col(zone_col).alias("zone_raw"),
            ts.alias("ts"),
            F.date_trunc("hour", ts).cast("timestamp_ntz").alias("pickup_hour"),
            rejected.alias("rejected"),
            F.when(rejected.isNull(), utc_hour_number(ts, window)).alias("hour_number"),
            month.alias("source_month"),
        )
        .groupBy("zone_raw", "pickup_hour", "rejected", "hour_number", "source_month")
        .agg(
            F.count("*").alias("cell_rows"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


def _inside(window: LocalWindow):
    """Cells whose hour lies in the window; windows begin and end at whole hours."""
    return (F.col("pickup_hour") >= ntz(window.start)) & (F.col("pickup_hour") < ntz(window.end))


def profile_of_states(states: DataFrame, window: LocalWindow) -> DataFrame:
    """raw_profile from raw_states."""
    hour, start, end = F.col("pickup_hour"), ntz(window.start), ntz(window.end)

    def rows(condition=None):
        hit = F.col("cell_rows") if condition is None else F.when(condition, F.col("cell_rows"))
        return F.coalesce(F.sum(hit), F.lit(0))

    by_zone = states.groupBy("zone_raw").agg(
        rows().alias("total_rows"),
        rows(hour.isNull()).alias("pickup_null_rows"),
        F.min("first_ts").alias("pickup_min"),
        F.max("last_ts").alias("pickup_max"),
        rows(hour < start).alias("before_month_rows"),
        rows(hour >= end).alias("after_month_rows"),
        rows((hour >= start) & (hour < end)).alias("within_month_rows"),
    )

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return by_zone.agg(
        total("total_rows"),
        total("pickup_null_rows"),
        F.coalesce(F.sum(F.when(F.col("zone_raw").isNull(), F.col("total_rows"))), F.lit(0)).alias(
            "zone_null_rows"
        ),
        F.min("pickup_min").alias("pickup_min"),
        F.max("pickup_max").alias("pickup_max"),
        total("before_month_rows"),
        total("after_month_rows"),
        total("within_month_rows"),
        F.count("zone_raw").alias("distinct_raw_zone_ids"),
    )


def zones_of_states(
    states: DataFrame, lookup: DataFrame, window: LocalWindow, special: SpecialValues = SPECIAL
) -> DataFrame:
    """zone_cells from raw_states."""
    counted = (
        states.where(_inside(window))
        .groupBy(F.col("zone_raw").cast("int").alias("raw_zone_id"))
        .agg(F.sum("cell_rows").alias("zone_rows"))
    )
    return _with_dimension(counted, lookup, special)


def hours_of_states(states: DataFrame, window: LocalWindow) -> DataFrame:
    """hourly_coverage from raw_states."""
    inside = states.where(_inside(window)).groupBy("pickup_hour")
    return inside.agg(F.sum("cell_rows").alias("rows"))


def time_cells_of_states(states: DataFrame) -> DataFrame:
    """Cells of classify.time_cells from raw_states."""
    zone = F.when(F.col("rejected").isNull(), F.col("zone_raw").cast("int"))
    keys = {
        "zone_missing": zone.isNull(),
        "zone_id": F.coalesce(zone, F.lit(0)),
        "hour_number": F.col("hour_number"),
        "rejected": F.col("rejected"),
        "source_month": F.col("source_month"),
    }
    return (
        states.select(*[c.alias(name) for name, c in keys.items()], "cell_rows")
        .groupBy(*keys)
        .agg(F.sum("cell_rows").alias("cell_rows"))
        .withColumn("target_hour_utc", hour_of_number(F.col("hour_number")))
        .drop("hour_number")
    )


def raw_profile(
    events: DataFrame,
    window: LocalWindow,
    ts_col: str = "pickup_ts",
    zone_col: str = "zone_raw",
) -> DataFrame:
    """One row: totals, NULLs, time range, rows before/after/within, distinct zones."""
    ts = F.col(ts_col).cast("timestamp_ntz")
    start, end = ntz(window.start), ntz(window.end)
    return events.agg(
        F.count("*").alias("total_rows"),
        count_where(ts.isNull()).alias("pickup_null_rows"),
        count_where(F.col(zone_col).isNull()).alias("zone_null_rows"),
        F.min(ts).alias("pickup_min"),
        F.max(ts).alias("pickup_max"),
        count_where(ts < start).alias("before_month_rows"),
        count_where(ts >= end).alias("after_month_rows"),
        count_where((ts >= start) & (ts < end)).alias("within_month_rows"),
        F.count_distinct(F.col(zone_col)).alias("distinct_raw_zone_ids"),
    )


def in_window(events: DataFrame, window: LocalWindow, ts_col: str) -> DataFrame:
    ts = F.col(ts_col).cast("timestamp_ntz")
    return events.where((ts >= ntz(window.start)) & (ts < ntz(window.end)))


def zone_cells(
    events: DataFrame,
    lookup: DataFrame,
    window: LocalWindow,
    ts_col: str = "pickup_ts",
    zone_col: str = "zone_raw",
    special: SpecialValues = SPECIAL,
) -> DataFrame:
    """In-window rows per raw zone, with the lookup columns of that zone.

    Counted before the join: the lookup meets one row per zone.
    """
    counted = (
        in_window(events, window, ts_col)
        .groupBy(F.col(zone_col).cast("int").alias("raw_zone_id"))
        .agg(F.count("*").alias("zone_rows"))
    )
    return _with_dimension(counted, lookup, special)


def _with_dimension(counted: DataFrame, lookup: DataFrame, special: SpecialValues) -> DataFrame:
    dimension = lookup.where(F.col("zone_id").isNotNull()).select(
        F.col("zone_id").alias("lookup_zone_id"),
        "borough",
        "zone_name",
        special_dimension(special).alias("is_special"),
    )
    return counted.join(dimension, F.col("raw_zone_id") == F.col("lookup_zone_id"), "left")


def zone_profile(cells: DataFrame) -> DataFrame:
    """One row of lookup-match counts over zone_cells; no daylight-saving filter here."""
    matched = F.col("lookup_zone_id").isNotNull()
    special = F.coalesce("is_special", F.lit(False))

    def rows(condition) -> F.Column:
        return F.coalesce(F.sum(F.when(condition, F.col("zone_rows"))), F.lit(0))

    return cells.agg(
        rows(F.col("raw_zone_id").isNull()).alias("null_zone_rows"),
        rows(F.col("raw_zone_id").isNotNull() & ~matched).alias("not_in_lookup_rows"),
        rows(matched).alias("lookup_matched_rows"),
        rows(matched & special).alias("non_service_zone_rows"),
        rows(matched & ~special).alias("retained_rows"),
        F.count_distinct(F.when(matched & ~special, F.col("raw_zone_id"))).alias(
            "retained_zone_count"
        ),
    )


def invalid_zones(cells: DataFrame) -> DataFrame:
    """Rejected zones with the reason, largest first, from zone_cells."""
    matched = F.col("lookup_zone_id").isNotNull()
    reason = (
        F.when(F.col("raw_zone_id").isNull(), "null_zone")
        .when(~matched, "not_in_lookup")
        .otherwise("non_service_lookup_zone")
    )
    return (
        cells.where(~matched | F.col("is_special"))
        .withColumn("reason", reason)
        .groupBy(F.col("raw_zone_id").alias("zone_id"), "borough", "zone_name", "reason")
        .agg(F.sum("zone_rows").alias("rows"))
        .orderBy(F.desc("rows"), F.asc_nulls_last("zone_id"))
    )


def hourly_coverage(
    events: DataFrame, window: LocalWindow, ts_col: str = "pickup_ts"
) -> DataFrame:
    """Rows per observed local hour of the window."""
    hour = F.date_trunc("hour", F.col(ts_col)).cast("timestamp_ntz")
    return (
        in_window(events, window, ts_col)
        .groupBy(hour.alias("pickup_hour"))
        .agg(F.count("*").alias("rows"))
    )


def daily_coverage(hourly: DataFrame) -> DataFrame:
    """Rows per observed local date, from hourly_coverage."""
    return hourly.groupBy(F.to_date("pickup_hour").alias("pickup_date")).agg(
        F.sum("rows").alias("rows")
    )


def missing_hours(hourly: DataFrame, window: LocalWindow) -> DataFrame:
    """Local hours of the window without any row."""
    expected = hour_series(hourly.sparkSession, window.start, window.end, "pickup_hour")
    return expected.join(hourly, "pickup_hour", "left_anti")


def coverage_summary(hourly: DataFrame, window: LocalWindow) -> DataFrame:
    """One row: expected, observed and missing hours, and rows per hour and per day."""
    expected = int((window.end - window.start).total_seconds() // 3600)
    by_day = hourly.groupBy(F.to_date("pickup_hour").alias("pickup_date")).agg(
        F.sum("rows").alias("day_rows"),
        F.count("*").alias("day_hours"),
        F.min("rows").alias("hour_min"),
        F.max("rows").alias("hour_max"),
    )
    observed = F.coalesce(F.sum("day_hours"), F.lit(0))
    return by_day.agg(
        F.lit(expected).cast("long").alias("expected_hours"),
        observed.alias("observed_hours"),
        (F.lit(expected) - observed).alias("missing_hours"),
        F.min("hour_min").alias("min_rows_per_observed_hour"),
        F.max("hour_max").alias("max_rows_per_observed_hour"),
        rounded(F.sum("day_rows") / F.sum("day_hours"), 3).alias("mean_rows_per_observed_hour"),
        F.count("*").alias("observed_days"),
        F.min("day_rows").alias("min_rows_per_observed_day"),
        F.max("day_rows").alias("max_rows_per_observed_day"),
    )
