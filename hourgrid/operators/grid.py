"""Completion of observed counts to the full zone x hour grid."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.errors import ContractError
from hourgrid.functions.calendar import LocalWindow, hour_series, instant
from hourgrid.functions.scoring import count_where, special_dimension
from hourgrid.operators.classify import SPECIAL, SpecialValues
from hourgrid.schemas import KEY, STATUSES
from hourgrid.session import require_utc, shuffle_partitions

def lookup_audit(lookup: DataFrame) -> DataFrame:
    """One row: surplus, non-positive and NULL keys, and rows with a NULL attribute."""
    key = F.col("zone_id")
    attributes = [F.col(c) for c in ("borough", "zone_name", "service_zone")]
    any_null = key.isNull()
    for attribute in attributes:
        any_null = any_null | attribute.isNull()
    return lookup.agg(
        F.count("*").alias("rows"),
        (F.count("*") - F.count_distinct(key)).alias("surplus_keys"),
        count_where(key.isNull() | (key <= 0)).alias("invalid_keys"),
        count_where(any_null).alias("null_rows"),
    )


def check_lookup(lookup: DataFrame) -> None:
    audit = lookup_audit(lookup).first()
    if audit.surplus_keys or audit.invalid_keys:
        raise ContractError("lookup ids must be positive integers, each used once")


def service_entities(lookup: DataFrame, special: SpecialValues = SPECIAL) -> DataFrame:
    """Zones of the lookup that belong to the service area, active or not."""
    return lookup.where(~special_dimension(special)).select(F.col("zone_id").cast("int"))


def coverage_status(cells: DataFrame, window: LocalWindow) -> DataFrame:
    """(target_hour_utc, source_rows, source_status) for every UTC hour of the window.

    An hour is available when any in-window, unambiguous event falls in it, so
    usable cells (before any lookup) or source activity both serve as input.
    Both passes of a repeated local hour are ambiguous, whatever was observed.
    """
    require_utc(cells.sparkSession)
    rows = "cell_rows" if "cell_rows" in cells.columns else "trip_count"
    hours = hour_series(
        cells.sparkSession, window.utc_start, window.utc_end, "target_hour_utc"
    )
    active = cells.groupBy("target_hour_utc").agg(F.sum(rows).alias("source_rows"))
    ambiguous = F.lit(False)
    for hour in window.ambiguous_hours:
        ambiguous = ambiguous | (F.col("target_hour_utc") == instant(hour))
    status = (
        F.when(ambiguous, "dst_ambiguous")
        .when(F.col("source_rows").isNull(), "source_missing")
        .otherwise("available")
    )
    return hours.join(active, "target_hour_utc", "left").withColumn("source_status", status)


def uncovered_hours(coverage: DataFrame) -> DataFrame:
    """Hours without usable data and the reason, in time order."""
    return (
        coverage.where(F.col("source_status") != "available")
        .select(
            F.date_format("target_hour_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("target_hour_utc"),
            F.col("source_status").alias("reason"),
        )
        .orderBy("target_hour_utc")
    )


def complete_grid(
    entities: DataFrame,
    coverage: DataFrame,
    counts: DataFrame,
    window: LocalWindow,
    partitions: int | None = None,
    month_of_hour: bool = False,
) -> DataFrame:
    """Every service zone at every hour; zero only where the source was available.

    Entities are spread over the cluster first and expanded in place to the hours
    of coverage, so the skeleton is born partitioned by zone. The counts join and
    the per-zone windows that follow reuse that partitioning. Each zone holds exactly one
    row per hour, so partitions stay even however skewed the events are.
    """
    spark = entities.sparkSession
    count = partitions or shuffle_partitions(spark)
    # Hour and status as one value, bounded by the window: no join by hour is needed.
    hours = coverage.agg(
        F.array_sort(F.collect_list(F.struct("target_hour_utc", "source_status"))).alias("hours")
    )
    skeleton = entities.repartition(count, "zone_id").select(
        "zone_id", F.inline(hours.scalar())
    )
    month = F.lit(window.label)
    if month_of_hour:
        local = F.from_utc_timestamp("target_hour_utc", window.tz)
        month = F.date_format(local, "yyyy-MM")
    observed = counts.select(*KEY, F.col("trip_count").alias("observed_count"))
    available = F.col("source_status") == "available"
    return (
        skeleton.join(observed, list(KEY), "left")
        .select(
            *KEY,
            F.when(available, F.coalesce("observed_count", F.lit(0))).alias("trip_count"),
            month.alias("source_month"),
            "source_status",
        )
    )


def grid_violation():
    """Row-level rule of the grid: sane values, and a count exactly when available."""
    return (
        (F.col("zone_id") <= 0)
        | (F.coalesce("trip_count", F.lit(0)) < 0)
        | (F.date_trunc("hour", "target_hour_utc") != F.col("target_hour_utc"))
        | ~F.col("source_status").isin(*STATUSES)
        | ((F.col("source_status") == "available") != F.col("trip_count").isNotNull())
    )


def by_key(grid: DataFrame) -> DataFrame:
    """One row per (zone, hour): the unique keys, from which all shape checks follow."""
    count = F.col("trip_count")
    return grid.groupBy(*KEY).agg(
        F.count("*").alias("key_rows"),
        F.sum("trip_count").alias("key_trips"),
        count_where(count == 0).alias("zero_rows"),
        count_where(count.isNull()).alias("missing_rows"),
        count_where(count > 0).alias("observed_rows"),
        count_where(grid_violation()).alias("bad_rows"),
    )


def grid_summary(grid: DataFrame) -> DataFrame:
    """One row: rows, trips, zero / missing / observed rows, unique keys, violations."""

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0))

    return by_key(grid).agg(
        total("key_rows").alias("output_rows"),
        total("key_trips").alias("trip_count"),
        total("zero_rows").alias("zero_rows"),
        total("missing_rows").alias("missing_rows"),
        total("observed_rows").alias("observed_rows"),
        F.count("*").alias("unique_keys"),
        total("bad_rows").alias("violations"),
    )


def hour_shapes(grid: DataFrame) -> DataFrame:
    """Rows and distinct zones per hour."""
    return (
        by_key(grid)
        .groupBy("target_hour_utc")
        .agg(F.sum("key_rows").alias("rows"), F.count("*").alias("zones"))
    )


def validate_grid(grid: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """One row of shape facts and is_valid: unique, rectangular, exactly [start, end).

    Zones and hours are counted from the unique keys in two small aggregates
    that are stacked and folded, instead of several distinct counts at once.
    """
    keys = by_key(grid)
    zero = F.lit(0).cast("long")
    zones = (
        keys.groupBy("zone_id")
        .agg(
            F.count("*").alias("keys"),
            F.sum("key_rows").alias("rows"),
            F.sum("bad_rows").alias("bad"),
        )
        .agg(
            F.count("*").alias("zone_count"),
            F.coalesce(F.sum("keys"), zero).alias("key_count"),
            F.coalesce(F.sum("rows"), zero).alias("row_count"),
            F.coalesce(F.sum("bad"), zero).alias("bad_rows"),
        )
    )
    hours = (
        keys.groupBy("target_hour_utc")
        .agg(F.sum("key_rows").alias("rows"), F.count("*").alias("zones"))
        .agg(
            F.count("*").alias("hour_count"),
            F.min("target_hour_utc").alias("first_hour"),
            F.max("target_hour_utc").alias("last_hour"),
            F.min(F.least("rows", "zones")).alias("least_per_hour"),
            F.max(F.greatest("rows", "zones")).alias("most_per_hour"),
        )
    )
    facts = zones.unionByName(hours, allowMissingColumns=True)
    names = [*zones.columns, *hours.columns]
    expected = int((end - start).total_seconds() // 3600)
    valid = (
        (F.col("row_count") > 0)
        & (F.col("row_count") == F.col("key_count"))
        & (F.col("row_count") == F.lit(expected) * F.col("zone_count"))
        & (F.col("hour_count") == expected)
        & (F.col("first_hour") == instant(start))
        & (F.col("last_hour") + F.expr("INTERVAL 1 HOUR") == instant(end))
        & (F.col("least_per_hour") == F.col("zone_count"))
        & (F.col("most_per_hour") == F.col("zone_count"))
        & (F.col("bad_rows") == 0)
    )
    return facts.agg(*[F.max(name).alias(name) for name in names]).withColumn(
        "is_valid", F.coalesce(valid, F.lit(False))
    )


def check_grid(grid: DataFrame, start: datetime, end: datetime) -> dict:
    facts = validate_grid(grid, start, end).first().asDict()
    if not facts["is_valid"]:
        raise ContractError(
            f"grid is not one valid row per zone and hour of [{start}, {end}): {facts}"
        )
    return facts


def bag_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with the surplus on each side.

    Same answer as EXCEPT ALL both ways, from one signed aggregation: the
    map-side sums collapse repeated rows and nothing is replicated.
    """
    names = left.columns
    signed = left.withColumn("__sign", F.lit(1).cast("long")).unionByName(
        right.select(*names).withColumn("__sign", F.lit(-1).cast("long"))
    )
    return (
        signed.groupBy(*names)
        .agg(F.sum("__sign").alias("__net"))
        .where(F.col("__net") != 0)
        .withColumn("left_surplus", F.greatest("__net", F.lit(0)))
        .withColumn("right_surplus", F.greatest(-F.col("__net"), F.lit(0)))
        .drop("__net")
    )


def bag_diff_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many rows differ, counting multiplicity."""
    return bag_diff(left, right).agg(
        F.coalesce(F.sum(F.col("left_surplus") + F.col("right_surplus")), F.lit(0)).alias(
            "differing_rows"
        )
    )
