"""First-match classification of raw events against a window and a lookup.

Row level and cell level share the same expressions. The cell level counts
events per (zone, hour, time label) before it meets the lookup, so raw rows are
never shuffled or joined: the map-side partial aggregate absorbs hot zones and
the lookup join runs on cells, whether Spark broadcasts the lookup or not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.errors import ParameterError
from hourgrid.functions.calendar import (
    LocalWindow,
    hour_of_number,
    in_anomaly,
    ntz,
    utc_hour_number,
)
from hourgrid.functions.scoring import (
    SPECIAL_BOROUGHS,
    SPECIAL_SERVICE_ZONES,
    SPECIAL_ZONES,
    special_dimension,
)
from hourgrid.schemas import DISPOSITIONS
from hourgrid.session import require_utc, shuffle_partitions

SPECIAL = {
    "borough": SPECIAL_BOROUGHS,
    "zone_name": SPECIAL_ZONES,
    "service_zone": SPECIAL_SERVICE_ZONES,
}

# Zones that a frequency sketch names at most.
HOT_ITEMS = 256

SpecialValues = dict[str, tuple[str, ...]]


def lookup_flags(lookup: DataFrame, special: SpecialValues = SPECIAL) -> DataFrame:
    """Lookup reduced to (zone_id, is_special)."""
    return lookup.where(F.col("zone_id").isNotNull()).select(
        F.col("zone_id").cast("int"), special_dimension(special).alias("is_special")
    )


def in_source_month(ts: Column, month: Column) -> Column:
    """True when the time lies in the local month (yyyy-MM) the row's source is named after.

    Months are compared as whole numbers; a name that is no month is never hit.
    """
    year, number = (F.substring(month, k, n).try_cast("int") for k, n in ((1, 4), (6, 2)))
    return F.coalesce(F.year(ts) * 12 + F.month(ts) == year * 12 + number, F.lit(False))


def outside_window(ts: Column, window: LocalWindow, month: Column | None) -> Column:
    """True outside the local window, or outside the row's own source month."""
    outside = (ts < ntz(window.start)) | (ts >= ntz(window.end))
    if month is None:
        return outside
    return outside | ~in_source_month(ts, month)


def time_disposition(ts: Column, window: LocalWindow, month: Column | None = None) -> Column:
    """Label decided by the timestamp alone; NULL when the row is usable."""
    return (
        F.when(ts.isNull(), "null_timestamp")
        .when(outside_window(ts, window, month), "outside_month")
        .when(in_anomaly(ts, window.anomalies, "nonexistent"), "dst_nonexistent")
        .when(in_anomaly(ts, window.anomalies, "ambiguous"), "dst_ambiguous")
    )


def zone_disposition(zone_missing: Column) -> Column:
    """Label decided by the zone, after a left join to lookup_flags."""
    return (
        F.when(zone_missing, "null_zone")
        .when(F.col("is_special").isNull(), "not_in_lookup")
        .when(F.col("is_special"), "non_service_zone")
        .otherwise("retained")
    )


def hot_zones(events: DataFrame, zone_col: str = "zone_raw", tasks: int | None = None) -> list[int]:
    """Zones with so many rows that one task of an exchange would get twice its share.

    A frequency sketch of a fixed size finds them in one pass; tasks is the number of
    partitions of the exchange. The list has at most HOT_ITEMS zones.
    """
    tasks = tasks or shuffle_partitions(events.sparkSession)
    zone = F.col(zone_col)
    found = events.where(zone.isNotNull()).agg(
        F.call_function("approx_top_k", zone.cast("long"), F.lit(HOT_ITEMS)).alias("top"),
        F.count("*").alias("rows"),
    ).first()
    if not found["rows"]:
        return []
    return sorted(r["item"] for r in found["top"] if r["count"] * 2 * tasks >= found["rows"])


def label_dispositions(
    events: DataFrame,
    lookup: DataFrame,
    window: LocalWindow,
    ts_col: str = "pickup_ts",
    zone_col: str = "zone_raw",
    month_col: str | None = None,
    special: SpecialValues = SPECIAL,
    hot: Sequence[int] = (),
) -> DataFrame:
    """Events with one extra column, disposition; unmatched rows are kept.

    Rows without a zone and those of hot zones (see hot_zones) stay where they are: only
    the hot zones' lookup rows, at most HOT_ITEMS, are sent to them. The other rows meet
    the lookup by an exchange in which no zone is large. hot changes the plan alone.
    """
    if len(hot) > HOT_ITEMS:
        raise ParameterError(f"give at most {HOT_ITEMS} hot zones")
    ts = F.col(ts_col).cast("timestamp_ntz")
    month = None if month_col is None else F.col(month_col)
    zone, missing = F.col(zone_col), F.col(zone_col).isNull()
    flags = lookup_flags(lookup, special).withColumnRenamed("zone_id", "__lookup_zone")
    label = F.coalesce(time_disposition(ts, window, month), zone_disposition(missing))
    stays = missing
    if hot:
        stays = missing | zone.isin(*hot)
    few = F.broadcast(flags.where(F.col("__lookup_zone").isin(*hot)))
    parts = [
        rows.join(side, zone == F.col("__lookup_zone"), "left").withColumn("disposition", label)
        for rows, side in ((events.where(stays), few), (events.where(~stays), flags))
    ]
    return parts[0].unionByName(parts[1]).drop("__lookup_zone", "is_special")


def time_cells(
    events: DataFrame,
    window: LocalWindow,
    ts_col: str = "pickup_ts",
    zone_col: str = "zone_raw",
    month_col: str | None = None,
) -> DataFrame:
    """Event counts of all rows per zone, UTC hour and label rejected by the timestamp.

    Rejected rows carry neither zone nor hour, so they fold into one cell per label.
    """
    require_utc(events.sparkSession)
    ts = F.col(ts_col).cast("timestamp_ntz")
    month = None if month_col is None else F.col(month_col)
    rejected = time_disposition(ts, window, month)
    zone = F.when(rejected.isNull(), F.col(zone_col).cast("int"))
    hour = F.when(rejected.isNull(), utc_hour_number(ts, window))
    return _counted(events, zone, hour, window, month, {"rejected": rejected})


def usable_cells(
    events: DataFrame,
    window: LocalWindow,
    ts_col: str = "pickup_ts",
    zone_col: str = "zone_raw",
    month_col: str | None = None,
) -> DataFrame:
    """Event counts of the usable rows per zone and UTC hour.

    The window bounds are plain range filters that reach the Parquet scan.
    """
    require_utc(events.sparkSession)
    ts = F.col(ts_col).cast("timestamp_ntz")
    month = None if month_col is None else F.col(month_col)
    rows = events.where((ts >= ntz(window.start)) & (ts < ntz(window.end)))
    if month is not None:
        rows = rows.where(in_source_month(ts, month))
    for kind in ("nonexistent", "ambiguous"):
        rows = rows.where(~in_anomaly(ts, window.anomalies, kind))
    # The hour of a row in the window is never NULL; saying so keeps later joins
    # on it from adding a NULL test that would compute it twice per row.
    hour = F.coalesce(utc_hour_number(ts, window), F.lit(0))
    return _counted(rows, F.col(zone_col).cast("int"), hour, window, month, {})


def _counted(
    rows: DataFrame,
    zone: Column,
    hour: Column,
    window: LocalWindow,
    month: Column | None,
    labels: dict[str, Column],
) -> DataFrame:
    """Cells (zone_missing, zone_id, labels..., cell_rows, target_hour_utc, source_month).

    A missing zone is a flag beside zone_id 0. With a zone_id that is never NULL
    no join adds a NULL filter below the aggregate, so the coverage and the
    counts of one plan share a single scan and exchange of the events.
    """
    keys = {
        "zone_missing": zone.isNull(),
        "zone_id": F.coalesce(zone, F.lit(0)),
        "hour_number": hour,
        **labels,
    }
    if month is not None:
        keys["source_month"] = month
    cells = (
        rows.select(*[column.alias(name) for name, column in keys.items()])
        .groupBy(*keys)
        .agg(F.count("*").alias("cell_rows"))
        .withColumn("target_hour_utc", hour_of_number(F.col("hour_number")))
        .drop("hour_number")
    )
    if month is None:
        cells = cells.withColumn("source_month", F.lit(window.label))
    return cells


def label_cells(
    cells: DataFrame, lookup: DataFrame, special: SpecialValues = SPECIAL
) -> DataFrame:
    """Cells with their disposition; the lookup meets cells, never raw rows."""
    label = zone_disposition(F.col("zone_missing"))
    if "rejected" in cells.columns:
        label = F.coalesce("rejected", label)
    flags = lookup_flags(lookup, special)
    return cells.join(flags, "zone_id", "left").select(
        "source_month",
        "zone_missing",
        "zone_id",
        "target_hour_utc",
        label.alias("disposition"),
        "cell_rows",
    )


def disposition_counts(cells: DataFrame) -> DataFrame:
    """(disposition, rows) for every label, zero when absent, plus raw and excluded rows."""

    def total(label: str) -> Column:
        hit = F.when(F.col("disposition") == label, F.col("cell_rows"))
        return F.coalesce(F.sum(hit), F.lit(0)).alias(label)

    wide = cells.agg(*[total(label) for label in DISPOSITIONS])
    raw = reduce(lambda left, right: left + right, [F.col(label) for label in DISPOSITIONS])
    wide = wide.withColumn("raw_rows", raw).withColumn(
        "excluded_rows", F.col("raw_rows") - F.col("retained")
    )
    names = [*DISPOSITIONS, "raw_rows", "excluded_rows"]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("disposition"), F.col(n).alias("rows")) for n in names]
    )
    return wide.select(F.inline(pairs))


def monthly_totals(cells: DataFrame) -> DataFrame:
    """Raw, retained and excluded rows per source month and over all months."""
    retained = F.when(F.col("disposition") == "retained", F.col("cell_rows")).otherwise(0)
    return (
        cells.rollup("source_month")
        .agg(
            F.sum("cell_rows").alias("raw_rows"),
            F.sum(retained).alias("retained_rows"),
            F.grouping("source_month").alias("is_total"),
        )
        .select(
            F.when(F.col("is_total") == 1, "all").otherwise(F.col("source_month")).alias(
                "source_month"
            ),
            "raw_rows",
            "retained_rows",
            (F.col("raw_rows") - F.col("retained_rows")).alias("excluded_rows"),
        )
    )
