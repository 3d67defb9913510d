"""The driver tables seen as raw events and a zone lookup.

An event is one row of `events`; its zone is user_id + 1, missing on error
events. A zone is one row of `supplier` (s_suppkey + 1), its borough the region
and its service zone the nation; the region MIDDLE EAST is not served. Users
without a supplier are unknown zones. The window ends a day after the last
event, so its last hours have no source row.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.calendar import LocalWindow, ntz
from hourgrid.functions.scoring import absolute_error, clip_at_zero
from hourgrid.operators.baseline import seasonal_naive
from hourgrid.operators.classify import label_cells, time_cells, usable_cells
from hourgrid.operators.counts import hourly_counts, source_activity
from hourgrid.operators.features import build_features, training_rows
from hourgrid.operators.grid import complete_grid, coverage_status, service_entities
from hourgrid.operators.splits import Splits, assign_splits
from hourgrid.schemas import MODEL_PREDICTIONS

TZ = "America/New_York"

SPECIAL = {
    "borough": ("middle east", "n/a"),
    "zone_name": ("unknown", "n/a"),
    "service_zone": ("unknown", "n/a"),
}


def _local_midnight(day: int, month: int = 1) -> datetime:
    return datetime(2024, month, day, 5, tzinfo=UTC)


SPLITS = Splits(
    train=(_local_midnight(2), _local_midnight(18)),
    validation=(_local_midnight(18), _local_midnight(23)),
    test=(_local_midnight(23), _local_midnight(1, month=2)),
)

# Day shifts of the timestamps: none, over the spring gap, over the autumn
# overlap, and over a month boundary with the spring gap.
BASE_DAYS, GAP_DAYS, OVERLAP_DAYS, MONTHS_DAYS = 0, 60, 300, 45


def shifted_window(days: int) -> LocalWindow:
    start, end = datetime(2024, 1, 2), datetime(2024, 2, 1)
    return LocalWindow(start + timedelta(days=days), end + timedelta(days=days), TZ)


TWO_MONTHS = LocalWindow.months(["2024-02", "2024-03"], TZ)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(
    spark: SparkSession, sf_dir: str, days: int = 0, within: LocalWindow | None = None
) -> DataFrame:
    """(event_id, pickup_ts, zone_raw, source_month) of the events table.

    within keeps the rows of a window by a filter on the stored column.
    """
    rows = read(spark, sf_dir, "events")
    shift = timedelta(days=days)
    if within is not None:
        stored = F.col("ts")
        rows = rows.where(
            (stored >= ntz(within.start - shift)) & (stored < ntz(within.end - shift))
        )
    shifted = (F.col("ts") + F.expr(f"INTERVAL {days} DAYS")).cast("timestamp_ntz")
    # Source files are cut by UTC month, while windows follow local months.
    file_month = F.date_format(F.to_utc_timestamp(shifted, TZ), "yyyy-MM")
    return rows.select(
        "event_id",
        shifted.alias("pickup_ts"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("int") + 1).alias(
            "zone_raw"
        ),
        file_month.alias("source_month"),
    )


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier, nation and region as a zone lookup."""
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            (F.col("s_suppkey").cast("int") + 1).alias("zone_id"),
            F.col("r_name").alias("borough"),
            F.col("s_name").alias("zone_name"),
            F.col("n_name").alias("service_zone"),
        )
    )


def blend_predictions(features: DataFrame) -> DataFrame:
    """A deterministic predictor in the model schema: the week's mean, pulled away
    from the last day's. It can go below zero before clipping."""
    raw = 1.5 * F.col("rolling_mean_168h") - 0.5 * F.col("rolling_mean_24h")
    rows = training_rows(features, "validation", "test")
    return (
        rows.withColumnRenamed("target_trip_count", "actual_trip_count")
        .withColumn("prediction_raw", raw)
        .withColumn("prediction", clip_at_zero(F.col("prediction_raw")))
        .withColumn(
            "absolute_error",
            absolute_error(F.col("actual_trip_count"), F.col("prediction")),
        )
        .withColumn("candidate_name", F.lit("blend"))
        .withColumn(
            "fit_scope",
            F.when(F.col("split") == "test", "train_validation").otherwise("train"),
        )
        .select(*MODEL_PREDICTIONS.names)
    )


@dataclass(frozen=True)
class Workload:
    """The tables of one data folder, each derived from the one before, all lazy."""

    spark: SparkSession
    sf_dir: str
    days: int = 0

    @property
    def window(self) -> LocalWindow:
        return shifted_window(self.days)

    @property
    def events(self) -> DataFrame:
        return events(self.spark, self.sf_dir, self.days)

    @property
    def lookup(self) -> DataFrame:
        return lookup(self.spark, self.sf_dir)

    @property
    def cells(self) -> DataFrame:
        return label_cells(time_cells(self.events, self.window), self.lookup, SPECIAL)

    @property
    def month_cells(self) -> DataFrame:
        cells = time_cells(self.events, TWO_MONTHS, month_col="source_month")
        return label_cells(cells, self.lookup, SPECIAL)

    @property
    def usable(self) -> DataFrame:
        rows = events(self.spark, self.sf_dir, self.days, within=self.window)
        return usable_cells(rows, self.window)

    @property
    def usable_labelled(self) -> DataFrame:
        return label_cells(self.usable, self.lookup, SPECIAL)

    @property
    def counts(self) -> DataFrame:
        return hourly_counts(self.usable_labelled)

    @property
    def activity(self) -> DataFrame:
        return source_activity(self.usable_labelled)

    @property
    def coverage(self) -> DataFrame:
        return coverage_status(self.usable, self.window)

    @property
    def grid(self) -> DataFrame:
        return self.grid_in()

    def grid_in(self, partitions: int | None = None) -> DataFrame:
        cells, lookup = self.usable, self.lookup
        return complete_grid(
            service_entities(lookup, SPECIAL),
            coverage_status(cells, self.window),
            hourly_counts(label_cells(cells, lookup, SPECIAL)),
            self.window,
            partitions,
        )

    @property
    def assigned(self) -> DataFrame:
        return assign_splits(self.grid, SPLITS)

    @property
    def features(self) -> DataFrame:
        return build_features(self.assigned)

    @property
    def baseline(self) -> DataFrame:
        return seasonal_naive(self.assigned)

    @property
    def model(self) -> DataFrame:
        return blend_predictions(self.features)
