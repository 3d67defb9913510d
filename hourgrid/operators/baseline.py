"""Seasonal-naive baseline with documented fallbacks.

The lag is read from a time-range frame of exactly N hours back, the prior mean
and the train mean from frames over the same zone: one exchange on zone_id
serves all three, and no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.errors import ParameterError
from hourgrid.functions.scoring import absolute_error, clip_at_zero
from hourgrid.schemas import BASELINE_PREDICTIONS, FALLBACK_SOURCES

SEASONAL_LAG_HOURS = 168


def timeline() -> Window:
    return Window.partitionBy("zone_id").orderBy("target_hour_utc")


def lag_by_hours(value: str, hours: int) -> Column:
    """Value of the same zone exactly this many hours earlier, NULL when there is none.

    A time-range frame, so it stays right on frames with missing hours.
    """
    back = f"INTERVAL '{hours}' HOUR PRECEDING"
    return F.expr(
        f"max({value}) OVER (PARTITION BY zone_id ORDER BY target_hour_utc "
        f"RANGE BETWEEN {back} AND {back})"
    )


def with_history(assigned: DataFrame, lag_hours: int = SEASONAL_LAG_HOURS) -> DataFrame:
    """Seasonal lag, mean of strictly earlier rows and mean of the train rows, per zone."""
    if lag_hours <= 0:
        raise ParameterError("seasonal lag must be a positive number of hours")
    earlier = timeline().rowsBetween(Window.unboundedPreceding, -1)
    train = F.when(F.col("split") == "train", F.col("trip_count"))
    return assigned.withColumns(
        {
            "seasonal_lag_trip_count": lag_by_hours("trip_count", lag_hours),
            "prior_zone_mean": F.avg("trip_count").over(earlier),
            "train_zone_mean": F.avg(train).over(Window.partitionBy("zone_id")),
        }
    )


def lag_by_join(grid: DataFrame, lag_hours: int) -> DataFrame:
    """The lag as a shifted self-join, for frames that are joined anyway."""
    shifted = grid.select(
        "zone_id",
        (F.col("target_hour_utc") + F.make_dt_interval(hours=F.lit(lag_hours))).alias(
            "target_hour_utc"
        ),
        F.col("trip_count").alias("seasonal_lag_trip_count"),
    )
    return grid.join(shifted, ["zone_id", "target_hour_utc"], "left")


def train_zone_means(assigned: DataFrame) -> DataFrame:
    """Mean known count of each zone over the train split."""
    return (
        assigned.where((F.col("split") == "train") & F.col("trip_count").isNotNull())
        .groupBy("zone_id")
        .agg(F.avg("trip_count").alias("train_zone_mean"))
    )


def seasonal_naive(assigned: DataFrame, lag_hours: int = SEASONAL_LAG_HOURS) -> DataFrame:
    """Baseline predictions: seasonal lag, else the split's fallback mean, else NULL."""
    is_train = F.col("split") == "train"
    use_lag = F.col("seasonal_lag_trip_count").isNotNull()
    use_prior = is_train & F.col("prior_zone_mean").isNotNull()
    use_train = ~is_train & F.col("train_zone_mean").isNotNull()
    raw = (
        F.when(use_lag, F.col("seasonal_lag_trip_count").cast("double"))
        .when(use_prior, F.col("prior_zone_mean"))
        .when(use_train, F.col("train_zone_mean"))
    )
    source = (
        F.when(use_lag, "seasonal_lag")
        .when(use_prior, "prior_zone_mean")
        .when(use_train, "train_zone_mean")
        .otherwise("unavailable")
    )
    return (
        with_history(assigned, lag_hours)
        .withColumns({"prediction": clip_at_zero(raw), "prediction_source": source})
        .withColumnRenamed("trip_count", "actual_trip_count")
        .withColumns(
            {
                "used_fallback": F.col("prediction_source").isin(*FALLBACK_SOURCES),
                "absolute_error": absolute_error(F.col("actual_trip_count"), F.col("prediction")),
            }
        )
        .select(*BASELINE_PREDICTIONS.names)
    )
