"""Forecast metrics per split and subgroup, all splits in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.errors import ContractError
from hourgrid.functions.scoring import count_where, ratio, rounded, with_key_counts


def split_metrics(predictions: DataFrame) -> DataFrame:
    """Row counts, MAE, WAPE and fallback rate of each split."""
    actual, prediction = F.col("actual_trip_count"), F.col("prediction")
    scored = actual.isNotNull() & prediction.isNotNull()
    measures = {
        "total_rows": F.count("*"),
        "target_rows": F.count(actual),
        "missing_target_rows": count_where(actual.isNull()),
        "prediction_rows": F.count(prediction),
        "missing_prediction_rows": count_where(prediction.isNull()),
        "scored_rows": count_where(scored),
        "fallback_rows": count_where(F.col("used_fallback")),
        "error_rows": F.count("absolute_error"),
        "absolute_error_sum": F.sum("absolute_error"),
        "actual_sum": F.sum(F.when(scored, actual)),
    }
    totals = with_key_counts(predictions, ("split",), measures, {})
    return totals.select(
        "split",
        "total_rows",
        "zone_count",
        "hour_count",
        "target_rows",
        "missing_target_rows",
        "prediction_rows",
        "missing_prediction_rows",
        "scored_rows",
        "fallback_rows",
        rounded(ratio(F.col("fallback_rows"), F.col("prediction_rows"))).alias("fallback_rate"),
        rounded(ratio(F.col("absolute_error_sum"), F.col("error_rows"))).alias("mae"),
        rounded(ratio(F.col("absolute_error_sum"), F.col("actual_sum"))).alias("wape"),
        "actual_sum",
        rounded(F.col("absolute_error_sum")).alias("absolute_error_sum"),
    )


def check_scored(metrics: DataFrame) -> None:
    if not metrics.where(F.col("scored_rows") == 0).isEmpty():
        raise ContractError("a split has no scored row")


def source_counts(predictions: DataFrame) -> DataFrame:
    """Rows per split and prediction source."""
    return predictions.groupBy("split", "prediction_source").agg(F.count("*").alias("rows"))


def mae_by(predictions: DataFrame, *keys) -> DataFrame:
    """Scored rows and MAE per split and group."""
    return predictions.groupBy("split", *keys).agg(
        F.count("absolute_error").alias("scored_rows"),
        rounded(F.avg("absolute_error")).alias("mae"),
    )


def mae_by_zone(predictions: DataFrame) -> DataFrame:
    return mae_by(predictions, "zone_id")


def mae_by_hour(predictions: DataFrame) -> DataFrame:
    return mae_by(predictions, F.hour("target_hour_utc").alias("utc_hour"))


def forecast_metrics(predictions: DataFrame, *keys: str) -> DataFrame:
    """MAE, WAPE and sums of scored rows per group, as used to choose a candidate."""
    scored = predictions.where(F.col("absolute_error").isNotNull())
    return (
        scored.groupBy(*keys)
        .agg(
            F.count("*").alias("scored_rows"),
            F.avg("absolute_error").alias("mae"),
            F.sum("absolute_error").alias("error_sum"),
            F.sum("actual_trip_count").alias("actual_sum"),
        )
        .select(
            *keys,
            "scored_rows",
            rounded(F.col("mae")).alias("mae"),
            rounded(ratio(F.col("error_sum"), F.col("actual_sum"))).alias("wape"),
            "actual_sum",
            rounded(F.col("error_sum")).alias("absolute_error_sum"),
        )
    )
