"""Side-by-side residual analysis of two predictors and the serving decision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.errors import ContractError, ParameterError
from hourgrid.functions.quantiles import exact_quantiles
from hourgrid.functions.scoring import count_where, ratio, rounded, with_key_counts
from hourgrid.operators.counts import duplicate_keys
from hourgrid.schemas import KEY, MODEL_PREDICTIONS

QUANTILES = (0.5, 0.9, 0.95, 0.99)
ERROR_TOLERANCE = 1e-12
METRIC_TOLERANCE = 1e-6


def any_null(names: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(name).isNull() for name in names])


def prediction_audit(predictions: DataFrame) -> DataFrame:
    """One row: rows, unique keys, NULL rows and the sorted labels in use."""
    labels = ["split", "candidate_name", "fit_scope"]
    keys = (
        predictions.groupBy(*KEY)
        .agg(
            F.count("*").alias("key_rows"),
            count_where(any_null(MODEL_PREDICTIONS.names)).alias("key_null_rows"),
        )
        .agg(
            F.coalesce(F.sum("key_rows"), F.lit(0)).alias("rows"),
            F.count("*").alias("unique_keys"),
            F.coalesce(F.sum("key_null_rows"), F.lit(0)).alias("null_rows"),
        )
    )
    # Labels are few, so their sets stay small in every partial aggregate.
    sets = predictions.agg(
        *[F.sort_array(F.collect_set(name)).alias(f"{name}s") for name in labels]
    )
    facts = keys.unionByName(sets, allowMissingColumns=True)
    return facts.agg(*[F.max(name).alias(name) for name in facts.columns])


def baseline_audit(predictions: DataFrame) -> DataFrame:
    """One row for the test split: rows, unique keys and NULL rows."""
    names = [*KEY, "actual_trip_count", "prediction", "absolute_error"]
    by_key = (
        predictions.where(F.col("split") == "test")
        .groupBy(*KEY)
        .agg(F.count("*").alias("rows"), count_where(any_null(names)).alias("null_rows"))
    )
    return by_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count("*").alias("unique_keys"),
        F.coalesce(F.sum("null_rows"), F.lit(0)).alias("null_rows"),
    )


def align_predictions(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """Test rows both predictors scored, and their residuals.

    Keys decide the join; rows whose actuals differ are no comparison and are left
    out here, counted by alignment() and refused by check_alignment().
    """
    left = model.where(
        (F.col("split") == "test") & (F.col("fit_scope") == "train_validation")
    ).select(
        *KEY,
        "actual_trip_count",
        F.col("prediction_raw").alias("model_prediction_raw"),
        F.col("prediction").alias("model_prediction"),
    )
    right = baseline.where(
        (F.col("split") == "test")
        & F.col("prediction").isNotNull()
        & F.col("actual_trip_count").isNotNull()
    ).select(
        *KEY,
        F.col("actual_trip_count").alias("baseline_actual"),
        F.col("prediction").alias("baseline_prediction"),
    )
    actual = F.col("actual_trip_count").cast("double")
    # Tested behind the join: as a join key the actual would be sorted by as well.
    equal = F.when(F.col("actual_trip_count") == F.col("baseline_actual"), True)
    joined = left.join(right, list(KEY)).where(F.coalesce(equal, F.lit(False)))
    return joined.select(
        *KEY,
        "actual_trip_count",
        "model_prediction_raw",
        "model_prediction",
        "baseline_prediction",
        F.abs(actual - F.col("model_prediction")).alias("model_absolute_error"),
        F.abs(actual - F.col("baseline_prediction")).alias("baseline_absolute_error"),
        (F.col("model_prediction") - actual).alias("model_signed_error"),
        (F.col("baseline_prediction") - actual).alias("baseline_signed_error"),
        F.hour("target_hour_utc").alias("utc_hour"),
    )


def alignment(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: test rows of each side, keys on one side only, and unequal actuals.

    Both sides are folded by key in one aggregation instead of a full join.
    """
    scored = F.col("prediction").isNotNull() & F.col("actual_trip_count").isNotNull()
    sides = [
        df.where((F.col("split") == "test") & scored).select(
            *KEY, F.lit(side).alias("side"), "actual_trip_count"
        )
        for side, df in (("model", model), ("baseline", baseline))
    ]
    is_model, is_baseline = F.col("side") == "model", F.col("side") == "baseline"
    by_key = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*KEY)
        .agg(
            count_where(is_model).alias("model_rows"),
            count_where(is_baseline).alias("baseline_rows"),
            F.max(F.when(is_model, F.col("actual_trip_count"))).alias("model_actual"),
            F.max(F.when(is_baseline, F.col("actual_trip_count"))).alias("baseline_actual"),
        )
    )
    both = (F.col("model_rows") > 0) & (F.col("baseline_rows") > 0)
    same = F.col("model_actual") == F.col("baseline_actual")
    return by_key.agg(
        F.coalesce(F.sum("model_rows"), F.lit(0)).alias("model_rows"),
        F.coalesce(F.sum("baseline_rows"), F.lit(0)).alias("baseline_rows"),
        count_where(both & same).alias("aligned_keys"),
        count_where(both & ~same).alias("unequal_actual_keys"),
        count_where(F.col("baseline_rows") == 0).alias("model_only_keys"),
        count_where(F.col("model_rows") == 0).alias("baseline_only_keys"),
    ).withColumn(
        "is_aligned",
        (F.col("aligned_keys") == F.col("model_rows"))
        & (F.col("aligned_keys") == F.col("baseline_rows")),
    )


def check_alignment(model: DataFrame, baseline: DataFrame) -> int:
    row = alignment(model, baseline).first()
    if not row.is_aligned:
        raise ContractError(f"the predictors were scored on different rows: {row.asDict()}")
    return row.aligned_keys


def uncovered_zones(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Zones of df that the lookup does not know."""
    return df.select("zone_id").distinct().join(lookup, "zone_id", "left_anti")


def comparison_summary(comparison: DataFrame) -> DataFrame:
    """One row: size and time range, smallest prediction, worst error inconsistency."""
    actual = F.col("actual_trip_count").cast("double")

    def gap(side: str) -> Column:
        again = F.abs(actual - F.col(f"{side}_prediction"))
        return F.max(F.abs(F.col(f"{side}_absolute_error") - again))

    measures = {
        "rows": F.count("*"),
        "first_hour": F.min("target_hour_utc"),
        "last_hour": F.max("target_hour_utc"),
        "least": F.min("model_prediction"),
        "model_gap": gap("model"),
        "baseline_gap": gap("baseline"),
    }
    folds = {
        "first_hour": F.min("first_hour"),
        "last_hour": F.max("last_hour"),
        "least": F.min("least"),
        "model_gap": F.max("model_gap"),
        "baseline_gap": F.max("baseline_gap"),
    }
    found = with_key_counts(comparison, (), measures, folds)
    return found.select(
        F.coalesce("rows", F.lit(0)).alias("rows"),
        "zone_count",
        "hour_count",
        F.col("first_hour").alias("first_target_hour_utc"),
        F.col("last_hour").alias("last_target_hour_utc"),
        rounded(F.col("least")).alias("min_model_prediction"),
        (F.col("model_gap") <= ERROR_TOLERANCE).alias("model_errors_consistent"),
        (F.col("baseline_gap") <= ERROR_TOLERANCE).alias("baseline_errors_consistent"),
    )


def by_predictor(comparison: DataFrame) -> DataFrame:
    """Two rows per compared row, one per predictor, expanded in place."""
    sides = F.array(
        *[
            F.struct(
                F.lit(side).alias("predictor"),
                F.col(f"{side}_absolute_error").alias("absolute_error"),
                F.col(f"{side}_signed_error").alias("signed_error"),
                (F.col("model_prediction_raw") if side == "model" else F.lit(None))
                .cast("double")
                .alias("prediction_raw"),
            )
            for side in ("model", "baseline")
        ]
    )
    return comparison.select(*KEY, "utc_hour", "actual_trip_count", F.inline(sides))


def residual_metrics(comparison: DataFrame) -> DataFrame:
    """One row per predictor: MAE, WAPE, bias, under/over/exact and negative-raw rows."""
    signed = F.col("signed_error")
    sums = (
        by_predictor(comparison)
        .groupBy("predictor")
        .agg(
            F.count("*").alias("scored_rows"),
            F.sum("actual_trip_count").alias("actual_sum"),
            F.avg("absolute_error").alias("mae"),
            F.sum("absolute_error").alias("error_sum"),
            F.avg("signed_error").alias("bias"),
            count_where(signed < 0).alias("underprediction_rows"),
            count_where(signed > 0).alias("overprediction_rows"),
            count_where(signed == 0).alias("exact_rows"),
            count_where(F.col("prediction_raw") < 0).alias("negative_raw_rows"),
        )
    )
    rows = F.col("scored_rows")
    is_model = F.col("predictor") == "model"
    return sums.select(
        "predictor",
        "scored_rows",
        "actual_sum",
        rounded(F.col("mae")).alias("mae"),
        rounded(ratio(F.col("error_sum"), F.col("actual_sum"))).alias("wape"),
        rounded(F.col("error_sum")).alias("absolute_error_sum"),
        rounded(F.col("bias")).alias("mean_signed_error"),
        "underprediction_rows",
        rounded(ratio(F.col("underprediction_rows"), rows)).alias("underprediction_rate"),
        "overprediction_rows",
        rounded(ratio(F.col("overprediction_rows"), rows)).alias("overprediction_rate"),
        "exact_rows",
        F.when(is_model, F.col("negative_raw_rows")).alias("negative_raw_prediction_rows"),
        F.when(is_model, rounded(ratio(F.col("negative_raw_rows"), rows))).alias(
            "negative_raw_prediction_rate"
        ),
    )


def residual_quantiles(
    comparison: DataFrame, probabilities: tuple[float, ...] = QUANTILES
) -> DataFrame:
    """Exact interpolated quantiles of the absolute error per predictor."""
    return exact_quantiles(
        by_predictor(comparison), "absolute_error", probabilities, ("predictor",)
    ).select("predictor", "probability", rounded(F.col("quantile")).alias("absolute_error"))


def subgroup_metrics(comparison: DataFrame, *keys: str) -> DataFrame:
    """Both predictors side by side per group, and the MAE improvement to 12 digits."""
    sides = ("model", "baseline")
    aggregates = [
        F.count("*").alias("scored_rows"),
        F.sum("actual_trip_count").alias("actual_sum"),
    ]
    for side in sides:
        signed = F.col(f"{side}_signed_error")
        aggregates += [
            F.avg(f"{side}_absolute_error").alias(f"__{side}_mae"),
            F.sum(f"{side}_absolute_error").alias(f"__{side}_sum"),
            F.avg(signed).alias(f"__{side}_bias"),
            count_where(signed < 0).alias(f"{side}_underprediction_rows"),
            count_where(signed > 0).alias(f"{side}_overprediction_rows"),
        ]
    columns = [*keys, "scored_rows", "actual_sum"]
    for side in sides:
        columns += [
            rounded(F.col(f"__{side}_mae")).alias(f"{side}_mae"),
            rounded(ratio(F.col(f"__{side}_sum"), F.col("actual_sum"))).alias(f"{side}_wape"),
            rounded(F.col(f"__{side}_bias")).alias(f"{side}_mean_signed_error"),
            f"{side}_underprediction_rows",
            f"{side}_overprediction_rows",
        ]
    gain = rounded(F.col("__baseline_mae") - F.col("__model_mae"), 12)
    columns.append(gain.alias("mae_improvement"))
    return comparison.groupBy(*keys).agg(*aggregates).select(*columns)


def zone_metrics(comparison: DataFrame, lookup: DataFrame) -> DataFrame:
    """Subgroup metrics by zone, with the lookup attributes of the zone."""
    dimension = lookup.select("zone_id", "borough", "zone_name", "service_zone")
    return subgroup_metrics(comparison, "zone_id").join(dimension, "zone_id", "left")


def hour_metrics(comparison: DataFrame) -> DataFrame:
    return subgroup_metrics(comparison, "utc_hour")


def win_loss(by_zone: DataFrame) -> DataFrame:
    """One row: zones where the model is better, tied and worse."""
    gain = F.col("mae_improvement")
    return by_zone.agg(
        count_where(gain > 0).alias("model_better_zones"),
        count_where(gain == 0).alias("tied_zones"),
        count_where(gain < 0).alias("model_worse_zones"),
    )


def check_top(n: int) -> int:
    if n < 1:
        raise ParameterError("top n must be at least 1")
    return n


def worst_zones(by_zone: DataFrame, n: int) -> DataFrame:
    return by_zone.orderBy(F.desc("model_mae"), "zone_id").limit(check_top(n))


def top_improvements(by_zone: DataFrame, n: int) -> DataFrame:
    wins = by_zone.where(F.col("mae_improvement") > 0)
    return wins.orderBy(F.desc("mae_improvement"), "zone_id").limit(check_top(n))


def regressions(by_zone: DataFrame, n: int) -> DataFrame:
    losses = by_zone.where(F.col("mae_improvement") < 0)
    return losses.orderBy("mae_improvement", "zone_id").limit(check_top(n))


def worst_hours(by_hour: DataFrame, n: int) -> DataFrame:
    return by_hour.orderBy(F.desc("model_mae"), "utc_hour").limit(check_top(n))


def side_by_side(metrics: DataFrame) -> DataFrame:
    """The two-row residual metrics as one row of model_* and baseline_* columns."""

    def pick(side: str, name: str) -> Column:
        return F.max(F.when(F.col("predictor") == side, F.col(name))).alias(f"{side}_{name}")

    return metrics.agg(
        *[pick(side, name) for name in ("mae", "wape") for side in ("model", "baseline")]
    )


def improvement(metrics: DataFrame) -> DataFrame:
    """One row per metric: both values, absolute and relative improvement."""

    def row(name: str) -> Column:
        model, baseline = F.col(f"model_{name}"), F.col(f"baseline_{name}")
        return F.struct(
            F.lit(name).alias("metric"),
            baseline.alias("baseline"),
            model.alias("model"),
            rounded(baseline - model).alias("absolute_improvement"),
            rounded(ratio(baseline - model, baseline)).alias("relative_improvement"),
        )

    return side_by_side(metrics).select(F.inline(F.array(row("mae"), row("wape"))))


def decision(metrics: DataFrame) -> DataFrame:
    """One row naming the predictor to serve: lower MAE, then lower WAPE; ties go to the baseline.

    A NULL WAPE (no actual demand) never wins a tie.
    """
    model_mae, baseline_mae = F.col("model_mae"), F.col("baseline_mae")
    wins = (model_mae < baseline_mae) | (
        (model_mae == baseline_mae) & (F.col("model_wape") < F.col("baseline_wape"))
    )
    return side_by_side(metrics).withColumn(
        "serving_winner", F.when(wins, "model").otherwise("baseline")
    )


def metric_mismatches(
    recomputed: DataFrame, recorded: DataFrame, keys: tuple[str, ...], names: tuple[str, ...]
) -> DataFrame:
    """Recorded metrics that are absent or differ from a recomputation beyond 1e-6."""
    stored = recorded.select(
        *keys, F.lit(True).alias("__recorded"), *[F.col(n).alias(f"recorded_{n}") for n in names]
    )
    again = recomputed.select(*keys, F.lit(True).alias("__recomputed"), *names)
    tests = [F.col("__recorded").isNull() | F.col("__recomputed").isNull()]
    for name in names:
        new, old = F.col(name), F.col(f"recorded_{name}")
        tests.append(new.isNull() != old.isNull())
        tests.append(F.coalesce(F.abs(new - old) > METRIC_TOLERANCE, F.lit(False)))
    return (
        again.join(stored, list(keys), "full_outer")
        .where(reduce(lambda a, b: a | b, tests))
        .drop("__recorded", "__recomputed")
    )


def check_predictions(predictions: DataFrame) -> None:
    """Raise on repeated keys, NULLs or values without end in a model prediction table."""
    endless = F.lit(False)
    for name in ("prediction_raw", "prediction", "absolute_error"):
        endless = endless | F.isnan(name) | (F.abs(name) == F.lit(float("inf")))
    nulls = predictions.where(any_null(MODEL_PREDICTIONS.names) | endless)
    if not duplicate_keys(predictions).isEmpty() or not nulls.isEmpty():
        raise ContractError("prediction table repeats a key or lacks a finite value")
