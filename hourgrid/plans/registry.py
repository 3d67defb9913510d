"""Every operator as a query over the driver tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.calendar import dst_calendar, instant
from hourgrid.operators import (
    baseline,
    classify,
    compare,
    counts,
    features,
    grid,
    integrity,
    metrics,
    model,
    profile,
    serve,
    splits,
)
from hourgrid.plans.workload import (
    GAP_DAYS,
    MONTHS_DAYS,
    OVERLAP_DAYS,
    SPECIAL,
    SPLITS,
    TZ,
    Workload,
)
from hourgrid.schemas import KEY, MODEL_PREDICTIONS
from hourgrid.session import configure, ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]

TOP_N = 10
FORECAST_ZONE = 3
FORECAST_HOUR = datetime(2024, 1, 25, 17, tzinfo=UTC)
HISTORY_HOURS = 48
PROBE_HOUR = datetime(2024, 1, 19, 12, tzinfo=UTC)

REGISTRY: dict[str, Query] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """UTC timestamps as TIMESTAMP_NTZ, so a result reads the same in any session zone."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema
        ]
    )


def query(build: Callable[[Workload], DataFrame]) -> Callable[[Workload], DataFrame]:
    """Register a query under the name of its function."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(build(Workload(configure(spark), sf_dir)))

    REGISTRY[build.__name__] = run
    return build


def shifted(w: Workload, days: int) -> Workload:
    return Workload(w.spark, w.sf_dir, days)


# --- profile -----------------------------------------------------------------


@query
def raw_profile(w):
    return profile.raw_profile(w.events, w.window)


def _zone_cells(w):
    return profile.zone_cells(w.events, w.lookup, w.window, special=SPECIAL)


@query
def zone_profile(w):
    return profile.zone_profile(_zone_cells(w))


@query
def invalid_zone_breakdown(w):
    return profile.invalid_zones(_zone_cells(w))


@query
def hourly_coverage(w):
    return profile.hourly_coverage(w.events, w.window)


@query
def daily_coverage(w):
    return profile.daily_coverage(profile.hourly_coverage(w.events, w.window))


@query
def missing_hours(w):
    return profile.missing_hours(profile.hourly_coverage(w.events, w.window), w.window)


@query
def coverage_summary(w):
    return profile.coverage_summary(profile.hourly_coverage(w.events, w.window), w.window)


# --- calendar and classification ---------------------------------------------


@query
def dst_calendar_hours(w):
    """Clock-change hours met by the events of both shifts, with their rows."""
    found = []
    for days in (GAP_DAYS, OVERLAP_DAYS):
        hours = (
            shifted(w, days)
            .events.groupBy(F.date_trunc("hour", F.col("pickup_ts")).alias("hour"))
            .agg(F.count("*").alias("rows"))
        )
        found.append(
            dst_calendar(hours, "hour", TZ).select("kind", "start_local", "end_local", "rows")
        )
    return found[0].unionByName(found[1])


def _labelled(w):
    hot = classify.hot_zones(w.events)
    return classify.label_dispositions(w.events, w.lookup, w.window, special=SPECIAL, hot=hot)


@query
def label_rows_gap(w):
    w = shifted(w, GAP_DAYS)
    rows = _labelled(w)
    return rows.select("event_id", "pickup_ts", "zone_raw", "disposition")


@query
def label_rows_overlap(w):
    w = shifted(w, OVERLAP_DAYS)
    rows = _labelled(w)
    return rows.select("event_id", "pickup_ts", "zone_raw", "disposition")


@query
def dispositions(w):
    return classify.disposition_counts(w.cells)


@query
def dispositions_gap(w):
    return classify.disposition_counts(shifted(w, GAP_DAYS).cells)


@query
def dispositions_overlap(w):
    return classify.disposition_counts(shifted(w, OVERLAP_DAYS).cells)


@query
def monthly_totals(w):
    return classify.monthly_totals(shifted(w, MONTHS_DAYS).month_cells)


# --- counts ------------------------------------------------------------------


@query
def hourly_counts(w):
    return w.counts


@query
def hourly_counts_gap(w):
    return shifted(w, GAP_DAYS).counts


@query
def hourly_counts_overlap(w):
    return shifted(w, OVERLAP_DAYS).counts


@query
def hourly_counts_months(w):
    return counts.hourly_counts(shifted(w, MONTHS_DAYS).month_cells)


@query
def source_activity(w):
    return w.activity


@query
def duplicate_keys(w):
    """Zone-hours hit by more than one row of the raw events."""
    rows = _labelled(w)
    hour = F.date_trunc("hour", F.to_utc_timestamp("pickup_ts", TZ))
    keyed = rows.where(F.col("disposition") == "retained").select(
        F.col("zone_raw").alias("zone_id"), hour.alias("target_hour_utc")
    )
    return counts.duplicate_keys(keyed)


@query
def counts_summary(w):
    return counts.counts_summary(w.counts)


@query
def conservation(w):
    return counts.conservation(w.counts, w.cells)


@query
def trips_by_zone(w):
    return w.counts.groupBy("zone_id").agg(F.sum("trip_count").alias("trips")).orderBy("zone_id")


# --- grid --------------------------------------------------------------------


@query
def lookup_audit(w):
    return grid.lookup_audit(w.lookup)


@query
def service_entities(w):
    return grid.service_entities(w.lookup, SPECIAL)


@query
def coverage_status(w):
    return w.coverage.select("target_hour_utc", "source_rows", "source_status")


@query
def coverage_status_overlap(w):
    return shifted(w, OVERLAP_DAYS).coverage.select(
        "target_hour_utc", "source_rows", "source_status"
    )


@query
def uncovered_hours(w):
    return grid.uncovered_hours(w.coverage)


@query
def full_grid(w):
    return w.grid


@query
def full_grid_gap(w):
    return shifted(w, GAP_DAYS).grid


@query
def full_grid_overlap(w):
    return shifted(w, OVERLAP_DAYS).grid


@query
def grid_summary(w):
    return grid.grid_summary(w.grid)


@query
def grid_summary_overlap(w):
    return grid.grid_summary(shifted(w, OVERLAP_DAYS).grid)


@query
def grid_shape_check(w):
    return grid.hour_shapes(w.grid)


@query
def grid_validation(w):
    return grid.validate_grid(w.grid, SPLITS.start, SPLITS.end)


@query
def bag_diff(w):
    """Counts with and without the daylight-saving shift of a day, row by row."""
    moved = shifted(w, 1).counts.drop("source_month")
    return grid.bag_diff(w.counts.drop("source_month"), moved)


@query
def bag_diff_rows(w):
    """Row-level recount against the cell-level counts: nothing may differ."""
    rows = _labelled(w)
    hour = F.date_trunc("hour", F.to_utc_timestamp("pickup_ts", TZ))
    recounted = (
        rows.where(F.col("disposition") == "retained")
        .groupBy(F.col("zone_raw").alias("zone_id"), hour.alias("target_hour_utc"))
        .agg(F.count("*").alias("trip_count"))
    )
    return grid.bag_diff_rows(w.counts.drop("source_month"), recounted)


# --- splits and features -----------------------------------------------------


@query
def split_assignment(w):
    return w.assigned.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.min("target_hour_utc").alias("first_hour"),
        F.max("target_hour_utc").alias("last_hour"),
    )


@query
def split_assignment_by_range(w):
    return splits.assign_splits_by_range(w.grid, SPLITS).select(*KEY, "split")


@query
def split_coverage(w):
    return splits.split_coverage(w.assigned)


@query
def calendar_features(w):
    return features.with_calendar(w.grid.select(*KEY))


def _targets(w):
    return w.assigned.select(
        *KEY, "split", F.col("trip_count").alias("target_trip_count"), "source_status"
    )


@query
def lag_features(w):
    return features.with_lags(_targets(w)).drop("split", "source_status")


@query
def rolling_features(w):
    return features.with_rolling_means(_targets(w)).drop("split", "source_status")


@query
def sliding_features(w):
    return features.with_sliding_means(_targets(w)).drop("split", "source_status")


@query
def feature_table(w):
    return w.features


@query
def feature_report(w):
    return features.feature_report(w.features)


@query
def feature_contract(w):
    return features.feature_violations(w.features)


@query
def training_rows(w):
    return features.training_rows(w.features, "train", "validation").select(
        *KEY, "split", "target_trip_count", "rolling_mean_24h", "rolling_mean_168h"
    )


# --- baseline ----------------------------------------------------------------


@query
def seasonal_naive(w):
    return w.baseline


@query
def lag_by_join(w):
    return baseline.lag_by_join(w.grid.select(*KEY, "trip_count"), 168)


@query
def prior_mean(w):
    return baseline.with_history(w.assigned).select(*KEY, "prior_zone_mean")


@query
def train_zone_mean(w):
    return baseline.train_zone_means(w.assigned)


@query
def split_metrics(w):
    return metrics.split_metrics(w.baseline)


@query
def source_counts(w):
    return metrics.source_counts(w.baseline)


@query
def mae_by_zone(w):
    return metrics.mae_by_zone(w.baseline)


@query
def mae_by_hour(w):
    return metrics.mae_by_hour(w.baseline)


@query
def forecast_metrics(w):
    return metrics.forecast_metrics(w.model, "split")


# --- comparison --------------------------------------------------------------


def _comparison(w):
    return compare.align_predictions(w.model, w.baseline)


def _by_zone(w):
    return compare.zone_metrics(_comparison(w), w.lookup)


@query
def blend_predictions(w):
    return w.model


@query
def prediction_audit(w):
    audit = compare.prediction_audit(w.model)
    lists = ["splits", "candidate_names", "fit_scopes"]
    return audit.withColumns({name: F.array_join(name, ",") for name in lists})


@query
def baseline_audit(w):
    return compare.baseline_audit(w.baseline)


@query
def prediction_alignment(w):
    return compare.alignment(w.model, w.baseline)


@query
def prediction_compare(w):
    return _comparison(w)


@query
def uncovered_zones(w):
    """Zones of the raw events that the lookup does not know."""
    known = w.events.where(F.col("zone_raw").isNotNull())
    return compare.uncovered_zones(known.select(F.col("zone_raw").alias("zone_id")), w.lookup)


@query
def comparison_summary(w):
    return compare.comparison_summary(_comparison(w))


@query
def residual_metrics(w):
    return compare.residual_metrics(_comparison(w))


@query
def residual_quantiles(w):
    return compare.residual_quantiles(_comparison(w))


@query
def zone_metrics(w):
    return _by_zone(w)


@query
def hour_metrics(w):
    return compare.hour_metrics(_comparison(w))


@query
def win_loss(w):
    return compare.win_loss(_by_zone(w))


@query
def worst_zones(w):
    return compare.worst_zones(_by_zone(w), TOP_N)


@query
def top_improvements(w):
    return compare.top_improvements(_by_zone(w), TOP_N)


@query
def regressions(w):
    return compare.regressions(_by_zone(w), TOP_N)


@query
def worst_hours(w):
    return compare.worst_hours(compare.hour_metrics(_comparison(w)), TOP_N)


@query
def improvement(w):
    return compare.improvement(compare.residual_metrics(_comparison(w)))


@query
def decision(w):
    return compare.decision(compare.residual_metrics(_comparison(w)))


@query
def metric_mismatches(w):
    """Metrics of all scored test rows against those of the aligned rows."""
    wide = metrics.split_metrics(w.baseline).where(F.col("split") == "test")
    aligned = compare.residual_metrics(_comparison(w)).where(F.col("predictor") == "baseline")
    recorded = wide.select(F.lit("baseline").alias("predictor"), "mae", "wape")
    return compare.metric_mismatches(aligned, recorded, ("predictor",), ("mae", "wape"))


# --- read queries ------------------------------------------------------------


def _store(w):
    served = serve.served_predictions(w.baseline)
    return serve.ForecastStore(served, w.lookup, SPLITS.test[0], SPLITS.test[1])


@query
def store_summary(w):
    return _store(w).summary("seasonal_naive")


@query
def served_validation(w):
    return serve.served_validation(serve.served_predictions(w.baseline))


@query
def zones_served(w):
    return _store(w).zones()


@query
def forecast_point(w):
    return _store(w).forecast(FORECAST_ZONE, FORECAST_HOUR)


@query
def rankings(w):
    return _store(w).rankings(FORECAST_HOUR, TOP_N)


@query
def rankings_all_hours(w):
    return _store(w).rankings_all_hours(TOP_N)


@query
def ranking_share(w):
    return _store(w).ranking_share(FORECAST_HOUR, TOP_N)


@query
def zone_rank(w):
    return _store(w).zone_rank(FORECAST_ZONE, FORECAST_HOUR)


@query
def history_window(w):
    return _store(w).history(FORECAST_ZONE, FORECAST_HOUR, HISTORY_HOURS)


@query
def history_mae(w):
    return _store(w).history_mae(FORECAST_ZONE, FORECAST_HOUR, HISTORY_HOURS)


@query
def history_all_zones(w):
    return _store(w).history_all_zones(FORECAST_HOUR, HISTORY_HOURS)


@query
def served_by_decision(w):
    """Rows of the predictor that the decision names; only its partition is scanned."""
    folder = f"{ensure_checkpoint_dir(w.spark)}/predictors-{uuid.uuid4().hex}"
    serve.write_predictors(w.model, w.baseline, folder)
    model_side, baseline_side = (
        serve.read_predictor(w.spark, folder, name) for name in ("model", "baseline")
    )
    comparison = compare.align_predictions(model_side, baseline_side)
    verdict = compare.decision(compare.residual_metrics(comparison))
    return serve.served_by_decision(w.spark, folder, verdict)


# --- integrity ---------------------------------------------------------------


@query
def fingerprint(w):
    """Builds of the grid in different partitionings must agree in rows and content."""
    first, second = (integrity.manifest({"grid": w.grid_in(parts)}) for parts in (None, 5))
    changed = integrity.manifest_check(first, second).select("dataset", F.lit(True).alias("x"))
    return first.join(changed, "dataset", "left").select(
        "dataset", "rows", F.col("x").isNull().alias("is_reproducible")
    )


@query
def manifest_check(w):
    """Counts of the window recorded, then checked against a window moved by a day."""
    recorded = integrity.manifest({"counts": w.counts, "lookup": w.lookup, "extra": w.coverage})
    current = integrity.manifest({"counts": shifted(w, 1).counts, "lookup": w.lookup})
    return integrity.manifest_check(recorded, current)


@query
def leakage_probe(w):
    return integrity.leakage_probe(
        w.grid,
        lambda g: features.build_features(splits.assign_splits(g, SPLITS)),
        PROBE_HOUR,
    )


@query
def leakage_probe_effect(w):
    """The same change does reach the features after the probed hour."""
    build = features.build_features
    before, after = (
        build(splits.assign_splits(g, SPLITS))
        .where(F.col("target_hour_utc") > instant(PROBE_HOUR))
        .select(*KEY, "lag_1h")
        for g in (w.grid, integrity.perturb_from(w.grid, PROBE_HOUR, 1000))
    )
    return grid.bag_diff_rows(before, after)


# --- model selection ---------------------------------------------------------


def _selection(w):
    prepared = model.prepare(w.features)
    if not model.has_history(prepared):
        return prepared, None
    return prepared, model.select_candidate(prepared)


@query
def candidate_metrics(w):
    """Without a full week of history no row is eligible, and no candidate is fitted."""
    chosen = _selection(w)[1]
    if chosen is None:
        return w.spark.createDataFrame([], model.CANDIDATE_REPORT)
    return model.candidate_report(chosen)


@query
def model_predictions(w):
    prepared, chosen = _selection(w)
    if chosen is None:
        return w.spark.createDataFrame([], MODEL_PREDICTIONS)
    return model.model_predictions(prepared, chosen)[0]


@query
def model_contract(w):
    """Rows, keys, scope and broken values of the model's predictions, by split."""
    prepared, chosen = _selection(w)
    if chosen is None:
        rows = w.spark.createDataFrame([], MODEL_PREDICTIONS)
    else:
        rows = model.model_predictions(prepared, chosen)[0]
    gap = F.abs(F.col("absolute_error") - F.abs(F.col("actual_trip_count") - F.col("prediction")))
    finite = F.abs("prediction") < F.lit(float("inf"))
    keys = rows.groupBy("split", "fit_scope", *KEY).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("prediction") < 0).alias("negative"),
        F.count_if((gap > 1e-9) | ~finite).alias("odd"),
    )
    return keys.groupBy("split", "fit_scope").agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("unique_keys"),
        F.sum("negative").alias("negative_rows"),
        F.sum("odd").alias("inconsistent_rows"),
    )


@query
def candidate_choice(w):
    """The choice rule over two predictors without a model: means of a day and of a week."""
    rows = features.training_rows(w.features, "validation")
    sides = [
        rows.select(
            F.lit(name).alias("candidate_name"),
            F.col("target_trip_count").alias("actual_trip_count"),
            F.abs(F.col("target_trip_count") - F.col(column)).alias("absolute_error"),
        )
        for name, column in (("day", "rolling_mean_24h"), ("week", "rolling_mean_168h"))
    ]
    scored = metrics.forecast_metrics(sides[0].unionByName(sides[1]), "candidate_name")
    return model.choose(scored.select("candidate_name", "scored_rows", "mae", "wape"))
