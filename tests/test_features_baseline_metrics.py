import random

import pytest
from frames import grid_frame, rows_of, splits, utc
from pyspark.sql import functions as F

from hourgrid.errors import ContractError, ParameterError
from hourgrid.operators import baseline, features, grid, integrity, metrics
from hourgrid.operators.splits import (
    Splits,
    assign_splits,
    assign_splits_by_range,
    check_splits,
)

LONG = splits("2026-01-01T00:00", "2026-01-06T00:00", "2026-01-07T16:00", "2026-01-09T08:00")
SHORT = splits("2026-01-01T00:00", "2026-01-01T04:00", "2026-01-01T06:00", "2026-01-01T08:00")


def table(spark, counts):
    return features.build_features(assign_splits(grid_frame(spark, counts), LONG))


def row_at(df, index):
    hour = (F.lit("2026-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.lit(index)))
    return df.where(F.col("target_hour_utc") == hour).first()


def test_feature_values_of_one_row(spark):
    row = row_at(table(spark, list(range(200))), 170)
    assert (row.utc_hour, row.utc_day_of_week, row.utc_month, row.is_weekend) == (2, 4, 1, False)
    assert (row.lag_1h, row.lag_24h, row.lag_168h) == (169, 146, 2)
    assert (row.rolling_mean_24h, row.rolling_mean_168h) == (157.5, 85.5)
    assert row.features_complete


def test_weekend_and_sunday(spark):
    row = row_at(table(spark, list(range(200))), 3 * 24 + 5)
    assert (row.utc_day_of_week, row.is_weekend, row.features_complete) == (7, True, False)


def test_own_and_later_counts_never_reach_a_feature(spark):
    counts = list(range(200))
    changed = list(counts)
    changed[170], changed[190] = 999, 777
    before, after = table(spark, counts), table(spark, changed)
    for index in (169, 170):
        a, b = row_at(before, index).asDict(), row_at(after, index).asDict()
        a.pop("target_trip_count"), b.pop("target_trip_count")
        assert a == b
    assert row_at(after, 171).lag_1h == 999


def test_a_missing_hour_blanks_the_windows_over_it(spark):
    counts = list(range(200))
    counts[169] = None
    built = table(spark, counts)
    row = row_at(built, 170)
    assert (row.lag_1h, row.rolling_mean_24h, row.rolling_mean_168h) == (None, None, None)
    assert (row.lag_24h, row.lag_168h, row.features_complete) == (146, 2, False)
    report = {r.split: r for r in features.feature_report(built).collect()}
    assert report["test"].missing_lag_1h == 1
    assert report["test"].complete_feature_rows == 2
    assert report["test"].training_eligible_rows == 1


def random_grid(spark, zones=4, hours=400, gap=0.02, seed=7):
    rng = random.Random(seed)
    frame = None
    for zone in range(1, zones + 1):
        counts = [None if rng.random() < gap else rng.randrange(50) for _ in range(hours)]
        part = grid_frame(spark, counts, zone)
        frame = part if frame is None else frame.unionByName(part)
    return frame


def test_running_sums_equal_sliding_frames(spark):
    base = random_grid(spark).select(
        "zone_id", "target_hour_utc", F.col("trip_count").alias("target_trip_count")
    )
    fast = features.with_rolling_means(base, (5, 24, 168))
    slow = features.with_sliding_means(base, (5, 24, 168))
    assert grid.bag_diff_rows(fast, slow).first()[0] == 0
    assert fast.where("rolling_mean_24h is not null").count() > 0


def test_time_lag_equals_shifted_join_even_with_holes(spark):
    frame = random_grid(spark)
    holed = frame.where(F.pmod(F.xxhash64("zone_id", "target_hour_utc"), F.lit(5)) != 0)
    assigned = assign_splits(holed, LONG)
    keys = ["zone_id", "target_hour_utc", "seasonal_lag_trip_count"]
    by_frame = baseline.with_history(assigned, 30).select(*keys)
    by_join = baseline.lag_by_join(holed, 30).select(*keys)
    assert grid.bag_diff_rows(by_frame, by_join).first()[0] == 0


def test_train_mean_window_equals_grouping(spark):
    assigned = assign_splits(random_grid(spark), LONG)
    grouped = dict(rows_of(baseline.train_zone_means(assigned)))
    windowed = baseline.with_history(assigned).select("zone_id", "train_zone_mean").distinct()
    assert dict(rows_of(windowed)) == pytest.approx(grouped)


def test_feature_violations_are_found(spark):
    good = table(spark, list(range(200)))
    features.check_features(good)
    with pytest.raises(ContractError):
        features.check_features(good.withColumn("lag_1h", F.col("lag_1h") - 50))
    with pytest.raises(ContractError):
        features.check_features(good.withColumn("features_complete", F.lit(True)))


def test_split_assignment_two_ways(spark):
    frame = grid_frame(spark, list(range(200)))
    by_case = assign_splits(frame, LONG).select("target_hour_utc", "split")
    by_range = assign_splits_by_range(frame, LONG).select("target_hour_utc", "split")
    assert grid.bag_diff_rows(by_case, by_range).first()[0] == 0
    check_splits(assign_splits(frame, LONG))
    with pytest.raises(ContractError):
        check_splits(assign_splits(grid_frame(spark, list(range(201))), LONG))


def test_bad_splits_are_rejected():
    a, b, c, d = (utc(f"2026-01-0{i}") for i in range(1, 5))
    with pytest.raises(ParameterError):
        Splits((a, b), (c, d), (d, utc("2026-01-05")))
    with pytest.raises(ParameterError):
        Splits((b, a), (a, c), (c, d))
    with pytest.raises(ParameterError):
        Splits((a.replace(tzinfo=None), b), (b, c), (c, d))
    with pytest.raises(ParameterError):
        Splits((a.replace(minute=30), b), (b, c), (c, d))


def naive(spark, counts):
    return baseline.seasonal_naive(assign_splits(grid_frame(spark, counts), SHORT), 2)


def predictions(df):
    ordered = df.orderBy("target_hour_utc").collect()
    return [r.prediction for r in ordered], [r.prediction_source for r in ordered]


def test_fallback_chain(spark):
    table_ = naive(spark, [10, 20, None, 40, 50, 60, 70, 80])
    values, sources = predictions(table_)
    assert values[0] is None and sources[0] == "unavailable"
    assert (values[1], sources[1]) == (10.0, "prior_zone_mean")
    assert values[4] == pytest.approx(70 / 3) and sources[4] == "train_zone_mean"
    assert (values[6], sources[6]) == (50.0, "seasonal_lag")
    report = {r.split: r for r in metrics.split_metrics(table_).collect()}
    assert (report["validation"].fallback_rows, report["validation"].fallback_rate) == (1, 0.5)
    counts = {(r.split, r.prediction_source): r.rows for r in metrics.source_counts(table_).collect()}
    assert counts[("validation", "train_zone_mean")] == 1


def test_later_counts_do_not_change_earlier_predictions(spark):
    values, _ = predictions(naive(spark, [10, 20, None, 40, 500, 60, 70, 800]))
    assert values[4] == pytest.approx(70 / 3)
    assert (values[6], values[7]) == (500.0, 60.0)


def test_wape_is_unknown_without_demand(spark):
    table_ = naive(spark, [0, 0, None, 0, 0, 0, 0, 0])
    report = {r.split: r for r in metrics.split_metrics(table_).collect()}
    assert (report["train"].missing_target_rows, report["train"].scored_rows) == (1, 2)
    assert (report["train"].mae, report["train"].wape) == (0.0, None)
    assert metrics.mae_by_hour(table_).where("split = 'test'").count() == 2
    metrics.check_scored(metrics.split_metrics(table_))


def test_unscored_split_is_rejected(spark):
    table_ = naive(spark, [1, 2, 3, 4, None, None, 5, 6])
    with pytest.raises(ContractError):
        metrics.check_scored(metrics.split_metrics(table_))
    assert metrics.mae_by_zone(table_).where("scored_rows = 0").count() == 1


def test_lag_must_be_positive(spark):
    with pytest.raises(ParameterError):
        naive_frame = assign_splits(grid_frame(spark, [1] * 8), SHORT)
        baseline.seasonal_naive(naive_frame, 0)


def test_leakage_probe(spark):
    frame = random_grid(spark, zones=2, hours=200, gap=0.0)
    hour = utc("2026-01-08T02:00")

    def honest(g):
        return features.build_features(assign_splits(g, LONG))

    def leaky(g):
        built = honest(g)
        return built.withColumn("lag_1h", F.col("target_trip_count"))

    assert integrity.leakage_probe(frame, honest, hour).isEmpty()
    assert integrity.leakage_probe(frame, leaky, hour).count() == 4


def test_lags_and_means_on_a_frame_with_missing_hours(spark):
    holed = random_grid(spark, zones=3, hours=260).where(
        F.pmod(F.xxhash64("zone_id", "target_hour_utc"), F.lit(9)) != 0
    )
    late = F.col("target_hour_utc") > F.lit("2026-01-05 00:00:00").cast("timestamp")
    holed = holed.where(~((F.col("zone_id") == 2) & ~late))  # a zone that begins late
    base = holed.select("zone_id", "target_hour_utc", F.col("trip_count").alias("target_trip_count"))
    out = features.with_rolling_means(features.with_lags(base, (1, 24)), (3, 24)).collect()
    hour = lambda r: int(r.target_hour_utc.timestamp()) // 3600
    known = {(r.zone_id, hour(r)): r.target_trip_count for r in out}
    found = 0
    for r in out:
        for n in (1, 24):
            assert r[f"lag_{n}h"] == known.get((r.zone_id, hour(r) - n))
        for n in (3, 24):
            before = [known.get((r.zone_id, hour(r) - k)) for k in range(1, n + 1)]
            mean = None if None in before else sum(before) / n
            assert r[f"rolling_mean_{n}h"] == mean
            found += mean is not None
    assert found > 50


def test_distinct_counts_expand_no_rows(spark):
    from hourgrid.functions.scoring import with_key_counts
    from hourgrid.plans.registry import REGISTRY

    for name in ("split_metrics", "feature_report", "comparison_summary", "served_validation"):
        plan = REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        assert "Expand" not in plan.executedPlan().toString(), name
    rows = [("a", 1, 5, 2.0), ("a", 1, 6, None), ("a", 2, 5, 1.0), ("b", None, 7, 4.0), ("b", 3, None, 9.0)]
    frame = spark.createDataFrame(rows, "split string, zone_id int, target_hour_utc int, x double")
    found = with_key_counts(
        frame, ("split",), {"rows": F.count("*"), "sum": F.sum("x"), "least": F.min("x")}, {"least": F.min("least")}
    )
    assert sorted(rows_of(found)) == [("a", 3, 3.0, 1.0, 2, 2), ("b", 2, 13.0, 4.0, 1, 1)]
    nothing = with_key_counts(frame.limit(0), (), {"rows": F.count("*")}, {}).first()
    assert (nothing.rows, nothing.zone_count, nothing.hour_count) == (None, 0, 0)
