import random

import pytest
from frames import lookup, rows_of, utc
from pyspark.sql import functions as F

from hourgrid.errors import ContractError, ParameterError
from hourgrid.functions.quantiles import exact_quantiles
from hourgrid.operators import compare, integrity, serve
from hourgrid.schemas import MODEL_PREDICTIONS

HOURS = ("2026-03-16T04:00", "2026-03-16T05:00")
KEYS = [(1, HOURS[0]), (1, HOURS[1]), (2, HOURS[0]), (2, HOURS[1])]
ACTUAL = [10, 10, 1, 0]


def model_frame(spark, raw=(11.0, 10.0, 2.0, -0.5), actual=ACTUAL):
    rows = [
        (z, utc(h), "test", a, p, max(p, 0.0), abs(a - max(p, 0.0)), "depth4", "train_validation")
        for (z, h), a, p in zip(KEYS, actual, raw)
    ]
    rows += [
        (z, utc("2026-03-15T04:00"), "validation", 5, 5.0, 5.0, 0.0, "depth4", "train")
        for z in (1, 2)
    ]
    return spark.createDataFrame(rows, MODEL_PREDICTIONS)


def baseline_frame(spark, predicted=(12.0, 12.0, 1.0, 0.0)):
    rows = [
        (z, utc(h), "test", a, p, abs(a - p)) for (z, h), a, p in zip(KEYS, ACTUAL, predicted)
    ]
    return spark.createDataFrame(
        rows,
        "zone_id int, target_hour_utc timestamp, split string, actual_trip_count bigint, "
        "prediction double, absolute_error double",
    )


def zones(spark):
    return lookup(
        spark,
        [(1, "Queens", "Alpha", "Boro"), (2, "Bronx", "Beta", "Boro"), (3, "Bronx", "Gamma", "Boro")],
    )


def test_model_wins(spark):
    rows = compare.align_predictions(model_frame(spark), baseline_frame(spark))
    report = {r.predictor: r for r in compare.residual_metrics(rows).collect()}
    assert (report["model"].mae, report["baseline"].mae) == (0.5, 1.0)
    assert report["model"].negative_raw_prediction_rows == 1
    assert report["model"].exact_rows == 2 and report["baseline"].exact_rows == 2
    by_zone = compare.zone_metrics(rows, zones(spark))
    assert tuple(compare.win_loss(by_zone).first()) == (1, 0, 1)
    assert rows_of(compare.regressions(by_zone, 5), "zone_id", "zone_name") == [(2, "Beta")]
    assert rows_of(compare.top_improvements(by_zone, 5), "zone_id") == [(1,)]
    assert rows_of(compare.worst_zones(by_zone, 1), "zone_id") == [(1,)]
    residuals = compare.residual_metrics(rows)
    assert compare.decision(residuals).first().serving_winner == "model"
    gains = {r.metric: r for r in compare.improvement(residuals).collect()}
    assert gains["mae"].relative_improvement == 0.5
    summary = compare.comparison_summary(rows).first()
    assert (summary.rows, summary.zone_count, summary.hour_count) == (4, 2, 2)
    assert summary.model_errors_consistent and summary.min_model_prediction == 0.0
    assert compare.check_alignment(model_frame(spark), baseline_frame(spark)) == 4


def test_baseline_wins_and_takes_ties(spark):
    worse = compare.align_predictions(model_frame(spark, (14.0, 14.0, 2.0, 0.0)), baseline_frame(spark))
    residuals = compare.residual_metrics(worse)
    assert residuals.where("predictor = 'model'").first().mae == 2.25
    assert compare.decision(residuals).first().serving_winner == "baseline"
    even = compare.align_predictions(model_frame(spark, (12.0, 12.0, 1.0, 0.0)), baseline_frame(spark))
    assert compare.decision(compare.residual_metrics(even)).first().serving_winner == "baseline"


def test_unequal_actuals_are_rejected(spark):
    model = model_frame(spark, actual=[10, 11, 1, 0])
    row = compare.alignment(model, baseline_frame(spark)).first()
    assert (row.aligned_keys, row.unequal_actual_keys, row.is_aligned) == (3, 1, False)
    with pytest.raises(ContractError):
        compare.check_alignment(model, baseline_frame(spark))
    assert compare.align_predictions(model, baseline_frame(spark)).count() == 3


def test_audits(spark):
    model = model_frame(spark)
    row = compare.prediction_audit(model).first()
    assert (row.rows, row.unique_keys, row.null_rows) == (6, 6, 0)
    assert row.splits == ["test", "validation"] and row.fit_scopes == ["train", "train_validation"]
    compare.check_predictions(model)
    with pytest.raises(ContractError):
        compare.check_predictions(model.unionByName(model.limit(1)))
    holed = model.withColumn("prediction", F.when(F.col("zone_id") == 1, F.col("prediction")))
    with pytest.raises(ContractError):
        compare.check_predictions(holed)
    for odd in ("NaN", "Infinity"):
        with pytest.raises(ContractError):
            compare.check_predictions(model.withColumn("prediction_raw", F.lit(odd).cast("double")))
    assert tuple(compare.baseline_audit(baseline_frame(spark)).first()) == (4, 4, 0)
    few = zones(spark).where("zone_id <> 2")
    assert rows_of(compare.uncovered_zones(model, few)) == [(2,)]


def test_metric_tolerance(spark):
    spec = "k string, mae double, wape double"
    again = spark.createDataFrame([("a", 1.0, None), ("b", 1.0, 2.0), ("c", 1.0, 1.0)], spec)
    stored = spark.createDataFrame(
        [("a", 1.0000005, None), ("b", 1.1, 2.0), ("d", 1.0, 1.0)], spec
    )
    odd = compare.metric_mismatches(again, stored, ("k",), ("mae", "wape"))
    assert sorted(r.k for r in odd.collect()) == ["b", "c", "d"]


@pytest.mark.parametrize("shape", ["ties", "spread", "single", "signed"])
def test_quantiles_equal_the_builtin(spark, shape):
    rng = random.Random(3)
    make = {
        "ties": lambda: float(rng.randrange(4)),
        "spread": lambda: rng.expovariate(0.01),
        "single": lambda: 5.0,
        "signed": lambda: rng.gauss(0, 10),
    }[shape]
    size = 1 if shape == "single" else 2000
    rows = [(g, make()) for g in ("a", "b") for _ in range(size)] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    probabilities = (0.0, 0.25, 0.5, 0.9, 0.99, 1.0)
    got = {
        (r.g, r.probability): r.quantile
        for r in exact_quantiles(df, "x", probabilities, ("g",)).collect()
    }
    built_in = df.groupBy("g").agg(F.percentile("x", list(probabilities)).alias("q")).collect()
    want = {(r.g, p): q for r in built_in for p, q in zip(probabilities, r.q)}
    assert got == pytest.approx(want, abs=1e-12)


def test_residual_quantiles(spark):
    rows = compare.align_predictions(model_frame(spark), baseline_frame(spark))
    found = {
        (r.predictor, r.probability): r.absolute_error
        for r in compare.residual_quantiles(rows).collect()
    }
    assert found[("model", 0.5)] == 0.5 and found[("baseline", 0.9)] == 2.0


def served_frame(spark):
    rows = [
        (1, utc(HOURS[0]), 4, 5.0, 1.0),
        (1, utc(HOURS[1]), 8, 6.0, 2.0),
        (2, utc(HOURS[0]), 0, 0.0, 0.0),
        (2, utc(HOURS[1]), 1, 1.5, 0.5),
    ]
    return spark.createDataFrame(
        rows,
        "zone_id int, target_hour_utc timestamp, actual_trip_count bigint, "
        "prediction double, absolute_error double",
    )


def store(spark, served=None):
    return serve.ForecastStore(
        served_frame(spark) if served is None else served,
        zones(spark),
        utc(HOURS[0]),
        utc("2026-03-16T06:00"),
    )


def test_read_queries(spark):
    s = store(spark)
    s.check()
    four, five = utc(HOURS[0]), utc(HOURS[1])
    assert rows_of(s.zones(), "zone_id", "zone_name") == [(1, "Alpha"), (2, "Beta")]
    summary = s.summary("model").first()
    assert (summary.prediction_rows, summary.zone_count) == (4, 2)
    point = s.forecast(1, four).first()
    assert (point.prediction, point.actual_trip_count, point.borough) == (5.0, 4, "Queens")
    assert rows_of(s.rankings(four), "zone_id") == [(1,), (2,)]
    assert rows_of(s.history(1, five, 2), "prediction") == [(5.0,), (6.0,)]
    mae = s.history_mae(1, five, 24).first()
    assert (mae.points, mae.mae) == (2, 1.5)
    assert rows_of(s.zone_rank(2, four), "position") == [(2,)]
    assert rows_of(s.ranking_share(five, 2)) == [(2, 7.5)]
    assert sorted(rows_of(s.rankings_all_hours(1), "zone_id")) == [(1,), (1,)]
    assert sorted(rows_of(s.history_all_zones(five, 2))) == [(1, 2, 2, 1.5), (2, 2, 2, 0.25)]


@pytest.mark.parametrize(
    "ask",
    [
        lambda s: s.forecast(1, utc(HOURS[0]).replace(tzinfo=None)),
        lambda s: s.forecast(1, utc("2026-03-16T04:30")),
        lambda s: s.forecast(1, utc("2026-03-16T03:00")),
        lambda s: s.forecast(1, utc("2026-03-16T06:00")),
        lambda s: s.forecast(3, utc(HOURS[0])),
        lambda s: s.forecast(0, utc(HOURS[0])),
        lambda s: s.rankings(utc(HOURS[0]), 0),
        lambda s: s.rankings(utc(HOURS[0]), 26),
        lambda s: s.history(1, utc(HOURS[0]), 169),
        lambda s: s.history(1, utc(HOURS[0]), 0),
        lambda s: s.history(9, utc(HOURS[0]), 5),
        lambda s: serve.predictions_to_serve("other", s.served, s.served),
    ],
)
def test_bad_parameters(spark, ask):
    with pytest.raises(ParameterError):
        ask(store(spark))


def test_non_utc_offset_is_refused(spark):
    from datetime import timedelta, timezone

    other = utc(HOURS[0]).astimezone(timezone(timedelta(hours=-4)))
    with pytest.raises(ParameterError):
        store(spark).rankings(other)


@pytest.mark.parametrize(
    "damage",
    [
        lambda f: f.unionByName(f.limit(1)),
        lambda f: f.withColumn("absolute_error", F.col("absolute_error") + 1e-6),
        lambda f: f.withColumn("prediction", -F.col("prediction")),
        lambda f: f.where("prediction <> 6"),
        lambda f: f.withColumn("zone_id", F.col("zone_id") + 5),
        lambda f: f.withColumn("actual_trip_count", F.lit(None).cast("bigint")),
    ],
)
def test_damaged_served_tables_are_refused(spark, damage):
    with pytest.raises(ContractError):
        store(spark, damage(served_frame(spark))).check()


def test_top_k_needs_no_full_sort(spark):
    plan = store(spark).rankings(utc(HOURS[0]))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_fingerprint_ignores_order_and_sees_null_places(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "b")], "x int, y string")
    same = df.repartition(3).orderBy("y")
    assert integrity.fingerprint(df).first() == integrity.fingerprint(same).first()
    left = spark.createDataFrame([(None, 1)], "x int, y int")
    right = spark.createDataFrame([(1, None)], "x int, y int")
    assert integrity.fingerprint(left).first() != integrity.fingerprint(right).first()
    twice = df.unionByName(df)
    assert integrity.fingerprint(twice).first().hash_xor == 0
    assert integrity.fingerprint(twice).first().rows == 6


def test_manifest_names_the_first_difference(spark):
    def frame(rows, spec="x int"):
        return spark.createDataFrame(rows, spec)

    recorded = integrity.manifest(
        {"same": frame([(1,)]), "gone": frame([(1,)]), "rows": frame([(1,)]),
         "content": frame([(1,)]), "schema": frame([(1,)])}
    )
    current = integrity.manifest(
        {"same": frame([(1,)]), "rows": frame([(1,), (1,)]), "content": frame([(2,)]),
         "schema": frame([(1,)], "x bigint")}
    )
    found = {r.dataset: r.reason for r in integrity.manifest_check(recorded, current).collect()}
    assert found == {"gone": "missing", "rows": "rows", "content": "content", "schema": "schema"}


@pytest.mark.parametrize("winner", ["model", "baseline"])
def test_only_the_deciding_predictor_is_scanned(spark, tmp_path, winner):
    path = str(tmp_path / "predictors")
    serve.write_predictors(model_frame(spark), baseline_frame(spark), path)
    verdict = spark.createDataFrame([(winner,)], "serving_winner string")
    loser = "baseline" if winner == "model" else "model"
    want = serve.served_predictions(serve.read_predictor(spark, path, winner)).collect()
    # Files of the other predictor are not even opened.
    for file in (tmp_path / "predictors" / f"predictor={loser}").glob("*"):
        file.write_bytes(b"not a table")
    found = serve.served_by_decision(spark, path, verdict)
    assert found.columns == ["serving_winner", *serve.SERVED.names]
    assert sorted(map(tuple, found.drop("serving_winner").collect())) == sorted(map(tuple, want))
    assert {r.serving_winner for r in found.collect()} == {winner}
