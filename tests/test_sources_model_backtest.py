import os
from datetime import timedelta

import pytest
from frames import TZ, local, rows_of, splits, utc
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from hourgrid.errors import ContractError, ParameterError
from hourgrid.functions.calendar import LocalWindow
from hourgrid.operators import boosting, classify, features, integrity, model, profile
from hourgrid.operators.grid import bag_diff_rows
from hourgrid.plans.backtest import EXTRAS, TABLES, Backtest, BacktestConfig
from hourgrid.schemas import FEATURES, GRID, LOOKUP, SERVED_FIELDS
from hourgrid.session import cut_lineage, require_utc
from hourgrid.sources import contracts, tables

CSV = 'LocationID,Borough,Zone,service_zone\n1,Queens,"A, B",Boro\n264,N/A,,N/A\nx,Bronx,C,Boro\n'


def test_lookup_csv_both_ways(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text(CSV.split("\nx,")[0] + "\n")
    want = [(1, "Queens", "A, B", "Boro"), (264, "N/A", None, "N/A")]
    for reader in (tables.read_lookup, tables.read_lookup_text):
        df = contracts.assert_schema(reader(spark, str(good)), LOOKUP)
        assert rows_of(df) == want
    bad = tmp_path / "bad.csv"
    bad.write_text(CSV)
    assert tables.read_lookup_text(spark, str(bad)).where("zone_id is null").count() == 1


def test_events_are_pruned_to_the_columns_used(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(10).select(
        F.lit(local("2026-01-01T00:10")).cast("timestamp_ntz").alias("pickup_ts"),
        F.col("id").cast("int").alias("zone_raw"),
        F.lit("x").alias("unused"),
    ).write.parquet(path)
    df = tables.read_events(spark, path, path, ts_col="pickup_ts", zone_col="zone_raw")
    assert df.count() == 20 and df.columns == ["pickup_ts", "zone_raw"]
    assert df.schema["pickup_ts"].dataType.simpleString() == "timestamp_ntz"
    from hourgrid.operators.classify import usable_cells

    plan = usable_cells(df, LocalWindow.month("2026-01", TZ))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "GreaterThanOrEqual(pickup_ts" in text and "unused" not in text
    with pytest.raises(ContractError, match="missing required"):
        tables.read_events(spark, path, ts_col="pickup_ts", zone_col="other")


def test_schema_contracts(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    contracts.assert_schema(df, df.schema)
    with pytest.raises(ContractError):
        contracts.assert_schema(df.select("y", "x"), df.schema)
    with pytest.raises(ContractError):
        contracts.assert_fields(df, SERVED_FIELDS)
    contracts.assert_fields(df.withColumn("z", F.lit(1)), df.schema)
    with pytest.raises(ContractError):
        contracts.require_rows(df.limit(0))


def test_written_tables_are_sorted_and_checked(spark, tmp_path):
    rows = [
        (z, utc("2026-01-31T20:00") + timedelta(hours=h), h, f"2026-0{1 + (h > 3)}", "available")
        for z in (3, 1, 2)
        for h in range(8)
    ]
    df = spark.createDataFrame(rows, GRID)
    path = str(tmp_path / "grid")
    assert tables.write_sorted(df, path, "source_month") == 24
    back = tables.check_written(spark, path, GRID, 24)
    assert bag_diff_rows(back, df).first()[0] == 0
    with pytest.raises(ContractError, match="expected 25"):
        tables.check_written(spark, path, GRID, 25)
    plan = back.where("source_month = '2026-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_month" in plan
    plain = str(tmp_path / "plain")
    tables.write_sorted(df.unionByName(df.limit(1)), plain)
    with pytest.raises(ContractError, match="repeats"):
        tables.check_written(spark, plain, GRID, 25)


def test_session_checks(spark):
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ContractError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = cut_lineage(spark.range(5))
    assert df.count() == 5 and spark.sparkContext.getCheckpointDir()


MODEL_SPLITS = (0, 180, 228, 276)


def feature_frame(spark, shift=0):
    start = utc("2026-01-01T00:00")
    rows = []
    for h in range(276):
        split = "train" if h < 180 else "validation" if h < 228 else "test"
        for zone in (1, 2, 3):
            base = 3 * zone + h % 24 + (h // 24) % 3
            target = base + (shift if split == "test" else 0)
            at = start + timedelta(hours=h)
            rows.append(
                (zone, at, split, target, "available", at.hour, at.isoweekday(), at.month,
                 at.isoweekday() > 5, max(base - 1, 0), max(base - 2, 0), max(base - 3, 0),
                 float(max(base - 1, 0)), float(max(base - 2, 0)), True)
            )
    return spark.createDataFrame(rows, FEATURES)


def fit(spark, shift):
    prepared = model.prepare(feature_frame(spark, shift))
    chosen = model.select_candidate(
        prepared,
        (model.Candidate("small", 2, 0.3), model.Candidate("large", 3, 0.3)),
        max_rounds=5,
        patience=2,
    )
    predictions, final = model.model_predictions(prepared, chosen)
    return chosen, predictions, final


def test_test_targets_never_reach_the_model(spark):
    chosen, first, final = fit(spark, 0)
    again, second, _ = fit(spark, 100)
    assert (chosen.candidate, chosen.rounds) == (again.candidate, again.rounds)
    columns = ["zone_id", "target_hour_utc", "split", "prediction_raw", "prediction", "fit_scope"]
    assert bag_diff_rows(first.select(*columns), second.select(*columns)).first()[0] == 0
    assert first.select("zone_id", "target_hour_utc").distinct().count() == 288
    scopes = set(rows_of(first.select("split", "fit_scope").distinct()))
    assert scopes == {("validation", "train"), ("test", "train_validation")}
    report = model.candidate_report(chosen)
    model.check_isolation(report, final.getNumTrees)
    with pytest.raises(ContractError):
        model.check_isolation(report, final.getNumTrees + 1)
    with pytest.raises(ContractError):
        model.check_isolation(report.withColumn("test_mae", F.lit(1.0)), final.getNumTrees)
    assert first.where("prediction < 0").isEmpty()


def many_zones(spark, zones):
    """Three hours, one of each split, of many zones; the target depends on a digit of the id."""
    rows = feature_frame(spark).where("zone_id = 1 and hour(target_hour_utc) = 12")
    picked = rows.groupBy("split").agg(F.min("target_hour_utc").alias("at"))
    one_hour = rows.join(picked.select("at"), F.col("target_hour_utc") == F.col("at")).drop("at")
    ids = F.explode(F.sequence(F.lit(0), F.lit(zones - 1)))
    many = one_hour.withColumn("k", ids)
    many = many.withColumn("zone_id", (3 * F.col("k") - 5000).cast("int"))
    high = F.expr("(k * 3) div 128 % 2 = 1")
    many = many.withColumn("target_trip_count", F.when(high, 50).otherwise(2).cast("long"))
    return many.select(*FEATURES.names)


@pytest.mark.parametrize("zones", [10, 100_000])
def test_one_encoding_for_any_zones(spark, zones):
    prepared = model.prepare(many_zones(spark, zones))
    attributes = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    nominal = [a for a in attributes.get("nominal", []) if a["name"].startswith("zone")]
    sizes = [a.get("num_vals") or len(a["vals"]) for a in nominal]
    assert sizes == [model.MAX_BINS] * model.ZONE_DIGITS
    assert not any("lag" in a["name"] or "rolling" in a["name"] for a in attributes.get("nominal", []))
    vectors = prepared.select(vector_to_array("features").alias("x"), "zone_id")
    columns = model.ZONE_DIGITS + len(model.NUMERIC_FEATURES)
    assert vectors.count() == 3 * zones and vectors.where(F.size("x") != columns).isEmpty()
    codes = vectors.select(F.slice("x", 1, model.ZONE_DIGITS).alias("code")).distinct()
    assert codes.count() == zones
    if zones > 10:
        small = (model.Candidate("small", 4, 0.5),)
        chosen = model.select_candidate(prepared, small, max_rounds=4, patience=2)
        predictions, _ = model.model_predictions(prepared, chosen)
        assert predictions.count() == 2 * zones
        assert predictions.agg(F.max("absolute_error")).first()[0] < 15


def test_one_hot_has_a_fixed_size(spark):
    prepared = model.prepare(feature_frame(spark), one_hot=True)
    sizes = {r.features.size for r in prepared.select("features").collect()}
    assert sizes == {model.ZONE_DIGITS * model.MAX_BINS + len(model.NUMERIC_FEATURES)}


def test_bins_come_from_train_rows_alone_and_see_no_target(spark):
    frame = feature_frame(spark)
    cuts = model.learn_cuts(frame)
    later = F.col("split") != "train"
    other = frame.withColumn("lag_1h", F.when(later, 10_000).otherwise(F.col("lag_1h")).cast("long"))
    other = other.withColumn("target_trip_count", F.col("target_trip_count") * 7)
    assert model.learn_cuts(other) == cuts
    assert set(cuts) == set(model.HISTORY_FEATURES)
    values = sorted(r.lag_24h for r in frame.where("split = 'train'").collect())
    place = 37 / model.MAX_BINS * (len(values) - 1)
    low = values[int(place)] + (values[int(place) + 1] - values[int(place)]) * (place % 1)
    assert any(abs(cut - low) < 1e-9 for cut in cuts["lag_24h"])
    assert all(len(c) < model.MAX_BINS and c == sorted(set(c)) for c in cuts.values())
    empty = model.learn_cuts(frame.limit(0))
    assert empty == {name: [0.0] for name in model.HISTORY_FEATURES}


def test_early_stopping_keeps_the_first_trees_of_one_long_fit(spark, monkeypatch):
    fitted = []
    whole = model.regressor

    def counted(candidate, rounds, seed):
        fitted.append(rounds)
        return whole(candidate, rounds, seed)

    monkeypatch.setattr(model, "regressor", counted)
    prepared = model.prepare(feature_frame(spark))
    train, validation = (prepared.where(F.col("split") == n) for n in ("train", "validation"))
    candidate = model.Candidate("small", 3, 0.08)
    long = model.fit_rounds(train, candidate, 24, block_rounds=6)
    errors = long.model(24).evaluateEachIteration(validation, "absolute")
    for patience in (1, 3):
        fitted.clear()
        kept, best = model.fit_candidate(train, validation, candidate, 24, patience, model.SEED, 6)
        assert best == model.best_round(errors, patience) == kept.getNumTrees
        # No tree is fitted twice, and the blocks end where patience does.
        assert fitted == [6] * len(fitted) and (len(fitted) == 4 or sum(fitted) - 6 < best + patience)
        mine, other = (
            sorted((r.zone_id, r.target_hour_utc, r.prediction_raw) for r in m.transform(validation).collect())
            for m in (kept, long.model(best))
        )
        assert mine == other
    # With half of patience spent, the rest of it is tried before a block is fitted in full.
    flat = train.withColumn("label", F.pmod(F.xxhash64("zone_id", "target_hour_utc"), F.lit(7)).cast("double"))
    apart = validation.withColumn("label", F.lit(3.0) + F.col("zone_id") % 2)
    fitted.clear()
    kept, best = model.fit_candidate(flat, apart, candidate, 24, 8, model.SEED, 6)
    assert fitted == [6, 6, 3]
    errors_flat = model.fit_rounds(flat, candidate, 24, block_rounds=6).model(24).evaluateEachIteration(apart, "absolute")
    assert best == model.best_round(errors_flat, 8) == kept.getNumTrees
    # The errors of the blocks on what is left are those of the whole.
    left, seen = validation, []
    part = model.Growth(candidate, train, block=6)
    while len(part.trees) < 12:
        block = part.grow(12)
        seen += block.evaluateEachIteration(left, "absolute")
        left = model.left_over(left, block)
    assert seen == pytest.approx(errors[:12])


def test_a_better_round_among_those_tried_gets_its_whole_block(monkeypatch):
    errors = [5.0, 4.0, *[6.0] * 5, 3.0, *[7.0] * 16]
    fitted = []

    class Block:
        def __init__(self, candidate, rounds, seed):
            self.first, self.rounds = seed - model.SEED, rounds
            fitted.append((self.first, rounds))

        def fit(self, rows):
            self.treeWeights, self._java_obj = [0.1] * self.rounds, self
            return self

        def trees(self):
            return range(self.first, self.first + self.rounds)

        def evaluateEachIteration(self, rows, loss):
            return [errors[k] for k in self.trees()]

    monkeypatch.setattr(model, "regressor", Block)
    monkeypatch.setattr(model, "left_over", lambda rows, block: rows + [block.rounds])
    monkeypatch.setattr(model.Growth, "model", lambda self, rounds: (self.trees[:rounds], self.rows))
    (trees, taken_off), best = model.fit_candidate([], [], model.CANDIDATES[0], 24, 6, model.SEED, 6)
    assert fitted == [(0, 6), (6, 2), (6, 6), (12, 2)]
    assert best == model.best_round(errors, 6) == 8 and trees == [*range(8)] and taken_off == [6, 6]


ZONES = [(1, "Queens", "A", "Boro"), (2, "Bronx", "B", "Boro"), (9, "Unknown", "N/A", "N/A")]


@pytest.fixture(scope="module")
def backtest(spark, tmp_path_factory):
    """Two months with one file cut per month, from raw events to read queries."""
    folder = tmp_path_factory.mktemp("backtest")
    zones = spark.createDataFrame(ZONES, LOOKUP)
    minutes = (F.col("id") * 20).cast("int")
    start = F.lit(local("2026-02-01T00:05")).cast("timestamp_ntz")
    hour = F.hour(F.lit("2026-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=minutes))
    spark.range(59 * 24 * 3).select(
        (start + F.make_dt_interval(mins=minutes)).alias("pickup_ts"),
        F.when(F.col("id") % 11 == 0, 9).when(hour < 12, 1).otherwise(2).alias("zone_raw"),
        F.lit("not used").alias("extra"),
    ).withColumn("source_month", F.date_format("pickup_ts", "yyyy-MM")).write.parquet(f"{folder}/raw")
    raw = tables.read_events(
        spark, f"{folder}/raw", ts_col="pickup_ts", zone_col="zone_raw", month_col="source_month"
    )
    config = BacktestConfig(
        LocalWindow.months(["2026-02", "2026-03"], TZ),
        splits("2026-02-01T05:00", "2026-03-01T05:00", "2026-03-16T04:00", "2026-04-01T04:00"),
        month_col="source_month",
        candidates=(model.Candidate("small", 2, 0.3),),
        max_rounds=3,
        patience=2,
    )
    run = Backtest(spark, raw, zones, config, str(folder / "run"), (f"{folder}/raw",))
    return run, run.run()


def test_whole_backtest(spark, backtest):
    run, store = backtest
    assert store.zones().count() == 2
    assert store.rankings(utc("2026-03-20T12:00"), 2).count() == 2
    assert store.history(1, utc("2026-03-20T12:00"), 24).count() == 24
    assert run.store().zones().count() == 2
    one = f"{run.out}/runs/{run.committed().run}/reports"
    report = {r.section: r.rows for r in spark.read.json(f"{one}/aggregate").collect()}
    assert '"disposition":"retained"' in report["dispositions"]
    assert set(r.section for r in spark.read.json(f"{one}/analysis").collect()) >= {
        "decision", "overall", "quantiles", "worst_zones",
    }
    assert spark.read.json(f"{one}/uncovered_hours").isEmpty()
    recorded = run.kept("manifest")
    names = {*TABLES, "events", "lookup"}
    assert {r.dataset for r in recorded.select("dataset").distinct().collect()} == names
    whole = {name: spark.read.parquet(run.current(name)) for name in TABLES}
    mine = integrity.folded(recorded).where(F.col("dataset").isin(*TABLES))
    assert bag_diff_rows(
        mine.drop("schema"), integrity.manifest(whole).drop("schema").select(*mine.drop("schema").columns)
    ).first()[0] == 0
    run.verify()


def test_sections_of_the_profile_come_from_one_state(spark, backtest):
    run, _ = backtest
    window = run.config.window
    # Rows before, after, without a time or a zone, and on a clock change.
    odd = [("2025-12-31T23:10", 5), (None, 1), ("2026-03-08T02:30", 1), ("2026-05-01T00:00", 7)]
    rows = run.events.select("pickup_ts", "zone_raw").unionByName(
        spark.createDataFrame([(t and local(t), z) for t, z in odd], "pickup_ts timestamp_ntz, zone_raw int")
    ).unionByName(run.events.limit(3).select("pickup_ts", F.lit(None).cast("int").alias("zone_raw")))
    states = cut_lineage(profile.raw_states(rows, window))
    hourly, zones = profile.hours_of_states(states, window), profile.zones_of_states(states, run.lookup, window)
    for mine, plain in (
        (profile.profile_of_states(states, window), profile.raw_profile(rows, window)),
        (zones, profile.zone_cells(rows, run.lookup, window)),
        (hourly, profile.hourly_coverage(rows, window)),
        (profile.time_cells_of_states(states), classify.time_cells(rows, window)),
    ):
        assert set(mine.columns) == set(plain.columns)
        assert bag_diff_rows(mine.select(*plain.columns), plain).first()[0] == 0


def test_stages_after_the_scan_read_no_raw_events(spark, backtest, tmp_path):
    run, _ = backtest
    gone = Backtest(spark, spark.read.schema(run.events.schema).parquet(f"{run.out}/../raw"), run.lookup, run.config, run.out)
    blind = gone.fresh()
    object.__setattr__(blind, "events", None)
    blind.profile()
    blind.aggregate()
    blind.complete()
    assert set(blind.written) == {"cells", "counts", "grid"}


GATES = {
    "aggregate": ("hourgrid.operators.counts.check_counts", "counts"),
    "complete": ("hourgrid.operators.grid.check_grid", "grid"),
    "baseline": ("hourgrid.operators.metrics.check_scored", "baseline"),
    "features": ("hourgrid.operators.features.check_features", "features"),
    "model": ("hourgrid.operators.model.check_isolation", "model_predictions"),
    "analyse": ("hourgrid.operators.compare.check_alignment", "comparison"),
    "serve": ("hourgrid.operators.serve.ForecastStore.check", "served"),
    "verify": ("hourgrid.plans.backtest.manifest_check", "manifest"),
}


@pytest.mark.parametrize("stage", GATES)
def test_a_broken_stage_leaves_readers_on_the_earlier_run(backtest, monkeypatch, stage):
    run, _ = backtest
    before = run.committed()
    trial = run.fresh()

    def broken(*args, **kwargs):
        raise ContractError("broken on purpose")

    monkeypatch.setattr(GATES[stage][0], broken)
    with pytest.raises(ContractError, match="on purpose"):
        getattr(trial, stage)(*(["baseline"] if stage == "serve" else []))
    assert GATES[stage][1] not in trial.written
    with pytest.raises(ContractError, match="has not written"):
        trial.commit()
    assert run.committed() == before
    assert run.store().zones().count() == 2


def test_damaged_tables_are_refused(spark, backtest, tmp_path):
    run, _ = backtest
    before = run.committed()
    first = F.col("target_hour_utc") == F.lit(utc("2026-03-20T12:00")).cast("timestamp")
    damages = [
        ("complete", "counts", lambda t: t.limit(20), "recount"),
        ("analyse", "model_predictions", lambda t: t.where(~first), "different rows"),
        ("analyse", "baseline", lambda t: t.withColumn("prediction", F.col("prediction") + 1), "recorded"),
        ("verify", "features", lambda t: t.limit(10), "features"),
    ]
    for stage, name, change, match in damages:
        trial = run.fresh()
        path = str(tmp_path / f"{stage}-{name}")
        change(spark.read.parquet(run.current(name))).write.parquet(path)
        trial.written[name] = path
        with pytest.raises(ContractError, match=match):
            getattr(trial, stage)()
    with pytest.raises(ContractError, match="lookup"):
        Backtest(spark, run.events, run.lookup.where("zone_id <> 2"), run.config, run.out).analyse()
    whole = spark.read.parquet(run.current("grid"))
    trial = run.fresh()
    with pytest.raises(ContractError):
        trial._store(whole.union(whole), "grid", GRID, "source_month")
    assert "grid" not in trial.written and run.committed() == before


def test_commits_follow_each_other_and_torn_ones_are_not_seen(spark, backtest, tmp_path):
    run, _ = backtest
    nothing = Backtest(spark, run.events, run.lookup, run.config, str(tmp_path / "none"))
    assert nothing.committed() is None
    with pytest.raises(ContractError, match="committed"):
        nothing.current("grid")
    other = Backtest(spark, run.events, run.lookup, run.config, str(tmp_path / "other"))
    for sequence in (1, 2):
        one = other.fresh()
        one.written.update({name: f"{sequence}/{name}" for name in (*TABLES, *EXTRAS)})
        one.commit()
        assert (other.committed().sequence, other.committed().run) == (sequence, one.run_id)
        assert other.current("grid") == f"{sequence}/grid"
    # What a lost driver leaves: a file that was not moved to its place.
    torn = tmp_path / "other" / "commits" / "_temporary" / "0"
    torn.mkdir(parents=True)
    (torn / "part-0.json").write_text('{"sequence": 9, "run": "torn"')
    assert other.committed().sequence == 2


def test_manifest_reads_only_changed_files(spark, tmp_path):
    folder = tmp_path / "data"
    frame = spark.range(100).select("id", (F.col("id") % 7).alias("k"), F.lit("x").alias("unused"))
    frame.repartition(3, "id").write.parquet(str(folder))
    files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    columns = ("id", "k")
    recorded = cut_lineage(integrity.file_manifest(spark, "d", (str(folder),), columns))
    assert recorded.count() == len(files)
    plain = integrity.manifest({"d": frame.select(*columns)})
    same = integrity.folded(recorded)
    assert integrity.manifest_check(same, plain).isEmpty() and integrity.manifest_check(plain, same).isEmpty()
    # Unchanged files are not opened: other bytes of the same length and time go unseen.
    path = folder / files[0]
    stat, good = path.stat(), path.read_bytes()
    path.write_bytes(good[:4] + bytes(len(good) - 12) + good[-8:])
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    again = integrity.file_manifest(spark, "d", (str(folder),), columns, recorded)
    assert integrity.manifest_check(same, integrity.folded(again)).isEmpty()
    path.write_bytes(good)
    # One new file: it is read, the others are not, and the pruned scan reads two columns.
    spark.range(5).select("id", F.lit(1).cast("long").alias("k"), F.lit("y").alias("unused")).coalesce(1).write.mode("append").parquet(str(folder))
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    more = integrity.file_manifest(spark, "d", (str(folder),), columns, recorded)
    scans = [x for x in more._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan parquet [" in x]
    assert any("ReadSchema: struct<id:bigint,k:bigint>" in x for x in scans)
    assert not any("unused" in x for x in scans)
    more = cut_lineage(more)
    found = integrity.manifest_check(same, integrity.folded(more))
    assert rows_of(found, "dataset", "reason", "current_rows") == [("d", "rows", 105)]
    os.remove(folder / files[1])
    less = integrity.file_manifest(spark, "d", (str(folder),), columns, recorded)
    assert not integrity.manifest_check(integrity.folded(more), integrity.folded(less)).isEmpty()


def test_partitioned_tables_keep_their_partition_values_in_the_manifest(spark, tmp_path):
    folder = str(tmp_path / "parts")
    spark.range(20).select("id", (F.col("id") % 3).alias("p")).write.partitionBy("p").parquet(folder)
    files = integrity.folded(integrity.file_manifest(spark, "t", (folder,)))
    assert integrity.manifest_check(files, integrity.manifest({"t": spark.read.parquet(folder)})).isEmpty()


def plain_gbt(candidate, rounds, seed):
    return GBTRegressor(
        featuresCol="features", labelCol="label", predictionCol="prediction_raw", lossType="squared",
        maxDepth=candidate.max_depth, stepSize=candidate.step_size, maxBins=model.MAX_BINS,
        minInstancesPerNode=candidate.min_rows_per_leaf, subsamplingRate=candidate.row_rate,
        featureSubsetStrategy=str(candidate.feature_rate), maxIter=rounds, seed=seed,
    )


def test_trees_are_those_of_spark_ml(spark, monkeypatch):
    monkeypatch.setattr(boosting, "SMALL_ROWS", 0)
    prepared = model.prepare(feature_frame(spark))
    noise = F.pmod(F.xxhash64(*model.KEY), F.lit(1000)) / F.lit(777.0)
    train = prepared.where("split = 'train'").withColumn("label", F.col("label") + noise)
    for candidate in model.CANDIDATES:
        mine, plain = (f(candidate, 5, 44).fit(train) for f in (model.regressor, plain_gbt))
        assert [t.numNodes for t in mine.trees] == [t.numNodes for t in plain.trees]
        assert mine.treeWeights == plain.treeWeights and mine.numFeatures == plain.numFeatures
        sides = [
            m.transform(prepared).select(*model.KEY, F.col("prediction_raw").alias(name))
            for m, name in ((mine, "mine"), (plain, "plain"))
        ]
        apart = F.max(F.abs(F.col("mine") - F.col("plain")))
        assert sides[0].join(sides[1], list(model.KEY)).agg(apart).first()[0] < 1e-9


def test_a_fit_keeps_rows_as_bytes_and_its_blocks_do_not_matter(spark, monkeypatch):
    train = model.prepare(feature_frame(spark)).where("split = 'train'")
    monkeypatch.setattr(boosting, "SMALL_ROWS", 0)
    packed, pack = [], boosting._packer

    def seen(features, words):
        packed.append((features, words))
        return pack(features, words)

    monkeypatch.setattr(boosting, "_packer", seen)
    monkeypatch.setattr(boosting, "COLLECTED", 0)  # counts are added up by Catalyst
    first = model.regressor(model.CANDIDATES[1], 4).fit(train)
    monkeypatch.setattr(boosting, "COLLECTED", 1 << 21)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        second = model.regressor(model.CANDIDATES[1], 4).fit(train)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert packed == [(14, 1)] * 2
    assert first.toDebugString.split("\n")[1:] == second.toDebugString.split("\n")[1:]
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == 0
    flat = train.withColumn("label", F.lit(3.0))
    assert model.regressor(model.CANDIDATES[0], 2).fit(flat).transform(flat).where("prediction_raw <> 3").isEmpty()
    with pytest.raises(ContractError, match="no rows"):
        model.regressor(model.CANDIDATES[0], 2).fit(train.limit(0))
