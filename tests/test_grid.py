import pytest
from frames import TZ, events, grid_frame, lookup, rows_of, two_zone_lookup, utc
from pyspark.sql import functions as F

from hourgrid.errors import ContractError
from hourgrid.functions.calendar import LocalWindow
from hourgrid.operators import classify, counts, grid


def build(spark, rows, month, **options):
    window = LocalWindow.month(month, TZ)
    zones = two_zone_lookup(spark)
    cells = classify.usable_cells(events(spark, rows), window)
    observed = counts.hourly_counts(classify.label_cells(cells, zones))
    coverage = grid.coverage_status(cells, window)
    return grid.complete_grid(
        grid.service_entities(zones), coverage, observed, window, **options
    ), coverage, window


def at(frame, zone, hour):
    row = frame.where(F.col("zone_id") == zone).where(
        F.col("target_hour_utc") == F.lit(hour).cast("timestamp")
    ).first()
    return row.trip_count, row.source_status


def test_zero_is_not_missing(spark):
    rows = [("2026-01-01T00:10", 1), ("2026-01-01T00:20", 1), ("2026-01-01T01:10", 264)]
    full, coverage, window = build(spark, rows, "2026-01")
    assert at(full, 1, "2026-01-01 05:00:00") == (2, "available")
    assert at(full, 2, "2026-01-01 05:00:00") == (0, "available")
    assert at(full, 1, "2026-01-01 06:00:00") == (0, "available")
    assert at(full, 1, "2026-01-01 07:00:00") == (None, "source_missing")
    summary = grid.grid_summary(full).first()
    assert (summary.output_rows, summary.unique_keys, summary.trip_count) == (1488, 1488, 2)
    assert (summary.zero_rows, summary.missing_rows, summary.observed_rows) == (3, 1484, 1)
    assert summary.violations == 0
    facts = grid.check_grid(full, window.utc_start, window.utc_end)
    assert (facts["zone_count"], facts["hour_count"]) == (2, 744)
    missing = grid.uncovered_hours(coverage)
    assert missing.count() == 742
    assert missing.first() == ("2026-01-01T07:00:00Z", "source_missing")


def test_spring_month_has_one_hour_less(spark):
    rows = [("2026-03-08T01:10", 1), ("2026-03-08T02:10", 1), ("2026-03-08T03:10", 1)]
    full, coverage, _ = build(spark, rows, "2026-03")
    assert coverage.count() == 743
    assert coverage.where("source_status = 'dst_ambiguous'").count() == 0
    assert grid.grid_summary(full).first().trip_count == 2


def test_autumn_month_has_two_ambiguous_hours(spark):
    rows = [("2026-11-01T00:10", 1), ("2026-11-01T01:10", 1), ("2026-11-01T02:10", 1)]
    full, coverage, _ = build(spark, rows, "2026-11")
    assert coverage.count() == 721
    assert at(full, 1, "2026-11-01 05:00:00") == (None, "dst_ambiguous")
    assert at(full, 1, "2026-11-01 06:00:00") == (None, "dst_ambiguous")
    assert grid.grid_summary(full).first().trip_count == 2


def test_two_months_in_one_grid(spark):
    raw = events(spark, [("2026-02-28T23:59", 1), ("2026-03-01T00:00", 2)])
    window = LocalWindow.months(["2026-02", "2026-03"], TZ)
    zones = two_zone_lookup(spark)
    cells = classify.usable_cells(raw, window)
    full = grid.complete_grid(
        grid.service_entities(zones),
        grid.coverage_status(cells, window),
        counts.hourly_counts(classify.label_cells(cells, zones)),
        window,
        month_of_hour=True,
    )
    assert grid.grid_summary(full).first().unique_keys == 2830
    assert at(full, 1, "2026-03-01 04:00:00") == (1, "available")
    assert at(full, 2, "2026-03-01 05:00:00") == (1, "available")
    months = dict(rows_of(full.groupBy("source_month").count()))
    assert months == {"2026-02": 672 * 2, "2026-03": 743 * 2}


def test_partition_count_does_not_change_the_grid(spark):
    rows = [("2026-01-01T00:10", 1), ("2026-01-05T00:20", 2), ("2026-01-01T01:10", 264)]
    one, _, _ = build(spark, rows, "2026-01", partitions=1)
    many, _, _ = build(spark, rows, "2026-01", partitions=7)
    assert grid.bag_diff_rows(one, many).first()[0] == 0


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_grid_and_windows_share_one_exchange_per_input(spark, broadcast):
    from hourgrid.operators.features import build_features
    from hourgrid.operators.splits import assign_splits
    from hourgrid.plans.workload import SPLITS

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        full, _, _ = build(spark, [("2026-01-01T00:10", 1)], "2026-01")
        table = build_features(assign_splits(full, SPLITS))
        plan = table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Above the grid join there is no further exchange, and no grid row is joined by hour.
    joins = [line for line in plan.split("\n") if "SortMergeJoin" in line]
    assert "Exchange" not in plan[: plan.index("SortMergeJoin")]
    assert "SortMergeJoin [zone_id" in joins[0] and plan.index("Generate") > plan.index(joins[0])
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


DAMAGE = {
    "repeated key": lambda g: g.unionByName(g.limit(1)),
    "negative count": lambda g: g.withColumn("trip_count", F.col("trip_count") - 5),
    "half hour": lambda g: g.withColumn(
        "target_hour_utc", F.col("target_hour_utc") + F.expr("INTERVAL 30 MINUTES")
    ),
    "missing hour": lambda g: g.where("target_hour_utc <> TIMESTAMP '2026-01-01 03:00:00'"),
    "unknown status": lambda g: g.withColumn("source_status", F.lit("odd")),
    "count without source": lambda g: g.withColumn("source_status", F.lit("source_missing")),
    "bad zone": lambda g: g.withColumn("zone_id", F.lit(0)),
    "empty": lambda g: g.limit(0),
    "ragged": lambda g: g.unionByName(g.where("hour(target_hour_utc) < 3").withColumn("zone_id", F.lit(9))),
}


@pytest.mark.parametrize("kind", DAMAGE)
def test_damaged_grids_are_rejected(spark, kind):
    good = grid_frame(spark, [1, 2, 3, 4, 5, 6])
    start, end = utc("2026-01-01T00:00"), utc("2026-01-01T06:00")
    assert grid.check_grid(good, start, end)["row_count"] == 6
    with pytest.raises(ContractError):
        grid.check_grid(DAMAGE[kind](good), start, end)


def test_grid_must_cover_exactly_the_window(spark):
    good = grid_frame(spark, [1, 2, 3])
    with pytest.raises(ContractError):
        grid.check_grid(good, utc("2026-01-01T00:00"), utc("2026-01-01T04:00"))


def test_lookup_contract(spark):
    grid.check_lookup(two_zone_lookup(spark))
    for bad in ([(1, "a", "b", "c"), (1, "d", "e", "f")], [(0, "a", "b", "c")], [(None, "a", "b", "c")]):
        with pytest.raises(ContractError):
            grid.check_lookup(lookup(spark, bad))
    audit = grid.lookup_audit(lookup(spark, [(1, None, "b", "c"), (2, "a", "b", "c")])).first()
    assert (audit.rows, audit.null_rows, audit.surplus_keys) == (2, 1, 0)


def test_bag_difference_counts_multiplicity(spark):
    left = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([(1, None), (3, "y"), (2, "x")], "a int, b string")
    assert sorted(rows_of(grid.bag_diff(left, right)), key=str) == [
        (1, None, 2, 0),
        (3, "y", 0, 1),
    ]
    both_ways = left.exceptAll(right).unionAll(right.exceptAll(left)).count()
    assert grid.bag_diff_rows(left, right).first()[0] == both_ways == 3
    assert grid.bag_diff_rows(left, left).first()[0] == 0
