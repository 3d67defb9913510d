import pytest
from frames import TZ, events, local, lookup, rows_of, two_zone_lookup, utc
from pyspark.sql import functions as F

from hourgrid.errors import ContractError, ParameterError
from hourgrid.functions.calendar import LocalWindow
from hourgrid.operators import classify, counts, profile
from hourgrid.operators.grid import bag_diff_rows

MARCH = LocalWindow.month("2026-03", TZ)
JANUARY = LocalWindow.month("2026-01", TZ)

MARCH_ROWS = [
    ("2026-02-28T23:59", 1),
    ("2026-03-08T01:15", 1),
    ("2026-03-08T01:45", 1),
    ("2026-03-08T02:30", 1),
    ("2026-03-08T03:10", 1),
    ("2026-03-08T04:10", 264),
    ("2026-03-08T05:10", 999),
    (None, 1),
    ("2026-03-08T06:10", None),
]
MARCH_LABELS = [
    "outside_month",
    "retained",
    "retained",
    "dst_nonexistent",
    "retained",
    "non_service_zone",
    "not_in_lookup",
    "null_timestamp",
    "null_zone",
]


def dimension(spark):
    return lookup(
        spark,
        [(1, "EWR", "Newark Airport", "EWR"), (264, "Unknown", "N/A", "N/A")],
    )


def march_cells(spark):
    cells = classify.time_cells(events(spark, MARCH_ROWS), MARCH)
    return classify.label_cells(cells, dimension(spark))


def test_each_row_gets_the_first_label_that_applies(spark):
    labelled = classify.label_dispositions(events(spark, MARCH_ROWS), dimension(spark), MARCH)
    found = [r.disposition for r in labelled.orderBy("event_no").collect()]
    assert found == MARCH_LABELS


def test_time_labels_come_before_zone_labels(spark):
    rows = [(None, None), ("2026-04-01T00:00", 999), ("2026-03-08T02:00", 264)]
    labelled = classify.label_dispositions(events(spark, rows), dimension(spark), MARCH)
    found = [r.disposition for r in labelled.orderBy("event_no").collect()]
    assert found == ["null_timestamp", "outside_month", "dst_nonexistent"]


def test_disposition_counts_are_zero_filled(spark):
    report = dict(rows_of(classify.disposition_counts(march_cells(spark))))
    assert report["raw_rows"] == 9
    assert report["retained"] == 3
    assert report["excluded_rows"] == 6
    assert report["dst_ambiguous"] == 0
    assert sum(report[name] for name in set(MARCH_LABELS)) == 9


def test_hourly_counts_and_their_contract(spark):
    cells = march_cells(spark)
    table = counts.hourly_counts(cells)
    found = sorted(rows_of(table.withColumn("h", F.hour("target_hour_utc")), "h", "trip_count"))
    assert found == [(6, 2), (7, 1)]
    summary = counts.check_counts(table, cells)
    assert (summary["output_rows"], summary["output_trip_count"]) == (2, 3)
    with pytest.raises(ContractError):
        counts.check_counts(table.unionByName(table), cells)
    with pytest.raises(ContractError):
        counts.check_counts(table.where("trip_count > 1"), cells)


def test_usable_cells_equal_the_usable_part_of_all_cells(spark):
    raw = events(spark, MARCH_ROWS)
    usable = classify.label_cells(classify.usable_cells(raw, MARCH), dimension(spark))
    assert sorted(rows_of(counts.source_activity(usable)), key=str) == sorted(
        rows_of(counts.source_activity(march_cells(spark))), key=str
    )


def test_cells_agree_with_row_labels_on_skewed_input(spark):
    # One zone and hour hold most rows, as a hot key would.
    raw = spark.range(5000).select(
        (F.lit(local("2026-10-31T22:00")).cast("timestamp_ntz")
         + F.make_dt_interval(mins=F.when(F.col("id") % 3 == 0, F.col("id") % 400).otherwise(5)
                              .cast("int"))).alias("pickup_ts"),
        F.when(F.col("id") % 7 != 0, F.when(F.col("id") % 5 == 0, 264).otherwise(1)).alias("zone_raw"),
    )
    window = LocalWindow(local("2026-10-31T00:00"), local("2026-11-02T00:00"), TZ)
    by_row = classify.label_dispositions(raw, dimension(spark), window)
    want = {r["disposition"]: r["count"] for r in by_row.groupBy("disposition").count().collect()}
    cells = classify.label_cells(classify.time_cells(raw, window), dimension(spark))
    got = {k: v for k, v in rows_of(classify.disposition_counts(cells)) if v}
    got.pop("raw_rows"), got.pop("excluded_rows")
    assert got == want
    assert "dst_ambiguous" in want


def test_a_repeated_lookup_key_counts_rows_twice_like_the_row_level_join(spark):
    twice = dimension(spark).unionByName(dimension(spark))
    raw = events(spark, MARCH_ROWS)
    by_row = classify.label_dispositions(raw, twice, MARCH).where("disposition = 'retained'").count()
    cells = classify.label_cells(classify.time_cells(raw, MARCH), twice)
    by_cell = counts.hourly_counts(cells).agg(F.sum("trip_count")).first()[0]
    assert by_row == by_cell == 6


def test_special_texts_are_trimmed_and_case_blind(spark):
    odd = lookup(
        spark,
        [
            (1, "  UNKNOWN ", "x", "y"),
            (2, "Queens", " outside of nyc", "y"),
            (3, "Queens", "x", "n/A"),
            (4, None, None, None),
        ],
    )
    flags = dict(rows_of(classify.lookup_flags(odd)))
    assert flags == {1: True, 2: True, 3: True, 4: False}


def test_source_months_bound_their_own_rows(spark):
    raw = events(
        spark,
        [("2026-02-28T23:59", 1), ("2026-03-01T00:00", 1), ("2026-03-01T00:10", 1)],
    ).withColumn("source_month", F.when(F.col("event_no") < 2, "2026-02").otherwise("2026-03"))
    window = LocalWindow.months(["2026-02", "2026-03"], TZ)
    cells = classify.time_cells(raw, window, month_col="source_month")
    totals = classify.monthly_totals(classify.label_cells(cells, dimension(spark)))
    assert sorted(rows_of(totals)) == [
        ("2026-02", 2, 1, 1),
        ("2026-03", 1, 1, 0),
        ("all", 3, 2, 1),
    ]
    unnamed = raw.withColumn("source_month", F.lit(None).cast("string"))
    labels = classify.label_dispositions(unnamed, dimension(spark), window, month_col="source_month")
    assert labels.where("disposition <> 'outside_month'").isEmpty()
    usable = classify.usable_cells(raw, window, month_col="source_month")
    assert usable.agg(F.sum("cell_rows")).first()[0] == 2


PROFILE_ROWS = [
    ("2025-12-31T23:59", 1),
    ("2026-01-01T00:15", 1),
    ("2026-01-01T01:15", 264),
    ("2026-01-01T02:15", 999),
    ("2026-01-01T03:15", None),
    ("2026-02-01T00:01", 1),
    (None, 1),
]


def test_profile_of_a_month(spark):
    raw = events(spark, PROFILE_ROWS)
    row = profile.raw_profile(raw, JANUARY).first()
    assert (row.total_rows, row.pickup_null_rows, row.zone_null_rows) == (7, 1, 1)
    assert (row.before_month_rows, row.after_month_rows, row.within_month_rows) == (1, 1, 4)
    assert row.distinct_raw_zone_ids == 3
    assert row.pickup_min == local("2025-12-31T23:59")
    assert row.pickup_max == local("2026-02-01T00:01")

    cells = profile.zone_cells(raw, dimension(spark), JANUARY)
    zones = profile.zone_profile(cells).first()
    assert tuple(zones) == (1, 1, 2, 1, 1, 1)
    assert rows_of(profile.invalid_zones(cells)) == [
        (264, "Unknown", "N/A", "non_service_lookup_zone", 1),
        (999, None, None, "not_in_lookup", 1),
        (None, None, None, "null_zone", 1),
    ]

    hourly = profile.hourly_coverage(raw, JANUARY)
    summary = profile.coverage_summary(hourly, JANUARY).first()
    assert (summary.expected_hours, summary.observed_hours, summary.missing_hours) == (744, 4, 740)
    assert (summary.observed_days, summary.mean_rows_per_observed_hour) == (1, 1.0)
    assert profile.missing_hours(hourly, JANUARY).count() == 740
    assert rows_of(profile.daily_coverage(hourly), "rows") == [(4,)]


def test_profile_of_an_empty_window(spark):
    hourly = profile.hourly_coverage(events(spark, [(None, 1)]), JANUARY)
    row = profile.coverage_summary(hourly, JANUARY).first()
    assert (row.observed_hours, row.missing_hours, row.observed_days) == (0, 744, 0)
    assert row.mean_rows_per_observed_hour is None


def test_profile_keeps_rows_the_daylight_saving_rule_drops(spark):
    raw = events(spark, MARCH_ROWS)
    kept = profile.zone_profile(profile.zone_cells(raw, dimension(spark), MARCH)).first()
    assert kept.retained_rows == 4


def test_raw_rows_are_counted_before_any_join(spark):
    plan = march_cells(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def test_two_zone_lookup_serves_two_zones(spark):
    flags = dict(rows_of(classify.lookup_flags(two_zone_lookup(spark))))
    assert flags == {1: False, 2: False, 264: True, 265: True}
    assert utc("2026-03-08T06:00").hour == 6


def skewed(spark, rows=30_000):
    """A third of the rows has no zone, a third zone 1, the others are spread over 400 zones."""
    zone = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 1).otherwise(
        2 + F.pmod(F.xxhash64("id"), F.lit(400))
    )
    return spark.range(0, rows, 1, 8).select(
        F.lit("2026-03-05 10:00:00").cast("timestamp_ntz").alias("pickup_ts"),
        zone.cast("int").alias("zone_raw"),
    )


def test_hot_zones_are_found_by_a_sketch(spark):
    assert classify.hot_zones(skewed(spark), tasks=8) == [1]
    assert classify.hot_zones(skewed(spark).where("zone_raw > 1"), tasks=8) == []
    assert classify.hot_zones(skewed(spark).limit(0)) == []


def test_no_task_of_the_exchange_is_hot(spark):
    raw = skewed(spark)
    zones = spark.range(1, 300).select(
        F.col("id").cast("int").alias("zone_id"),
        F.lit("Queens").alias("borough"),
        F.lit("A").alias("zone_name"),
        F.when(F.col("id") == 5, "N/A").otherwise("Boro").alias("service_zone"),
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = classify.hot_zones(raw)
        split = classify.label_dispositions(raw, zones, MARCH, hot=hot)
        plan = split._jdf.queryExecution().executedPlan().toString()
        # The hot side has a broadcast join above the scan, the other one an exchange.
        union = plan.split("SortMergeJoin")
        assert len(union) == 2 and "BroadcastHashJoin" in union[0] and "hashpartitioning" not in union[0]
        task = F.spark_partition_id().alias("task")
        sizes = split.where("zone_raw > 1").groupBy(task).count()
        sizes = sorted(r["count"] for r in sizes.collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
        whole = classify.label_dispositions(raw, zones, MARCH)
        assert bag_diff_rows(split, whole).first()[0] == 0
        counted = dict(rows_of(split.groupBy("disposition").count()))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert counted["null_zone"] == 10_000 and sum(counted.values()) == raw.count()
    assert counted["non_service_zone"] > 0 and counted["not_in_lookup"] > 0
    with pytest.raises(ParameterError):
        classify.label_dispositions(raw, zones, MARCH, hot=range(classify.HOT_ITEMS + 1))
