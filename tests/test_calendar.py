from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from frames import TZ, local, utc
from pyspark.sql import functions as F

from hourgrid.errors import ParameterError
from hourgrid.functions.calendar import (
    LocalWindow,
    dst_calendar,
    hour_of_number,
    hour_series,
    local_anomalies,
    local_hour_kind,
    ntz,
    utc_hour,
    utc_hour_number,
)


def kinds(month: str, tz: str = TZ):
    return [(a.kind, a.start, a.end) for a in LocalWindow.month(month, tz).anomalies]


def test_clock_changes_of_a_year():
    assert kinds("2026-03") == [("nonexistent", local("2026-03-08T02:00"), local("2026-03-08T03:00"))]
    assert kinds("2026-11") == [("ambiguous", local("2026-11-01T01:00"), local("2026-11-01T02:00"))]
    assert kinds("2026-01") == []


def test_half_hour_shift_follows_the_half_hour_mark():
    # Lord Howe moves by 30 minutes: the skipped half hour ends before the mark
    # of its slot is reached, the repeated one covers the mark.
    found = local_anomalies(datetime(2026, 1, 1), datetime(2027, 1, 1), "Australia/Lord_Howe")
    assert [a.kind for a in found] == ["ambiguous"]


@pytest.mark.parametrize("tz", [TZ, "Europe/Berlin", "America/Santiago", "UTC"])
def test_expression_agrees_with_the_offset_walk(spark, tz):
    start, end = datetime(2024, 1, 1), datetime(2027, 1, 1)
    hours = hour_series(spark, start, end, "hour")
    found = dst_calendar(hours, "hour", tz).orderBy("start_local")
    walked = local_anomalies(start, end, tz)
    assert [(r.kind, r.start_local, r.end_local) for r in found.collect()] == [
        (a.kind, a.start, a.end) for a in walked
    ]


def test_hour_kind_of_single_times(spark):
    rows = [("2026-03-08 02:59:59",), ("2026-03-08 03:00:00",), ("2026-11-01 01:00:00",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp_ntz"))
    found = df.select(local_hour_kind(F.col("t"), TZ).alias("k")).collect()
    assert [r.k for r in found] == ["nonexistent", None, "ambiguous", None]


def test_window_bounds_and_hours():
    march, november = LocalWindow.month("2026-03", TZ), LocalWindow.month("2026-11", TZ)
    assert (march.hours, november.hours) == (743, 721)
    assert march.utc_start == utc("2026-03-01T05:00")
    assert march.utc_end == utc("2026-04-01T04:00")
    assert november.ambiguous_hours == (utc("2026-11-01T05:00"), utc("2026-11-01T06:00"))
    assert LocalWindow.months(["2025-12", "2026-01"], TZ).end == datetime(2026, 2, 1)


def test_bad_windows_are_rejected():
    with pytest.raises(ParameterError):
        LocalWindow.months(["2026-01", "2026-03"], TZ)
    with pytest.raises(ParameterError):
        LocalWindow(datetime(2026, 1, 1, 0, 30), datetime(2026, 2, 1), TZ)
    with pytest.raises(ParameterError):
        LocalWindow(datetime(2026, 2, 1), datetime(2026, 1, 1), TZ)
    with pytest.raises(ParameterError):
        LocalWindow(utc("2026-01-01"), utc("2026-02-01"), TZ)


def test_hour_series_is_half_open_and_keeps_its_type(spark):
    naive = hour_series(spark, datetime(2026, 3, 8), datetime(2026, 3, 9), "h")
    aware = hour_series(spark, utc("2026-03-08"), utc("2026-03-09"), "h")
    assert naive.schema["h"].dataType.simpleString() == "timestamp_ntz"
    assert aware.schema["h"].dataType.simpleString() == "timestamp"
    assert naive.count() == aware.count() == 24
    assert naive.agg(F.max("h")).first()[0] == datetime(2026, 3, 8, 23)


@pytest.mark.parametrize("tz", [TZ, "Asia/Kolkata"])
def test_utc_hour_matches_zoneinfo(spark, tz):
    times = [datetime(2026, 3, 1, 0, 10) + timedelta(hours=7 * i, minutes=13 * i) for i in range(200)]
    times = [t for t in times if not (t.month == 3 and t.day == 8 and t.hour == 2)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = [r[0] for r in df.select(utc_hour(F.col("t"), tz).cast("timestamp_ntz")).collect()]
    want = [
        t.replace(tzinfo=ZoneInfo(tz)).astimezone(ZoneInfo("UTC")).replace(
            tzinfo=None, minute=0, second=0
        )
        for t in times
    ]
    assert got == want


@pytest.mark.parametrize("tz", [TZ, "Asia/Kolkata", "Australia/Lord_Howe", "Europe/Berlin"])
def test_hour_arithmetic_agrees_with_the_time_zone_functions(spark, tz):
    window = LocalWindow(datetime(2024, 1, 1), datetime(2026, 1, 1), tz)
    changes = [t for a in window.anomalies for t in (a.start, a.end)]
    df = (
        spark.range(2 * 365 * 24 * 3)
        .select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1199).alias("t"))
        .select(F.col("t").cast("timestamp_ntz"))
        .where(local_hour_kind(F.col("t"), tz).isNull() if tz != "Australia/Lord_Howe" else F.lit(True))
    )
    for low, high in zip(changes[::2], changes[1::2]):
        df = df.where((F.col("t") < ntz(low)) | (F.col("t") >= ntz(high)))
    if tz == "Australia/Lord_Howe":
        # Half an hour is skipped before the half-hour mark of its slot.
        df = df.where(F.date_format("t", "MMdd") != "1006").where(F.date_format("t", "MMdd") != "1005")
    fast = hour_of_number(utc_hour_number(F.col("t"), window))
    assert df.count() > 40000
    assert df.where(fast != utc_hour(F.col("t"), tz)).isEmpty()


def test_hour_arithmetic_before_the_epoch(spark):
    window = LocalWindow(datetime(1969, 12, 1), datetime(1969, 12, 31), TZ)
    df = spark.createDataFrame([(datetime(1969, 12, 30, 23, 59, 59),)], "t timestamp_ntz")
    hour = hour_of_number(utc_hour_number(F.col("t"), window)).cast("timestamp_ntz")
    assert df.select(hour).first()[0] == datetime(1969, 12, 31, 4)
