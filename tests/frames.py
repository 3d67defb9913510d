"""Small hand-built inputs shared by the tests."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hourgrid.operators.splits import Splits
from hourgrid.schemas import GRID, LOOKUP

TZ = "America/New_York"

EVENTS = T.StructType(
    [
        T.StructField("event_no", T.LongType()),
        T.StructField("pickup_ts", T.TimestampNTZType()),
        T.StructField("zone_raw", T.IntegerType()),
    ]
)


def local(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def events(spark: SparkSession, rows: list[tuple[str | None, int | None]]) -> DataFrame:
    data = [(i, local(ts), zone) for i, (ts, zone) in enumerate(rows)]
    return spark.createDataFrame(data, EVENTS)


def lookup(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, LOOKUP)


def two_zone_lookup(spark: SparkSession) -> DataFrame:
    return lookup(
        spark,
        [
            (1, "EWR", "Airport", "EWR"),
            (2, "Queens", "Park", "Boro Zone"),
            (264, "Unknown", "N/A", "N/A"),
            (265, "N/A", "Outside of NYC", "N/A"),
        ],
    )


def grid_frame(
    spark: SparkSession, counts: list[int | None], zone: int = 1, start: str = "2026-01-01T00:00"
) -> DataFrame:
    first = utc(start)
    rows = [
        (
            zone,
            first + timedelta(hours=i),
            value,
            (first + timedelta(hours=i)).strftime("%Y-%m"),
            "source_missing" if value is None else "available",
        )
        for i, value in enumerate(counts)
    ]
    return spark.createDataFrame(rows, GRID)


def splits(*bounds: str) -> Splits:
    a, b, c, d = (utc(text) for text in bounds)
    return Splits((a, b), (b, c), (c, d))


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    names = columns or tuple(df.columns)
    return [tuple(row) for row in df.select(*names).collect()]
