"""Readers and writers of the demand tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.errors import ContractError
from hourgrid.operators.counts import duplicate_keys
from hourgrid.schemas import KEY, LOOKUP, LOOKUP_CSV
from hourgrid.session import require_utc
from hourgrid.sources.contracts import assert_schema, require_rows, required_columns


def read_events(
    spark: SparkSession, *paths: str, ts_col: str, zone_col: str, month_col: str | None = None
) -> DataFrame:
    """Raw events from one or more Parquet paths, pruned to the columns used."""
    names = [ts_col, zone_col, *([month_col] if month_col else [])]
    return required_columns(spark.read.parquet(*paths), names).select(*names)


def rename_lookup(raw: DataFrame) -> DataFrame:
    """Lookup columns as the operators name them; a key that is no integer becomes NULL."""
    required_columns(raw, LOOKUP_CSV.names)
    return raw.select(
        F.col("LocationID").try_cast("int").alias("zone_id"),
        F.col("Borough").cast("string").alias("borough"),
        F.col("Zone").cast("string").alias("zone_name"),
        F.col("service_zone").cast("string"),
    )


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with typed columns; the text N/A stays data."""
    raw = spark.read.schema(LOOKUP_CSV).csv(path, header=True, enforceSchema=False)
    return rename_lookup(raw)


def read_lookup_text(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV read as text and cast afterwards; columns found by name."""
    return rename_lookup(spark.read.csv(path, header=True))


def read_table(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType,
    split: str | None = None,
    columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """One table from one or more Parquet paths, schema-checked; split is pushed down."""
    table = spark.read.parquet(*paths)
    table = required_columns(table, schema.names).select(*schema.names)
    assert_schema(table, schema)
    if split is not None:
        table = table.where(F.col("split") == split)
    return table if columns is None else table.select(*columns)


def write_sorted(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    partitions: int | None = None,
) -> int:
    """Write Parquet (ZSTD) in global (hour, zone) order; returns the rows of the plan.

    Range partitions keep hours together, so a filter on the hour skips files
    and row groups. Rows are counted above the range exchange, past the sampling
    that chooses its bounds.
    """
    require_utc(df.sparkSession)
    order = ["target_hour_utc", "zone_id"]
    lead = [partition_by] if partition_by else []
    args = [partitions] if partitions else []
    ordered = df.repartitionByRange(*args, *lead, *order).sortWithinPartitions(*lead, *order)
    seen = Observation()
    writer = (
        ordered.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "zstd")
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def check_written(
    spark: SparkSession, path: str, schema: T.StructType, expected_rows: int
) -> DataFrame:
    """Read a written table back and check schema, rows and key uniqueness."""
    table = require_rows(read_table(spark, path, schema=schema))
    rows = table.count()
    if rows != expected_rows:
        raise ContractError(f"written table has {rows} rows, expected {expected_rows}")
    if not duplicate_keys(table, KEY).isEmpty():
        raise ContractError("written table repeats keys")
    return table


def write_report(report: DataFrame, path: str) -> None:
    """Write a metric frame as JSON lines."""
    report.write.mode("overwrite").json(path)


def nested_report(sections: dict[str, DataFrame]) -> DataFrame:
    """Metric frames as one row per section: name and the rows as a JSON array.

    For frames of a fixed size only: every section becomes one value. Reports with a
    row per zone or per hour of the window are written as their own frames.
    """
    parts = [
        df.select(F.struct(*df.columns).alias("row"))
        .agg(F.to_json(F.collect_list("row")).alias("rows"))
        .select(F.lit(name).alias("section"), "rows")
        for name, df in sections.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


__all__ = [
    "LOOKUP",
    "check_written",
    "nested_report",
    "read_events",
    "read_lookup",
    "read_lookup_text",
    "read_table",
    "rename_lookup",
    "write_report",
    "write_sorted",
]
