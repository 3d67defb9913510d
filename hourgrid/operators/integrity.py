"""Order-free fingerprints, dataset manifests and the leakage probe."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.calendar import instant
from hourgrid.operators.grid import bag_diff


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (rows, hash_sum, hash_xor) that ignores row order and file layout.

    The hash skips NULLs, so a NULL mask is hashed along to keep their place.
    """
    mask = F.concat(*[F.col(name).isNull().cast("int").cast("string") for name in df.columns])
    hashed = df.select(F.xxhash64(*[F.col(name) for name in df.columns], mask).alias("h"))
    return hashed.agg(*_summary())


def _summary() -> list[Column]:
    """Rows, sum and exclusive or of the hashes h; sums of files or of rows are the same."""
    return [
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.pmod("h", F.lit(2**31))), F.lit(0)).alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
    ]


FILE_KEYS = ("file_path", "file_size", "file_time")
FILE_STATE = (
    "dataset string, schema string, file_path string, file_size long, file_time timestamp, "
    "rows long, hash_sum decimal(38,0), hash_xor long"
)


def files_of(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files below paths, with size and time; no file is opened."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths))
    )
    return listed.select(
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("file_time"),
    )


def file_manifest(
    spark: SparkSession,
    name: str,
    paths: tuple[str, ...],
    columns: tuple[str, ...] | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """One row per file of a dataset: its size, time, rows and fingerprint of columns.

    Files that known records under the same name, size and time are taken from there;
    only the others are read, and of them only columns. Partition values are hashed
    with the rows they belong to.
    """
    listed = files_of(spark, *paths)
    fresh = listed
    kept = None
    if known is not None:
        known = known.where(F.col("dataset") == name)
        kept = known.join(listed, list(FILE_KEYS), "left_semi").select(*known.columns)
        fresh = listed.join(known, list(FILE_KEYS), "left_anti")
    # One name for each new or changed file, as any reader of the files needs.
    todo = [row.file_path for row in fresh.select("file_path").toLocalIterator()]
    if not todo:
        return kept if kept is not None else spark.createDataFrame([], FILE_STATE)
    reader = spark.read
    if len(paths) == 1 and not paths[0].endswith(".parquet"):
        reader = reader.option("basePath", paths[0])
    rows = reader.parquet(*todo)
    schema = rows.select(*columns).schema if columns else rows.schema
    names = schema.names
    mask = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in names])
    read = (
        rows.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("file_time"),
            F.xxhash64(*names, mask).alias("h"),
        )
        .groupBy(*FILE_KEYS)
        .agg(*_summary())
    )
    # A file without rows has no group, but it is known all the same.
    zero = F.lit(0).cast("long")
    found = fresh.join(read, list(FILE_KEYS), "left").select(
        F.lit(name).alias("dataset"),
        F.lit(schema.simpleString()).alias("schema"),
        *FILE_KEYS,
        F.coalesce("rows", zero).alias("rows"),
        F.coalesce("hash_sum", zero).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce("hash_xor", zero).alias("hash_xor"),
    )
    return found if kept is None else kept.unionByName(found)


def folded(files: DataFrame) -> DataFrame:
    """One row per dataset from the rows of file_manifest, as manifest() gives it.

    A dataset whose files have different schemas is named by the smallest and the largest.
    """
    low, high = F.min("schema"), F.max("schema")
    return files.groupBy("dataset").agg(
        F.sum("rows").alias("rows"),
        F.when(low == high, low).otherwise(F.concat_ws(" | ", low, high)).alias("schema"),
        F.sum("hash_sum").cast("long").alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"),
    )


def manifest(datasets: dict[str, DataFrame]) -> DataFrame:
    """One row per dataset: name, rows, schema and fingerprint."""
    rows = [
        fingerprint(df).select(
            F.lit(name).alias("dataset"),
            "rows",
            F.lit(df.schema.simpleString()).alias("schema"),
            "hash_sum",
            "hash_xor",
        )
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def manifest_check(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Recorded datasets whose data is gone or changed, with the first reason that applies."""
    now = current.select("dataset", *[F.col(c).alias(f"now_{c}") for c in recorded.columns[1:]])
    reason = (
        F.when(F.col("now_rows").isNull(), "missing")
        .when(F.col("schema") != F.col("now_schema"), "schema")
        .when(F.col("rows") != F.col("now_rows"), "rows")
        .when(
            (F.col("hash_sum") != F.col("now_hash_sum"))
            | (F.col("hash_xor") != F.col("now_hash_xor")),
            "content",
        )
    )
    return (
        recorded.join(now, "dataset", "left")
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("dataset", "reason", "rows", F.col("now_rows").alias("current_rows"))
    )


def perturb_from(grid: DataFrame, hour: datetime, amount: int) -> DataFrame:
    """The grid with every known count at or after hour raised by amount."""
    late = F.col("target_hour_utc") >= instant(hour)
    return grid.withColumn(
        "trip_count",
        F.when(late, F.col("trip_count") + F.lit(amount)).otherwise(F.col("trip_count")),
    )


def leakage_probe(
    grid: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    hour: datetime,
    own_columns: tuple[str, ...] = ("target_trip_count",),
    amount: int = 1000,
) -> DataFrame:
    """Feature rows at or before hour that change when counts from hour on are changed.

    Empty when no feature sees its own hour or a later one. own_columns hold the
    target itself and are left out.
    """

    def early(frame: DataFrame) -> DataFrame:
        rows = build(frame).where(F.col("target_hour_utc") <= instant(hour))
        return rows.drop(*own_columns)

    return bag_diff(early(grid), early(perturb_from(grid, hour, amount)))
