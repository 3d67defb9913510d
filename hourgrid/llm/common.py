"""What the corpus operators share: input, tables in the shared folder, size checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only up to this many bytes, counted beforehand.
BROADCAST_BYTES = 16 * 2**20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all nodes share: spark.checkpoint.dir, or one beside the warehouse if unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: short lineage, safe on lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """Mark df for broadcast if its counted size is within BROADCAST_BYTES; else leave it.

    df should be cheap to count, such as a stored table. Beyond the bound the join
    stays a shuffle join, whose skewed partitions adaptive execution splits.
    """
    if isinstance(row_bytes, int):
        size = df.count() * row_bytes
    else:
        size = df.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def free_prefix(columns: list[str]) -> str:
    """The shortest run of underscores with which none of the columns begins."""
    prefix = "_"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(id_column: str = "doc_id") -> Column:
    """The fold that no model learns from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))
