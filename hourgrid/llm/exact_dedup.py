"""Exact dedup by distributed radix partitioning, most significant bytes first.

All texts start in one node. At each level the next bytes of every open text are
its digit; texts of a node that share the digit, and either all end with it or all
go on, form a child node. A node with one text is settled, and so is a node whose
texts end: they are equal, byte by byte, without any digest. Only the other nodes
go to the next level, with the bytes not yet read. Digits grow by a constant
factor, so a text of b bytes needs about log(b) levels and every byte is compared
once.

Each level is one aggregation, combined before the shuffle so that a node of any
size sends one row per task, and one join of the open texts with the nodes that
hold several of them, whose skewed partitions adaptive execution splits. Levels are
tables in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import small_side, stored

FIRST_DIGIT_BYTES = 64
DIGIT_GROWTH = 64


def exact_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_digit: int = FIRST_DIGIT_BYTES,
    growth: int = DIGIT_GROWTH,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    keep_id is the largest id among equal texts. A null text counts as empty. A null
    id is smaller than any other. Rows that repeat both id and text are one document
    given several times: they share `kept`, and each counts in group_size. No rows
    give no rows; other columns of docs are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    open_rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.lit(0).cast("long").alias("node"),
        F.sha2(text, 256).alias("text_sha256"),
        text.cast("binary").alias("rest"),
    )
    settled = []
    width = first_digit
    while True:
        level = _level(open_rows, width)
        settled.append(level.where(F.col("node").isNull()))
        open_rows = level.where(F.col("node").isNotNull()).select(
            "doc_id", "node", "text_sha256", "rest"
        )
        if open_rows.isEmpty():
            break
        width *= growth
    rows = reduce(DataFrame.unionByName, settled)
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _level(open_rows: DataFrame, width: int) -> DataFrame:
    """Deal open texts to child nodes; settled rows lose node and rest."""
    digit = F.substring("rest", 1, width)
    ended = F.octet_length("rest") <= width
    nodes = stored(
        open_rows.groupBy("node", digit.alias("digit"), ended.alias("ended"))
        .agg(F.count("*").alias("size"), F.max("doc_id").alias("keep"))
        .where(F.col("size") > 1)
        .withColumn("child", F.monotonically_increasing_id())
        .withColumnRenamed("node", "parent"),
        "radix-nodes",
    )
    if width <= FIRST_DIGIT_BYTES:  # short digits; longer ones always meet in a shuffle
        nodes = small_side(nodes, F.octet_length("digit") + 64)
    same = (
        (F.col("node") == F.col("parent")) & (digit == F.col("digit")) & (ended == F.col("ended"))
    )
    joined = open_rows.join(nodes, same, "left")
    is_open = F.col("child").isNotNull() & ~F.col("ended")
    return stored(
        joined.select(
            "doc_id",
            "text_sha256",
            F.when(is_open, F.col("child")).alias("node"),
            F.when(is_open, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
            F.when(F.col("child").isNull(), F.col("doc_id"))
            .otherwise(F.col("keep"))
            .alias("keep_id"),
            F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        ),
        "radix-level",
    )
