"""A corpus pipeline of five operators: each stage is written and read by the next.

Language ID drops documents without a language and sets `lang`; line dedup rewrites
`text`; the Jaccard join leaves one document of each group; mixing repeats and leaves
out documents to meet the target weights; SentencePiece gives the ids.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import load, stored
from hourgrid.llm.jaccard_join import near_documents
from hourgrid.llm.language_id import UNKNOWN, learn_and_identify
from hourgrid.llm.line_dedup import drop_repeated_lines
from hourgrid.llm.mixing import mix_documents
from hourgrid.llm.registry import MIX, with_tree
from hourgrid.llm.sentencepiece_codec import encode_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def carrying(stage: Stage) -> Stage:
    """Send columns beside COLUMNS through a stage as one, so that no name of theirs clashes."""

    @wraps(stage)
    def carried(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in COLUMNS]
        if not others:
            return stage(spark, docs, sf_dir)
        own = [c for c in docs.columns if c in COLUMNS]
        packed = docs.select(*own, F.struct(*others).alias("carried"))
        rows = stage(spark, packed, sf_dir)
        return rows.select(*(F.col("carried").getField(c).alias(c) if c in others else c for c in docs.columns))

    return carried


@carrying
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; `lang` is the one predicted."""
    rows = learn_and_identify(docs).where(F.col("_lang") != UNKNOWN)
    return rows.withColumn("lang", F.col("_lang")).select(*docs.columns)


@carrying
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their repeated lines; `n_chars` counts what is left."""
    rows = drop_repeated_lines(docs).withColumn("text", F.col("_kept_text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.length("text").cast(kind))
    return rows.select(*docs.columns)


@carrying
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each linked group: one with the smallest id, without an id if all are.

    Rows are told apart by a key of their own, so repeated and null ids link nothing.
    """
    keyed = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    found = near_documents(keyed, id_col="_row")
    found = found.select(F.col("doc_id").alias("_row"), "component_id")
    found = stored(found.join(keyed.select("_row", "doc_id"), "_row"), "near-groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "_row"))
    kept = found.groupBy("component_id").agg(first.alias("first")).select("first._row")
    gone = found.select("_row").join(kept, "_row", "left_anti")
    return keyed.join(gone, "_row", "left_anti").select(*docs.columns)


@carrying
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, one row for each epoch they are in."""
    return mix_documents(with_tree(docs), MIX).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    rows = encode_documents(docs, keep=["doc_id", "lang", "source"])
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.col("_ids").alias("ids"),
        F.size("_ids").cast("long").alias("n_ids"),
        F.col("_exact").alias("exact"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

# Models and components are not SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
