"""The corpus operators as queries over the driver tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import held_out, load, stored
from hourgrid.llm.embedding_dedup import near_vectors
from hourgrid.llm.exact_dedup import exact_classes
from hourgrid.llm.fill_in_middle import fill_in_middle
from hourgrid.llm.jaccard_join import near_documents
from hourgrid.llm.language_id import learn_and_identify
from hourgrid.llm.line_dedup import drop_repeated_lines
from hourgrid.llm.mixing import Mix, mix_documents, word_count
from hourgrid.llm.quality import quality
from hourgrid.llm.quality_rules import clean_documents
from hourgrid.llm.sentencepiece_codec import encode_documents
from hourgrid.llm.sharding import byte_shards
from hourgrid.llm.token_alignment import align_tokens, pair_counts, score_links
from hourgrid.llm.toxicity import toxicity

TOXIC_FROM = 0.3

# src0 is by far the largest source; its domain gets 8 of 20 parts.
MIX = Mix(
    budget_share=0.5,
    max_epochs=4,
    seed=17,
    weights={
        ("crawl",): 8,
        ("sites",): 7,
        ("books",): 5,
        ("crawl", "en"): 5,
        ("sites", "en"): 4,
        ("books", "en"): 4,
        ("books", "es"): 3,
        ("sites", "en", "src1"): 9,
    },
    default_weight=2,
)


def domain(source) -> F.Column:
    """Top level of the mixing tree: src0 is the crawl, src1-src9 sites, all else books."""
    return (
        F.when(source == "src0", "crawl")
        .when(source.rlike("^src[1-9]$"), "sites")
        .otherwise("books")
    )


def with_tree(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"domain": domain(F.col("source")), "tokens": word_count(F.col("text"))})


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_tree(load(spark, sf_dir, "documents"))
    docs = docs.select("doc_id", "domain", "lang", "source", "tokens")
    return mix_documents(stored(docs, "mix-rows"), MIX)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_documents(load(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select(
        "doc_id",
        F.col("_ids").alias("ids"),
        F.size("_ids").cast("long").alias("n_ids"),
        F.col("_exact").alias("exact"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources are the hosts, and a source's languages its paths."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    return quality(docs, labels, F.col("source"), F.col("lang"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(load(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = byte_shards(load(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = learn_and_identify(load(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"),
    )


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(load(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_repeated_lines(load(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2("_kept_text", 256).alias("kept_sha256"),
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(load(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_documents(load(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = align_tokens(docs, keep=["row", "doc_id"]).withColumn("groups_sha256", digest)
    rows = stored(rows.drop("groups"), "aligned")
    scored = score_links(rows, stored(pair_counts(rows), "pairs"))
    return scored.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        "groups_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_quality": op3_quality,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sharding": op5_sharding,
    "op6_language_id": op6_language_id,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_line_dedup": op8_line_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_quality_rules": op11_quality_rules,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_alignment": op13_token_alignment,
}
