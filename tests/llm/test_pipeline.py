"""The pipeline against its stages by brute force, on the smallest driver tables."""

import os

import pytest
import sentencepiece
from test_jaccard_join import expected as near_groups
from test_line_dedup import expected as deduped_lines

import corpus_pipeline
from hourgrid.llm.mixing import word_count
from hourgrid.llm.registry import MIX, QUERIES, with_tree
from hourgrid.llm.registry_sql import SQL
from hourgrid.llm.sentencepiece_codec import MODEL_FILE

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    named = stages["language_id"](spark, docs, SF_DIR).cache()
    assert named.columns == docs.columns
    told = {r.doc_id: r.lang for r in docs.collect()}
    agree = [told[r.doc_id] == r.lang for r in named.collect()]
    assert len(agree) == len(rows) and sum(agree) >= 0.97 * len(agree)

    lines = stages["line_dedup"](spark, named, SF_DIR).cache()
    want = [(i, text) for i, _, _, text in deduped_lines(rows)]
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    near = stages["near_duplicates"](spark, lines, SF_DIR).cache()
    first = {i for i, _, c in near_groups(want) if i == c}
    assert sorted(r.doc_id for r in near.collect()) == sorted(first)

    mixed = stages["source_mixing"](spark, near, SF_DIR).cache()
    assert mixed.columns == docs.columns
    tokens = with_tree(near).agg({"tokens": "sum"}).first()[0]
    taken = mixed.select(word_count(mixed.text).alias("n")).agg({"n": "sum"}).first()[0]
    assert taken >= tokens * MIX.budget_share - 100

    ids = stages["sentencepiece"](spark, mixed, SF_DIR).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert all(r.exact and r.ids == library.encode(texts[r.doc_id]) for r in ids)
    assert len(ids) == mixed.count()


def test_near_duplicates_go_by_row(spark, docs_of):
    copy, near = " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(59))
    other, alone = " ".join(f"x{k}" for k in range(60)), " ".join(f"y{k}" for k in range(60))
    rows = [(5, other), (5, copy), (3, near), (7, alone), (7, alone), (None, "a b c d"), (None, "a b c d"), (None, None), (8, "")]
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs_of(rows), SF_DIR)
    want = [(5, other), (3, near), (7, alone), (None, "a b c d"), (None, None), (8, "")]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)


CLASHING = ["_lang", "_row", "_kept_text", "tokens", "domain", "epoch", "budget", "component_id", "node", "document"]


def stages_over(spark, docs, folder):
    """Each stage's rows, over the written rows of the one before."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def test_stages_on_nulls_repeats_and_clashing_names(spark, docs_of, tmp_path):
    text = "the house and the garden of the old man with a dog\n" * 2
    rows = [
        (1, text, "en", "src0"), (1, text, "en", "src0"), (2, None, "en", "src1"), (3, "", None, None),
        (None, text + "more of it", None, "src2"), (4, "12 34", "en", "src0"), (5, "der Garten und das Haus", "de", None),
        (6, "der Hund " * 40_000, "de", "src5"), (None, None, None, None),
    ]
    docs = docs_of(rows).selectExpr("*", *(f"'mine' AS `{name}`" for name in CLASHING))
    out = stages_over(spark, docs, tmp_path)
    for stage in out[:-1]:
        assert stage.columns == docs.columns
        assert all(r[name] == "mine" for r in stage.select(*CLASHING).collect() for name in CLASHING)
    assert sorted((r.doc_id for r in out[0].collect()), key=repr) == sorted([1, 1, None, 5, 6], key=repr)
    assert out[0].where("lang IS NULL").isEmpty()
    assert out[1].count() == 5 and 2 <= out[2].count() <= 4
    assert {r.doc_id for r in out[2].collect()} >= {5, 6}
    assert all(r.exact for r in out[4].collect())


def test_stages_on_an_empty_table(spark, docs_of, tmp_path):
    out = stages_over(spark, docs_of([]), tmp_path)
    assert [stage.count() for stage in out] == [0] * 5


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_ids", "exact"]
    assert out.where("not exact").isEmpty() and not out.isEmpty()


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    from oracle_check import compare, connect

    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
