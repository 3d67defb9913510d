"""Alignment against the two libraries on whole texts and plain dictionaries."""

import json
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hourgrid.llm import token_alignment
from hourgrid.llm.registry import QUERIES
from hourgrid.llm.token_alignment import (
    ADDED,
    BYTE_BPE_FILE,
    PIECE_FILE,
    Pair,
    align,
    align_tokens,
    byte_level_tokens,
    frequent_from,
    pair_counts,
    piece_tokens,
    score_links,
)

A = Tokenizer.from_file(BYTE_BPE_FILE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
A_BYTES, B_BYTES = byte_level_tokens(open(BYTE_BPE_FILE, "rb").read()), piece_tokens(B)


@pytest.fixture(scope="module")
def tables():
    return Pair(open(BYTE_BPE_FILE, "rb").read(), open(PIECE_FILE, "rb").read())


def test_both_byte_level_encoders_give_the_same_ids():
    ranked = token_alignment.rank_encoder(open(BYTE_BPE_FILE, "rb").read())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 11 == 0)]
    for low in range(0, len(points), 512):
        text = "".join(f"a{chr(c)}a 1{chr(c)}1 !{chr(c)}!  {chr(c)} x" for c in points[low : low + 512])
        assert ranked(text) == A.encode(text, add_special_tokens=False).ids
    spec = json.loads(open(BYTE_BPE_FILE).read())
    spec["model"]["merges"][:2] = spec["model"]["merges"][1::-1]
    assert token_alignment.rank_encoder(json.dumps(spec).encode()) is None


def expected(text):
    nothing = (0, 0, 0, 0, "", [], [])
    if not text:
        return nothing
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if b"".join(A_BYTES[i] for i in a) != whole or b"".join(B_BYTES[i] for i in b) != whole:
        return nothing
    end_a = np.cumsum([len(A_BYTES[i]) for i in a]).tolist()
    end_b = np.cumsum([len(B_BYTES[i]) for i in b]).tolist()
    at_a, at_b = dict(zip(end_a, a)), dict(zip(end_b, b))
    both, groups = sorted(set(end_a) & set(end_b)), []
    left, right = iter(zip(end_a, a)), iter(zip(end_b, b))
    for end in both:
        mine = []
        for side in (left, right):
            ids = []
            for e, x in side:
                ids.append(str(x))
                if e == end:
                    break
            mine.append(",".join(ids))
        groups.append("|".join(mine))
    links = [at_a[e] for e in both], [at_b[e] for e in both]
    return len(a), len(b), len(both), len(both), ";".join(groups), *links


TEXTS = [
    None, "", " ", "  ", "a", "a ", " a  b ", "a  ", "\n", "\t \n x", "x" * 3000, "▁", "a▁ b",
    "<s>hi</s> <|endoftext|><unk> <0x0A>", "\x00 \x00", "it's we'll 12 345", "été 🙂 漢字　x  y",
    "a  b\u0085 c​ d﻿", "The cat sat. The cat sat.", "The dog sat, the cat ran!!",
]


def aligned(texts, tables):
    return list(zip(*(c.to_pylist() for c in align(pa.array(texts, pa.string()), tables))))


@pytest.mark.parametrize("memo", [0, 8, 200_000])
def test_texts_of_every_kind(tables, monkeypatch, memo):
    monkeypatch.setattr(token_alignment, "MEMO_SEGMENTS", memo)
    assert aligned(TEXTS, tables) == [expected(t) for t in TEXTS]
    assert aligned(TEXTS[::-1], tables) == [expected(t) for t in TEXTS[::-1]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["a", "B", " ", "  ", "\n", "\t", "'s", "é", " ", "　", "🙂", "!!", "7", "漢", "́", "the", "\x1c", "\x85"]
), max_size=25), max_size=5))
def test_any_texts(tables, parts):
    texts = ["".join(p) for p in parts]
    assert aligned(texts, tables) == [expected(t) for t in texts]


def scores(rows):
    """(doc_id, n_best, count_sum) from dictionaries of the links of all rows."""
    links = [(i, list(zip(*expected(t)[5:]))) for i, t in rows]
    counts = Counter(pair for _, mine in links for pair in mine)
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return sorted(
        ((i, sum(counts[p] == top[p[1]] for p in mine), sum(counts[p] for p in mine)) for i, mine in links),
        key=repr,
    )


@pytest.mark.parametrize("room", [0, 20, 1 << 20])
def test_counts_over_all_rows(docs_of, room):
    rows = [(i, t) for i, t in enumerate(TEXTS * 2)] + [(None, TEXTS[-1]), (3, TEXTS[-2]), (3, TEXTS[-2])]
    docs = docs_of(rows).withColumn("row", F.monotonically_increasing_id())
    one = token_alignment.stored(align_tokens(docs), "test-aligned")
    counts = token_alignment.stored(pair_counts(one), "test-pairs")
    out = score_links(one, counts, room).collect()
    assert sorted(((r.doc_id, r.n_best, r.count_sum) for r in out), key=repr) == scores(rows)
    assert len(out) == len(rows)


def test_cache_bound_is_kept(spark):
    counts = spark.createDataFrame([(i, i, n) for i, n in enumerate([1, 1, 2, 3, 4, 9])], "a int, b int, n long")
    for room in range(7):
        assert counts.where(F.col("n") >= frequent_from(counts, room)).count() <= room
    assert frequent_from(counts, 6) == 1 and frequent_from(counts, 4) == 2


def test_query_and_edges(spark, docs_of, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (7, "long words " * 3_000)]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op13_token_alignment"](spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.n_best, r.count_sum) for r in out), key=repr) == scores(rows)
    import hashlib

    want = {(i, *expected(t)[:4], expected(t)[4] and hashlib.sha256(expected(t)[4].encode()).hexdigest()) for i, t in rows}
    assert {(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) for r in out} == want
    one = align_tokens(docs_of(rows * 3)).collect()
    counted = sum((Counter(dict(zip(r.pairs, r.pair_links))) for r in one), Counter())
    assert counted == Counter(a << 32 | b for r in one for a, b in zip(r.link_a, r.link_b))
    clash = docs_of(rows[:3]).withColumnsRenamed({"lang": "n_a", "source": "row"})
    assert align_tokens(clash).columns == ["doc_id", "text", "row", "n_chars", *ADDED.names]
    empty = tmp_path / "none"
    docs_of(rows[:1]).limit(0).write.parquet(str(empty / "documents.parquet"))
    assert QUERIES["op13_token_alignment"](spark, str(empty)).collect() == []
