"""SentencePiece ids against the library's, and exact round trips."""

import os
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from hourgrid.llm.sentencepiece_codec import (
    BPE, MEMO_POINTS, MODEL_FILE, UNIGRAM, Codec, Vocabulary, decode_documents, encode_documents, read_vocabulary,
)

pytestmark = pytest.mark.skipif(not os.path.exists(MODEL_FILE), reason="no vocabulary file")
PARTS = [
    "a", "b", "the", "ing", " ", "  ", "      ", "\n", "\t", "é", "日本", "😀", "_", ".com", "{}", "==",
    " def ", "0", "1234", "́", "\r\n", " " * 17, "a" * 40, "return", "Über", "x" * 70,
]


@pytest.fixture(scope="module")
def codec():
    return Codec(read_vocabulary())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)


def test_ids_equal_the_library(codec, library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 25))) for _ in range(2000)]
    assert [x.tolist() for x in codec.encode_all(texts)] == library.encode(texts)
    assert all(codec.decode(codec.encode(t)) == t for t in texts)


def test_streaming_search_equals_the_lockstep_search(codec, library):
    rng = random.Random(2)
    for _ in range(300):
        segment = " " + "".join(rng.choices([p for p in PARTS if " " not in p and "\n" not in p], k=12))
        assert list(codec.search(segment)) == library.encode(segment[1:])


def test_both_searches_give_the_same_ids_for_the_same_segments(codec, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 25))) for _ in range(500)]
    found = {s for t in texts for s in codec.segments.findall(" " + t) if len(s) <= MEMO_POINTS}
    streamed = {s: codec.encode_segment(s) for s in found}
    again = []
    monkeypatch.setattr(codec, "encode_segment", lambda s: again.append(s) or streamed[s])
    assert codec.lanes.encode(list(found)) == [streamed[s] for s in found]
    assert 0 < len(again) < len(found)  # segments written in bytes only


def test_a_text_without_blanks_is_committed_on_the_way(codec, library):
    text = "".join(random.Random(3).choices("abcdefghijklmnop-=/", k=30_000))
    ids = codec.search(" " + text)
    first = [next(ids) for _ in range(5)]
    assert first + list(ids) == library.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_round_trip(codec, text):
    assert codec.decode(codec.encode(text)) == text


def test_a_real_block_character_survives(codec):
    assert codec.decode(codec.encode("▁ ▁a▁")) == "▁ ▁a▁"


def test_unigram_paths_have_the_largest_score():
    rng = random.Random(5)
    words = {"".join(rng.choices("ab ", k=rng.randint(2, 4))) for _ in range(25)}
    pieces = {w.replace(" ", "▁"): 256 + k for k, w in enumerate(sorted(words | {"a", "b", " "}))}
    scores = [0.0] * 256 + [-rng.random() * 5 for _ in pieces]
    texts = [bytes([k]) for k in range(256)] + [p.replace("▁", " ").encode() for p in pieces]
    codec = Codec(Vocabulary(UNIGRAM, pieces, scores, list(range(256)), 0, texts))

    def best(text):
        tops = [0.0]
        for end in range(1, len(text) + 1):
            ways = [
                tops[low] + scores[pieces[text[low:end].replace(" ", "▁")]]
                for low in range(max(0, end - 4), end)
                if text[low:end].replace(" ", "▁") in pieces
            ]
            tops.append(max(ways))
        return tops[-1]

    for n in (1, 7, 40, 300):
        text = "".join(rng.choices("ab ", k=n))
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        assert sum(scores[k] for k in ids) == pytest.approx(best(" " + text))


def test_frames(docs_of, library):
    rows = [(1, None), (2, ""), (3, "Hello world"), (None, "same"), (4, "same"), (4, "same"), (5, "x y " * 50_000)]
    docs = docs_of(rows).withColumnsRenamed({"lang": "ids", "source": "exact"})
    out = encode_documents(docs)
    assert out.columns == [*docs.columns, "_ids", "_exact"]
    got = out.collect()
    assert all(r._exact and r._ids == library.encode(r.text or "") for r in got) and len(got) == 7
    back = decode_documents(out, keep=["doc_id", "text"]).collect()
    assert all(r._text == (r.text or "") for r in back)
    assert encode_documents(docs.limit(0)).collect() == []
    assert BPE == 2


def test_workers_hold_no_segments_after_a_task(spark, docs_of):
    docs = docs_of([(k, f"words of text {k} " * 20) for k in range(64)])
    assert encode_documents(docs, keep=["doc_id"]).where("size(_ids) > 0").count() == 64

    def held(batches):
        import pyarrow as pa

        from hourgrid.llm.sentencepiece_codec import _CODECS

        for _ in batches:
            codecs = list(_CODECS.values())
            sizes = [len(c.memo) + len(c.memo.older) for c in codecs]
            yield pa.RecordBatch.from_arrays([pa.array([len(codecs)]), pa.array([sum(sizes)])], names=["codecs", "kept"])

    rows = spark.range(0, 400, 1, 4).mapInArrow(held, "codecs long, kept long").collect()
    assert sum(r.codecs for r in rows) > 0 and sum(r.kept for r in rows) == 0
