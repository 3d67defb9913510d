"""Language ID against a plain naive Bayes, and on the edge cases."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from hourgrid.llm import language_id
from hourgrid.llm.language_id import (
    BUCKETS, ORDERS, features, identify, learn_and_identify, score_texts, train,
)
from hourgrid.llm.textbatch import PIECE_BYTES, letters, pieces

WORDS = {
    "en": "the of and with house there thing ing".split(),
    "de": "der und nicht schön über keit ung ß".split(),
    "fr": "le être çela où aux été garçon que".split(),
}


def sentences(n, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        out.append((i, " ".join(rng.choices(WORDS[lang], k=rng.randint(3, 30))), lang, "src1"))
    return out


def test_held_out_accuracy_and_edges(docs_of):
    edges = [
        (1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "123 !?", "de", "s"),
        (1003, "ünd nicht", None, "s"), (None, "the thing", "en", "s"), (1004, "日本 語", "en", "s"),
        (1005, "über nicht " * 60_000, None, "s"),
    ]
    docs = docs_of(sentences(300) + edges)
    rows = {r.doc_id: r for r in learn_and_identify(docs, keep=["doc_id"]).collect()}
    assert len(rows) == 307
    right = [rows[i]._lang == lang for i, _, lang, _ in sentences(300)]
    assert sum(right) >= 297
    assert [rows[i]._lang for i in (1000, 1001, 1002)] == ["und"] * 3
    assert [rows[i]._score for i in (1000, 1001, 1002)] == [0.0] * 3
    assert rows[1003]._lang == "de" and rows[None]._lang == "en" and rows[1005]._lang == "de"
    assert rows[1004]._lang in WORDS and all(0 <= r._score <= 1 for r in rows.values())


def test_nothing_learned_and_empty_table(docs_of):
    docs = docs_of([(1, "some text", None, "s")])
    assert [(r._lang, r._score) for r in learn_and_identify(docs).collect()] == [("und", 0.0)]
    assert learn_and_identify(docs.limit(0)).collect() == []


def test_model_equals_plain_counts(docs_of):
    rows = sentences(60) + [(90, None, "en", "s"), (91, "", "de", "s")]
    model = train(docs_of(rows))
    counts = defaultdict(Counter)
    for _, text, lang, _ in rows:
        column = pa.array([text or ""])
        for piece in pieces(column, 2):
            points = letters(piece.points)
            for order in ORDERS:
                counts[lang].update(x for x in features(piece, order, points).tolist() if x < BUCKETS)
    plain = {}
    for lang, found in counts.items():
        total = sum(found.values()) + language_id.SMOOTHING * BUCKETS
        plain[lang] = {b: math.log((n + language_id.SMOOTHING) / total) for b, n in found.items()}
    assert model.languages == sorted(counts)
    # The model keeps differences between languages only.
    shared = set(plain["de"]) & set(plain["en"])
    for bucket in shared:
        got = model.log_p[0, bucket] - model.log_p[1, bucket]
        assert abs(got - (plain["de"][bucket] - plain["en"][bucket])) < 1e-4


def test_a_text_in_pieces_counts_every_gram_once(monkeypatch):
    text = "überall und nirgends, sagte der Rabe. " * 40
    whole = Counter()
    for piece in pieces(pa.array([text]), 2):
        for order in ORDERS:
            whole.update(features(piece, order, letters(piece.points)).tolist())
    parts = Counter()
    for piece in pieces(pa.array([text]), 2, limit=101):
        for order in ORDERS:
            found = features(piece, order, letters(piece.points))
            parts.update(found[found < BUCKETS].tolist())
    whole.pop(BUCKETS, None)
    assert parts == whole


def test_extra_columns_and_ties(docs_of, spark):
    docs = docs_of(sentences(30)).withColumnRenamed("source", "score")
    out = identify(docs, train(docs))
    assert out.columns == [*docs.columns, "_lang", "_score"] and out.count() == 30
    model = language_id.LanguageModel(
        ["a", "b"], np.zeros(2), np.zeros((2, BUCKETS + 1), np.float32)
    )
    names, score = score_texts(pa.array(["word"]), model)
    assert names == ["a"] and score[0] == 0.5
    assert PIECE_BYTES > 0


def test_groups_of_languages_give_what_one_matrix_gives(docs_of):
    """Seven languages by one, two and all; some without text, one named like the unknown."""
    rng = random.Random(5)
    rows = [
        (i, " ".join(rng.choices(WORDS[sorted(WORDS)[i % 3]], k=rng.randint(1, 12))), f"l{i % 5}", "s")
        for i in range(150)
    ] + [(900, "ab ba", "und", "s"), (901, None, "zz", "s"), (902, "12", "en", "s"), (903, None, None, "s")]
    docs = docs_of(rows).withColumnRenamed("source", "_top").withColumnRenamed("n_chars", "_lang")
    whole = sorted(identify(docs, train(docs)).collect(), key=lambda r: r.doc_id)
    assert {r._lang for r in whole} >= {"l0", "und"} and all(r._top == "s" for r in whole)
    assert next(r for r in whole if r.doc_id == 900)._score > 0
    for group in (1, 2, 4, 8):
        models = language_id.train_groups(docs, group=group)
        got = sorted(identify(docs, models).collect(), key=lambda r: r.doc_id)
        assert [r._lang for r in got] == [r._lang for r in whole]
        assert all(abs(a._score - b._score) < 1e-4 for a, b in zip(got, whole))


def test_more_languages_than_a_group(docs_of):
    rows = [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26)} " * 20, f"tag{i:03d}", "s") for i in range(300)]
    docs = docs_of(rows)
    got = identify(docs, language_id.train_groups(docs), keep=["doc_id", "lang"]).collect()
    assert len(got) == 300 and sum(r._lang == r.lang for r in got) >= 290
