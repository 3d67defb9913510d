"""Toxicity: log-ratios against a plain Kneser-Ney, held-out accuracy, edge cases."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from hourgrid.llm.common import held_out
from hourgrid.llm.toxicity import (
    DISCOUNT,
    ORDER,
    Cache,
    fit_curve,
    gram_counts,
    log_ratios,
    toxicity,
    train,
)

TEXTS = [("a nice day", 0), ("you awful clod", 1), ("nice awful", 0), ("clod clod", 1), ("", 0), ("day", 0)]


def squeezed(text):
    out = " "
    for char in text:
        char = char.lower() if char.isalpha() else " "
        if char != " " or out[-1] != " ":
            out += char
    return out


def plain_ratios(texts):
    counts = {1: Counter(), 0: Counter()}
    for text, toxic in texts:
        padded = " " * (ORDER - 1) + squeezed(text)
        for k in range(len(padded) - ORDER + 1):
            counts[toxic][padded[k : k + ORDER]] += 1
    kinds = {ORDER: set(counts[0]) | set(counts[1])}
    lefts = {}
    for n in range(ORDER - 1, 0, -1):
        lefts[n] = Counter(g[1:] for g in kinds[n + 1])
        kinds[n] = set(lefts[n])

    def shared(gram):
        n = len(gram)
        followers = [g for g in lefts[n] if g[:-1] == gram[:-1]]
        total = sum(lefts[n][g] for g in followers)
        lower = 1 / len(followers) if n == 1 else shared(gram[1:])
        return (max(lefts[n][gram] - DISCOUNT, 0) + DISCOUNT * len(followers) * lower) / total

    def p(kind, gram):
        followers = {g: c for g, c in counts[kind].items() if g[:-1] == gram[:-1]}
        total = sum(followers.values())
        if not total:
            return shared(gram[1:])
        saved = DISCOUNT * len(followers) / total
        return max(counts[kind][gram] - DISCOUNT, 0) / total + saved * shared(gram[1:])

    return {g: math.log(p(1, g)) - math.log(p(0, g)) for g in kinds[ORDER]}


def test_ratios_equal_plain_kneser_ney(spark):
    frame = spark.createDataFrame(TEXTS, "text string, toxic int")
    grams = gram_counts(frame)
    of_grams, _ = log_ratios(grams.cache())
    got = {r.gram: r.ratio for r in of_grams.collect()}
    want = plain_ratios(TEXTS)
    assert set(got) == set(want)
    assert all(abs(got[g] - want[g]) < 1e-9 for g in want)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    clean = "house river stone garden music letter window paper morning".split()
    rude = "awfulclod stinkfish rotbrain".split()
    docs, labels = [], []
    for i in range(800):
        words = rng.choices(clean, k=rng.randint(5, 60))
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randint(1, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_accuracy_and_edges(spark, docs_of, corpus):
    docs, labels = corpus
    edges = [(900, None), (901, ""), (None, "river awfulclod"), (902, "river " * 60_000 + "awfulclod")]
    frame = spark.createDataFrame(labels + [(900, 1, None), (901, 1, 7)], "doc_id long, quality int, toxic int")
    out = toxicity(docs_of(docs + edges), frame).collect()
    assert len(out) == len(docs) + 4
    score = {r.doc_id: r.score for r in out}
    assert all(0 <= s <= 1 for s in score.values())
    right = [(score[i] >= 0.3) == bool(t) for i, _, t in labels]
    assert sum(right) / len(right) > 0.97
    assert score[900] == score[901] < 0.3 <= score[None]


def test_without_labels_or_rows(spark, docs_of, corpus):
    docs = docs_of(corpus[0][:5])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.score == 0 for r in toxicity(docs, none).collect())
    one = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r.score < 1e-6 for r in toxicity(docs, one).collect())
    assert toxicity(docs.limit(0), none).collect() == []


def test_contexts_have_their_own_ratio(spark):
    _, contexts = log_ratios(gram_counts(spark.createDataFrame(TEXTS, "text string, toxic int")))
    totals = defaultdict(int)
    for r in contexts.collect():
        totals[r.gram] += r.n
    assert sum(totals.values()) == sum(len(squeezed(t)) for t, _ in TEXTS)


def test_ngrams_beyond_the_cache_keep_their_ratios(spark, docs_of, corpus, monkeypatch):
    docs, labels = corpus
    edges = [(900, None), (901, ""), (None, "river awfulclod"), (902, "river awfulclod " * 30_000), (900, "zzyx qqvw")]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")

    def scored():
        rows = toxicity(docs_of(docs + edges), frame).collect()
        return sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in rows)

    whole = scored()
    for grams, contexts in ((0, 0), (200, 100), (200, 1 << 20), (1 << 22, 50)):
        monkeypatch.setattr("hourgrid.llm.toxicity.CACHED_GRAMS", grams)
        monkeypatch.setattr("hourgrid.llm.toxicity.CACHED_CONTEXTS", contexts)
        found = scored()
        assert [r[:2] for r in found] == [r[:2] for r in whole]
        assert all(abs(a[2] - b[2]) < 1e-6 for a, b in zip(found, whole))


def test_cache_finds_every_key():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    keys[:50] = np.arange(50)
    cache = Cache.of(keys[:4000], np.arange(4000, dtype=np.float32))
    assert (cache.values[cache.places(keys[:4000])] == np.arange(4000)).all()
    assert (cache.places(keys[4000:]) == -1).all()
    assert (Cache.of(keys[:0], np.zeros(0)).places(keys) == -1).all()


def test_all_texts_are_counted_or_fitted_and_copies_are_one_row(spark, docs_of, corpus, monkeypatch):
    docs, labels = corpus
    copies = [(1000 + i, docs[1][1]) for i in range(300)]
    frame = spark.createDataFrame(
        labels + [(i, 1, labels[1][2]) for i, _ in copies], "doc_id long, quality int, toxic int"
    )
    counted, fitted = [], []

    def counts(rows):
        counted.extend(r.text for r in rows.collect())
        return gram_counts(rows)

    def fit(features, toxic, times):
        fitted.append((len(features), times.sum()))
        return fit_curve(features, toxic, times)

    monkeypatch.setattr("hourgrid.llm.toxicity.gram_counts", counts)
    monkeypatch.setattr("hourgrid.llm.toxicity.fit_curve", fit)
    learned = docs_of(docs + copies).where(~held_out("doc_id"))
    texts = [r.text for r in learned.collect()]
    for fit_docs in (100, 1 << 20):
        counted.clear(), fitted.clear()
        train(docs_of(docs + copies), frame.select("doc_id", "toxic"), fit_docs)
        [(rows, times)] = fitted
        assert len(counted) + times == len(texts)
        assert len(set(counted)) + rows == len(set(texts))


def test_weights_are_repeated_rows():
    rng = np.random.default_rng(5)
    features, toxic = rng.normal(size=(40, 2)), rng.integers(0, 2, 40).astype(float)
    times = rng.integers(1, 5, 40)
    once = fit_curve(features, toxic, times.astype(float))
    many = fit_curve(features.repeat(times, 0), toxic.repeat(times), np.ones(times.sum()))
    assert all(np.allclose(a, b) for a, b in zip(once, many))
