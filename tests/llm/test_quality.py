"""Quality: shrinkage against plain formulas, held-out accuracy, edge cases."""

import random

from pyspark.sql import functions as F

from hourgrid.llm.quality import moment_strength, quality


def corpus(seed=4, n=600):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = [rng.choice("river stone garden music letter window".split()) for _ in range(40)]
        if not good:
            words = [w + "%%%" for w in words] if i % 2 else [words[0]] * 40
        docs.append((i, " ".join(words), "en", f"s{i % 7}"))
        labels.append((i, int(good), 0))
    return docs, labels


def frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_edges(spark, docs_of):
    docs, labels = corpus()
    edges = [(900, None, None, None), (901, "", "en", "new"), (None, "river stone", "xx", "s1")]
    out = quality(docs_of(docs + edges), frame(spark, labels), F.col("source"), F.col("lang")).collect()
    assert len(out) == len(docs) + 3 and all(0 < r.score < 1 for r in out)
    truth = {i: g for i, g, _ in labels}
    right = [r.kept == bool(truth[r.doc_id]) for r in out if r.doc_id in truth]
    assert sum(right) / len(right) > 0.98


def test_sparse_sites_are_drawn_to_the_prior(spark, docs_of):
    docs, labels = corpus()
    docs += [(1000 + i, "river stone garden", "en", "tiny") for i in range(2)]
    labels += [(1000 + i, 0, 0) for i in range(2)]
    out = quality(docs_of(docs), frame(spark, labels), F.col("source"), F.col("lang"))
    site = {r.host: r.site_posterior for r in out.collect()}
    others = [site[f"s{k}"] for k in range(7)]
    assert 0.3 < site["tiny"] < sum(others) / 7 and max(others) < 1


def test_moment_strength_equals_the_plain_formula(spark):
    groups = [(9, 10), (2, 10), (5, 10), (10, 12)]
    prior = 0.6
    got = moment_strength(spark.createDataFrame(groups, "good long, n long"), F.lit(prior))
    total = sum(n for _, n in groups)
    between = sum(n * (g / n - prior) ** 2 for g, n in groups)
    noise = prior * (1 - prior)
    variance = (between - len(groups) * noise) / (total - len(groups))
    assert abs(got - max(noise / variance - 1, 1.0)) < 1e-9
    same = spark.createDataFrame([(6, 10)] * 3, "good long, n long")
    assert moment_strength(same, F.lit(prior)) == 1e6


def test_without_labels_rows_or_free_names(spark, docs_of):
    docs = docs_of([(1, "a b"), (1, "a b"), (2, None)])
    none = frame(spark, [])
    assert {(r.score, r.kept) for r in quality(docs, none, F.col("source"), F.col("lang")).collect()} == {(0.5, True)}
    clash = docs.withColumnsRenamed({"lang": "bins", "n_chars": "evidence"})
    assert quality(clash, none, F.col("source"), F.col("bins")).count() == 3
    assert quality(docs.limit(0), none, F.col("source"), F.col("lang")).collect() == []
