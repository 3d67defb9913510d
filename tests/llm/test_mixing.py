"""Mixing: budgets by an independent water filling, prefixes by sorting each leaf."""

import hashlib
import math
from collections import defaultdict

import pytest

from hourgrid.llm.mixing import Mix, leaf_budgets, mix_documents

LEAVES = [
    ("a", "en", "s1", 100), ("a", "en", "s2", 1000), ("a", "de", "s1", 50), ("b", "en", "s3", 5000),
    ("b", None, "s4", 20), ("c", "fr", "s5", 0),
]


def fill(total, children):
    """children: name -> (weight, cap). Fill step by step until nobody is over the cap."""
    given, open_, left = {}, dict(children), total
    while open_:
        weights = sum(w for w, _ in open_.values())
        full = {k: c for k, (w, c) in open_.items() if weights and left * w / weights >= c}
        if not full:
            given |= {k: left * w / weights if weights else 0.0 for k, (w, _) in open_.items()}
            break
        for k, cap in full.items():
            given[k] = cap
            left -= cap
            del open_[k]
    return given


def expected_budgets(leaves, mix):
    weight = lambda path: mix.weights.get(path, mix.default_weight)
    caps = defaultdict(float)
    for *names, tokens in leaves:
        for depth in range(4):
            caps[tuple(names[:depth])] += tokens * mix.max_epochs
    wanted = mix.budget_tokens
    if wanted is None:
        wanted = math.floor(sum(x[3] for x in leaves) * mix.budget_share)
    given = {(): min(wanted, caps[()])}
    for depth in range(3):
        for parent in [p for p in caps if len(p) == depth]:
            children = {p: (weight(p), caps[p]) for p in caps if len(p) == depth + 1 and p[:depth] == parent}
            given |= fill(given[parent], children)
    return {p: math.floor(g + 1e-9) for p, g in given.items() if len(p) == 3}


@pytest.mark.parametrize("budget", [0, 100, 700, 3000, 10**6])
def test_shortages_go_to_siblings_before_ancestors(spark, budget):
    mix = Mix(budget, max_epochs=2, weights={("a",): 3, ("a", "en"): 2, ("b", "en", "s3"): 7})
    frame = spark.createDataFrame(LEAVES, "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang, r.source): r.budget for r in leaf_budgets(frame, mix).collect()}
    want = expected_budgets(LEAVES, mix)
    assert all(abs(got[k] - want[k]) <= 1 for k in want) and set(got) == set(want)


def documents(spark):
    rows = [
        (i, *LEAVES[i % 5][:3], 1 + i * 7 % 23, "kept") for i in range(400)
    ] + [(None, "a", "en", "s1", 5, "kept"), (500, "c", "fr", "s5", 0, "kept")]
    return rows, spark.createDataFrame(
        rows, "doc_id long, domain string, lang string, source string, tokens long, budget_x string"
    )


def test_epochs_and_prefixes(spark):
    rows, docs = documents(spark)
    mix = Mix(6000, max_epochs=3, seed=5, weights={("a",): 2, ("b", None): 4})
    out = mix_documents(docs, mix).collect()
    leaves = defaultdict(list)
    for doc_id, *names, tokens, _ in rows:
        leaves[tuple(names)].append((doc_id, tokens))
    got = defaultdict(list)
    for r in out:
        got[r.domain, r.lang, r.source].append((r.epoch, r.doc_id, r.tokens_taken))
        assert r.budget_x == "kept"
    budgets = {(r.domain, r.lang, r.source): r.budget for r in out}
    assert sum(budgets.values()) >= 6000 - len(budgets)
    for leaf, budget in budgets.items():
        whole, rest = divmod(budget, sum(t for _, t in leaves[leaf]))
        want = [(e, i, t) for e in range(whole) for i, t in leaves[leaf]]

        def place(item):
            name = "" if item[0] is None else str(item[0])
            return hashlib.md5(f"5:{whole}:{name}".encode()).hexdigest()

        for doc_id, tokens in sorted(leaves[leaf], key=place):
            if rest <= 0:
                break
            want.append((whole, doc_id, min(tokens, rest)))
            rest -= tokens
        assert sorted(got[leaf], key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    _, docs = documents(spark)
    assert mix_documents(docs.limit(0), Mix()).collect() == []


def test_clashing_names_and_repeated_rows(spark):
    rows, docs = documents(spark)
    mix = Mix(6000, max_epochs=3, seed=5, weights={("a",): 2})
    want = mix_documents(docs, mix).drop("budget_x").collect()
    names = ["epoch", "budget", "tokens_taken", "_whole", "_rest", "_range", "_domain", "__cut", "_rdomain"]
    clash = docs.drop("budget_x").selectExpr("*", *(f"'mine' AS {name}" for name in names))
    out = mix_documents(clash, mix)
    assert all(r["_whole"] == r["__cut"] == r["_domain"] == "mine" for r in out.collect())
    assert sorted(out.select(want[0].__fields__).collect(), key=repr) == sorted(want, key=repr)
    # Each row three times: three times the budget takes each row as often, but in the cut.
    thrice = docs.union(docs).union(docs)
    more = mix_documents(thrice, Mix(18000, max_epochs=3, seed=5, weights={("a",): 2})).collect()
    budgets = {(r.domain, r.lang, r.source): r.budget for r in more}
    taken = defaultdict(int)
    for r in more:
        taken[r.domain, r.lang, r.source] += r.tokens_taken
        assert 0 < r.tokens_taken <= r.tokens or r.tokens == 0
    assert taken == budgets
