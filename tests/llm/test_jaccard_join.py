"""Jaccard join and components against all pairs."""

import random
import re

import pytest

from hourgrid.llm import jaccard_join
from hourgrid.llm.components import components
from hourgrid.llm.jaccard_join import near_documents

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def sets_of(rows, width=5):
    out = []
    for doc_id, text in rows:
        words = [w.lower() for w in WORD.findall((text or "").encode())]
        grams = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
        out.append((doc_id, grams or ({tuple(words)} if words else set())))
    return out


def expected(rows, percent=75):
    sets = sets_of(rows)
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            shared = len(sets[a][1] & sets[b][1])
            if shared and 100 * shared >= percent * len(sets[a][1] | sets[b][1]):
                root[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return sorted(
        ((i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)), key=repr
    )


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def near_copies(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, doc_id = [], 0
    passage = rng.choices(words, k=30)
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(5, 80))
        if rng.random() < 0.5:
            base = base + passage
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((doc_id, rng.choice([" ", "\n", "\t "]).join(copy)))
            doc_id += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_copies(docs_of, seed):
    rows = near_copies(seed)
    assert found(near_documents(docs_of(rows))) == expected(rows)


def test_lists_dealt_as_hot_find_the_same(docs_of, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_LEAST", 3)
    rows = near_copies(4)
    assert found(near_documents(docs_of(rows))) == expected(rows)


@pytest.mark.parametrize("seed", range(4))
def test_exact_copies_in_several_tasks_keep_their_links(docs_of, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(12):
        base = [f"w{k}x{j}" for j in range(40)]
        near = [*base[:-1], rng.choice(["end", "stop", "last"])]
        rows += [(100 * j + k, " ".join(base)) for j in range(4)] + [(900 + k, " ".join(near))]
    rng.shuffle(rows)
    docs = docs_of(rows).repartition(8, "doc_id")
    assert found(near_documents(docs)) == expected(rows)


def test_edges(docs_of, monkeypatch):
    long_text = " ".join(f"v{k % 977}x{k}" for k in range(4000))
    rows = [
        (5, None), (6, ""), (7, " \n\t"), (8, "One two"), (9, "one  TWO"), (10, "one"), (11, "É b c d e"),
        (12, "é b c d e"), (13, "a b c d e f"), (14, "a b c d e f"), (None, "a b c d e f"), (15, "a b c d e"),
        (None, "lonely words here"), (16, long_text), (17, long_text + " more"), (18, "q" * 5000),
        (19, "Q" * 5000), (20, "x y z " * 400),
    ]
    want = expected(rows)
    assert found(near_documents(docs_of(rows))) == want
    # Small pieces: texts and single words longer than a piece are hashed in parts.
    monkeypatch.setattr(jaccard_join, "PIECE_BYTES", 1 << 10)
    for text in (r[1] for r in rows if r[1]):
        import pyarrow as pa

        small = [len(s) for _, s in jaccard_join.gram_sets(pa.array([text]), 5)]
        assert small == [len(sets_of([(0, text)])[0][1])]


def test_repeated_rows_extra_columns_and_empty_table(docs_of):
    docs = docs_of([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "h i j k l")])
    docs = docs.withColumnsRenamed({"lang": "node", "source": "gram", "n_chars": "component_id"})
    assert found(near_documents(docs)) == [(1, 3, 1), (1, 3, 1), (2, 1, 2)]
    assert near_documents(docs.limit(0)).collect() == []


def test_a_common_list_forms_no_pairs_of_joined_members(docs_of):
    base = [f"k{k}" for k in range(60)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(60)]
    assert found(near_documents(docs_of(rows))) == expected(rows)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    edges += [(100 + k, 101 + k) for k in range(20)] + [(200, 200)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.root) for r in got) == sorted(root.items())
