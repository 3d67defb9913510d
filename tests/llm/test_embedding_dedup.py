"""Embedding near-dedup against all pairs."""

import numpy as np
import pytest
from pyspark.sql import types as T

from hourgrid.llm.embedding_dedup import BLOCKS, CELL_MEAN, ProductCode, code_size, near_vectors

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
)


def clouds(seed, dim, centres=12, each=14):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(centres):
        centre = rng.standard_normal(dim)
        for _ in range(each):
            vector = centre + rng.standard_normal(dim) * rng.choice([0.0, 0.2, 0.33])
            rows.append((len(rows), [float(x) for x in vector * rng.uniform(0.5, 4)], int(c % 3)))
    return rows


def expected(rows, cosine=0.93):
    unit, ok = [], []
    for _, vector, label in rows:
        good = bool(vector) and label is not None and None not in vector
        v = np.array(vector if good else [0.0], np.float32).astype(float)
        good = good and np.isfinite(v).all() and v.any()
        ok.append(good)
        unit.append(v / np.linalg.norm(v) if good else v)
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            if a != b and ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]):
                linked[a, b] = unit[a] @ unit[b] >= cosine
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(linked)):
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    least = {}
    for k in range(n):
        least[root[k]] = min(rows[k][0], least.get(root[k], rows[k][0]))
    return {
        (rows[k][0], int(linked[k].sum()), least[root[k]], rows[k][0] == least[root[k]])
        for k in range(n)
    }


def found(df):
    return {(r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("seed,dim,cell", [(1, 64, 1024), (2, 16, 1024), (3, 64, 5), (4, 8, 1024)])
def test_clouds(spark, seed, dim, cell):
    """Cells of 5 rows are cut into blocks; recall is that of the filters, nothing is added."""
    rows = clouds(seed, dim)
    got, want = found(near_vectors(spark.createDataFrame(rows, SCHEMA), cell_rows=cell)), expected(rows)
    links = {i: n for i, n, *_ in want}
    assert all(n <= links[i] for i, n, *_ in got)
    assert sum(n for _, n, *_ in got) >= 0.99 * sum(links.values())
    assert len(got & want) >= 0.95 * len(want)


def test_copies_and_vectors_that_cannot_link(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (10, v, 1), (11, v, 1), (12, [2 * x for x in v], 1), (13, v, 2), (14, v, None), (15, None, 1),
        (16, [], 1), (17, [0.0] * 4, 1), (18, [1.0, None, 2.0, 3.0], 1), (19, [float("nan"), *v[1:]], 1),
        (20, [float("inf"), *v[1:]], 1), (21, v[:3], 1), (9, v, 1), (22, [-x for x in v], 1),
    ]
    assert found(near_vectors(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_repeated_null_ids_and_empty_table(spark):
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS filters")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in near_vectors(frame).collect()), key=repr)
    assert got == [(5, 2, 5), (5, 2, 5), (None, 0, None), (None, 2, 5)]
    assert near_vectors(frame.limit(0)).collect() == []


def test_code_grows_with_the_vectors():
    assert code_size(0) == code_size(2**20) == (1024, 32)
    for n in (2**21, 10**7, 10**9, 10**11):
        codes, length = code_size(n)
        assert n * length <= CELL_MEAN * codes**BLOCKS
        assert length < 12 * np.log2(n)


@pytest.mark.parametrize("vectors", [0, 10**7, 10**8])
def test_recall_of_codes_for_many_vectors(vectors):
    """Pairs at exactly the cosine, which are the hardest: at least 0.97 share a direction."""
    rng, dim, n = np.random.default_rng(9), 64, 200
    codes, length = code_size(vectors)
    code = ProductCode(dim, codes=codes, length=length)
    a = rng.standard_normal((n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((n, dim))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    met = 0
    for k in range(0, n, 25):
        (rows_a, in_a), (rows_b, in_b) = code.decode(a[k : k + 25]), code.decode(b[k : k + 25])
        met += sum(bool(set(in_a[rows_a == r]) & set(in_b[rows_b == r])) for r in range(25))
    assert met >= 0.97 * n


def test_clouds_with_the_code_of_many_vectors(spark):
    rows = clouds(7, 64, centres=6)
    frame = spark.createDataFrame(rows, SCHEMA)
    got, want = found(near_vectors(frame, expected=10**7)), expected(rows)
    links = {i: n for i, n, *_ in want}
    assert all(n <= links[i] for i, n, *_ in got)
    assert sum(n for _, n, *_ in got) >= 0.99 * sum(links.values())
