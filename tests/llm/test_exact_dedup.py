"""Exact dedup against grouping by text."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hourgrid.llm.exact_dedup import exact_classes


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        same = groups[text or ""]
        keep = max((i for i in same if i is not None), default=None)
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, keep, len(same), doc_id == keep, sha))
    return sorted(out, key=repr)


def found(df):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_nulls_prefixes_long_texts_and_repeated_rows(docs_of):
    rows = [
        (1, None), (2, ""), (3, "a"), (4, "ab"), (5, "a"), (None, "a"), (7, "x" * 64),
        (8, "x" * 64), (9, "x" * 65), (10, "x" * 5000), (11, "x" * 5000), (12, "x" * 4999 + "y"),
        (13, "é" * 40), (14, "é" * 40), (None, "only"), (None, "only"), (15, "r"), (15, "r"),
        (16, "z" * 300_000), (17, "z" * 300_000), (18, "z" * 300_000 + "!"),
    ]
    assert found(exact_classes(docs_of(rows))) == expected(rows)


def test_empty_table_and_clashing_columns(docs_of):
    docs = docs_of([(1, "a")]).withColumnsRenamed({"lang": "node", "source": "keep_id"})
    assert found(exact_classes(docs)) == expected([(1, "a")])
    assert exact_classes(docs.limit(0)).collect() == []


def test_short_digits_give_the_same_classes(docs_of):
    rows = [(i, "abc" * (i % 4) + "d" * (i % 3)) for i in range(40)]
    assert found(exact_classes(docs_of(rows), first_digit=1, growth=2)) == expected(rows)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.text("ab\n", max_size=6)), max_size=12))
def test_random_texts(docs_of, rows):
    assert found(exact_classes(docs_of(rows), first_digit=2, growth=2)) == expected(rows)
