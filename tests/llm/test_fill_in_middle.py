"""Fill-in-the-middle against slices of Python strings."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourgrid.errors import ContractError
from hourgrid.llm import fill_in_middle as module
from hourgrid.llm.fill_in_middle import ADDED, Sentinels, fill_in_middle


def expected(doc_id, text, units=lambda t: list(t)):
    text = text or ""
    parts = units(text)
    n = len(parts)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle = "".join(parts[:a]), "".join(parts[a:b])
    suffix = text[len(prefix) + len(middle) :]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text, text
    if h[3] % 100 < 20:
        out = f"<S>{suffix}<P>{prefix}<M>{middle}"
        return n, "spm", len(prefix), len(middle), out, text
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", *ADDED)) for r in df.collect()), key=repr)


TEXTS = [
    None, "", "a", "\n\n", "<P>x", "a<S>b", "a<", "<S", "S>", "$1\\2${x}", "🙂é\x00\r x" * 5,
    "x" * 4095, "y" * 4096, "z🙂" * 2048, "<M", "ab\n" * 200_000,
]


def test_texts_of_every_kind(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS * 4)] + [(None, "abc"), (None, "abc"), (5, TEXTS[5])]
    got = found(fill_in_middle(docs_of(rows)))
    assert got == sorted(((i, *expected(i, t)) for i, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab<>PSM$\\\n🙂", max_size=30), min_size=1, max_size=40))
def test_any_texts(docs_of, texts):
    rows = list(enumerate(texts))
    assert found(fill_in_middle(docs_of(rows))) == sorted(
        ((i, *expected(i, t)) for i, t in rows), key=repr
    )


def test_words_as_units(docs_of, monkeypatch):
    monkeypatch.setattr(module, "BLOCKS", (8, 2))
    rows = [(i, " one two  three\nfour " * (i % 9) + " \n") for i in range(60)]
    got = found(fill_in_middle(docs_of(rows), unit=r"\s*+\S++"))
    words = lambda t: re.findall(r"\s*\S+", t)
    assert got == sorted(((i, *expected(i, t, words)) for i, t in rows), key=repr)


def test_clashing_names_and_empty_table(docs_of):
    docs = docs_of([(1, "abc"), (2, None)]).withColumnsRenamed({"lang": "form", "source": "row"})
    docs = docs.withColumn("made", F.lit(1))
    out = fill_in_middle(docs)
    assert out.columns == ["doc_id", "text", "row", "n_chars", "made", *ADDED]
    assert {r.row for r in out.collect()} == {"src1"}
    assert fill_in_middle(docs.limit(0)).collect() == []


def test_sentinels_must_not_overlap():
    Sentinels("<|p|>", "<|s|>", "<|m|>")
    for bad in (("aba", "c", "d"), ("ab", "bc", "d"), ("x", "x", "y"), ("", "a", "b")):
        with pytest.raises(ContractError):
            Sentinels(*bad)


def test_other_sentinels(docs_of):
    marks = Sentinels("[$p.]", "[\\s+]", "(m)")
    rows = fill_in_middle(docs_of([(i, f"text {i} of <P> some length") for i in range(50)]), marks=marks)
    got = rows.collect()
    assert all(r.restored == r.text for r in got)
    assert any(r.output.startswith("[$p.]") for r in got) and any(r.output.startswith("[\\s+]") for r in got)


def test_no_python_and_no_exchange(docs_of):
    plan = fill_in_middle(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Exchange"))
