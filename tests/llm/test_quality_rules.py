"""Line rules against a plain reading of each line."""

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa

from hourgrid.llm import quality_rules
from hourgrid.llm.quality_rules import ADDED, MARKED, SEPARATOR, STOCK, STOPPED, Rules, clean_documents
from hourgrid.llm.registry import QUERIES
from hourgrid.llm.textbatch import utf8

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RULES = Rules(min_words=5, unstopped_words=4, phrase_words=6)


def expected(text, rules):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, found, clean = set(), Counter(), []
    for line in text.split("\n"):
        mine = WORD.findall(line)
        n = len(mine)
        if not n:
            clean.append(line)
            continue
        again = line in seen
        seen.add(line)
        found["dup"] += again
        separators, marked, stopped = (
            sum(bool(re.search(p, w)) for w in mine) for p in (SEPARATOR, MARKED, STOPPED)
        )
        if separators and 100 * separators >= rules.separators * n:
            found["navigation"] += 1
        elif 100 * marked >= rules.marks * n or (n >= rules.unstopped_words and not stopped):
            found["punctuation"] += 1
        elif again or (n <= rules.phrase_words and re.search(STOCK, line)):
            found["boilerplate"] += 1
        else:
            clean.append(line)
            continue
        found["lost"] += sum(map(len, mine))
    chars = sum(map(len, words))
    failed = len(words) < rules.min_words or 100 * len(covered) > rules.max_repeat * len(words)
    return (
        len(words),
        chars,
        sum(c in "#*$%&|<>" for c in text),
        found["dup"],
        len(covered),
        found["punctuation"],
        found["navigation"],
        found["boilerplate"],
        found["lost"],
        failed,
        not failed and 100 * found["lost"] <= rules.max_loss * chars,
        "\n".join(clean),
    )


TEXTS = [
    None,
    "",
    "\n\n",
    "one",
    "a a a a a a",
    "home | news | about",
    "A line that ends well.\nA line that ends well.\nanother line without any stop",
    "WOW!! SUCH!! NEWS!! HERE!! NOW!!\nPlain words follow here, as they do.",
    "x\x0by\x0cz\rw\tv\n \n",
    "This work is licensed under the terms.\nIt is a work of five words, at least.",
    "été 🙂 漢字。 naïve | # $ % & * < >",
    "tail without newline but, with stop.\n\n\n",
]


@pytest.mark.parametrize("piece", [1, 60, 1 << 20])
def test_rows_of_every_kind(spark, docs_of, monkeypatch, piece):
    monkeypatch.setattr(quality_rules, "PIECE_BYTES", piece)
    rows = [(i, t) for i, t in enumerate(TEXTS + TEXTS)] + [(None, TEXTS[6]), (3, "one")]
    data, offsets = utf8(pa.array([t for _, t in rows]))
    got = []
    for low, high in quality_rules.row_groups(offsets, piece):
        found = quality_rules.judge(
            data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], RULES
        )
        columns = [found[name] for name in ADDED.names]
        got += [(*(x.item() for x in r[:-1]), r[-1].decode()) for r in zip(*columns)]
    assert got == [expected(t, RULES) for _, t in rows]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b.", "|", "!!", "\n", " ", "é", "c,"]), max_size=25), max_size=6))
def test_any_texts(parts):
    texts = [" ".join(p) for p in parts]
    data, offsets = utf8(pa.array(texts, pa.string()))
    found = quality_rules.judge(data, offsets, RULES)
    for i, text in enumerate(texts):
        mine = [found[name][i] for name in ADDED.names]
        assert [*mine[:-1], mine[-1].decode()] == list(expected(text, RULES))


def test_frames_long_texts_and_clashing_names(docs_of):
    long = "Some words, again and again. " * 20_000
    rows = [(1, long + "\n" + "menu | " * 9), (2, None), (2, "x"), (None, TEXTS[6])]
    docs = docs_of(rows).withColumnsRenamed({"lang": "kept", "source": "line"})
    out = clean_documents(docs, rules=RULES)
    assert out.columns == ["doc_id", "text", "line", "n_chars", *ADDED.names]
    got = sorted((tuple(r[c] for c in ("doc_id", *ADDED.names)) for r in out.collect()), key=repr)
    assert got == sorted(((i, *expected(t, RULES)) for i, t in rows), key=repr)
    assert clean_documents(docs.limit(0)).collect() == []


def test_bad_documents_go_and_good_ones_stay(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op11_quality_rules"](spark, folder).join(labels, "doc_id")
    found = {(r.quality, r.base_failed, r.kept): r["count"] for r in
             rows.groupBy("quality", "base_failed", "kept").count().collect()}
    assert not any(n for (quality, _, kept), n in found.items() if quality == 0 and kept)
    good = found.get((1, False, True), 0)
    assert good >= 0.99 * (good + found.get((1, False, False), 0))


def test_windows_of_one_text_do_not_meet_those_of_another():
    codes = np.array([0, 1, 2, 0, 1, 2, 0, 1, 2])
    owner = np.array([0, 0, 0, 1, 1, 1, 1, 1, 1])
    met = quality_rules._windows_met_twice(codes, owner, 3)
    assert met.tolist() == [False] * 3 + [True] * 6
