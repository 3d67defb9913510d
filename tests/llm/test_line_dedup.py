"""Line dedup against a dictionary of lines."""

from collections import defaultdict

import pytest

from hourgrid.llm.line_dedup import drop_repeated_lines

LONG = "This line is long enough to count as boiler"  # 43 characters


def expected(rows, min_points=40, min_docs=5):
    blanks = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    name = lambda i: -(2**63) if i is None else i
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[line.strip(blanks).translate(lower)].add(name(doc_id))
    out = []
    for doc_id, text in rows:
        kept = []
        lines = (text or "").split("\n")
        for line in lines:
            key = line.strip(blanks).translate(lower)
            repeated = len(key) >= min_points and len(holders[key]) >= min_docs
            if not repeated or name(doc_id) == max(holders[key]):
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        ((r.doc_id, r._n_lines, r._n_dropped, r._kept_text) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("batches,fan_out", [(1, 2), (4, 2), (7, 3)])
def test_lines_of_every_kind(docs_of, batches, fan_out):
    rows = [(i, f"own {i}\n  {LONG}\t\nend") for i in range(1, 8)]
    rows += [(20 + i, f"{LONG.upper()} é\n\n{i}") for i in range(5)]
    rows += [(30 + i, "short\nshort") for i in range(9)]
    rows += [(40, None), (41, ""), (42, "\n"), (43, f"{LONG} four\n{LONG} four"), (None, LONG)]
    rows += [(50 + i, f"{LONG} four") for i in range(3)]
    rows += [(60, "\n".join([LONG] * 3)), (61, "x" * 200_000 + "\n" + LONG), (7, LONG)]
    got = found(drop_repeated_lines(docs_of(rows), batches=batches, fan_out=fan_out))
    assert got == expected(rows)


def test_a_document_may_lose_all_lines(docs_of):
    rows = [(i, LONG) for i in range(6)]
    assert found(drop_repeated_lines(docs_of(rows))) == expected(rows)


def test_empty_table_and_other_columns_stay(docs_of):
    docs = docs_of([(i, LONG) for i in range(5)]).withColumnsRenamed({"lang": "h1", "source": "line"})
    out = drop_repeated_lines(docs)
    assert out.columns[:5] == docs.columns and {r.h1 for r in out.collect()} == {"en"}
    assert drop_repeated_lines(docs.limit(0)).collect() == []


def test_main_path_is_native(docs_of):
    plan = drop_repeated_lines(docs_of([(1, LONG)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
