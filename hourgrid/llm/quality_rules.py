"""Quality rules, line first: clean each line's worth, then judge what the text lost.

Every line is held against three rules. Punctuation: too many of its words end in
runs of marks, or a long line has no stop at all. Navigation: a share of its words
are nothing but separators. Boilerplate: it repeats an earlier line of its text, or
is short and holds a stock phrase. Lines that fail go; a text that loses more than a
share of its word characters that way is rejected, and so is one that fails the
base rules on its length and its repeated word windows.

Whole batches are judged at once: the bytes of some texts are one array, words and
lines are offsets into it, words become numbers by dictionary encoding, and the
patterns run once over the different words. Texts are handled in pieces of bounded
size, a longer text by itself. Every row is judged alone, without an exchange.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hourgrid.llm.textbatch import row_groups, utf8

PIECE_BYTES = 1 << 20
SYMBOLS = b"#*$%&|<>"
# A word of separators only; a word that ends in marks; a word that ends in a stop.
SEPARATOR = r"^[|»›•·>/\\:~–—-]+$"
MARKED = r"[!?#*$%&|<>]{2,}[.,;:]?$|[#*$%&|<>]$"
STOPPED = r"[.,;:!?…。，、！？।،؛؟][)\]\"'”’»]*$"
PHRASES = (
    "all rights reserved",
    "click here",
    "enable javascript",
    "licensed under",
    "lorem ipsum",
    "our newsletter",
    "privacy policy",
    "released under",
    "terms of service",
    "terms of use",
    "uses cookies",
)
STOCK = "(?i)" + "|".join(PHRASES)


@dataclass(frozen=True)
class Rules:
    """Bounds of the rules; shares are in percent."""

    min_words: int = 50
    max_repeat: int = 50
    separators: int = 25
    marks: int = 30
    unstopped_words: int = 10
    phrase_words: int = 30
    max_loss: int = 30


ADDED = T.StructType(
    [
        T.StructField(name, T.LongType(), False)
        for name in (
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "n_punctuation_lines",
            "n_navigation_lines",
            "n_boilerplate_lines",
            "lost_chars",
        )
    ]
    + [
        T.StructField("base_failed", T.BooleanType(), False),
        T.StructField("kept", T.BooleanType(), False),
        T.StructField("clean_text", T.StringType(), False),
    ]
)


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings that lie one after another in data."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(
        len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))
    )


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers that are equal where values are, and the different values by number."""
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def _matches(values: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(values, pattern).to_numpy(zero_copy_only=False)


def _windows_met_twice(codes: np.ndarray, owner: np.ndarray, different: int) -> np.ndarray:
    """For each word, whether a window of three words over it occurs twice in its text."""
    covered = np.zeros(len(codes), bool)
    if len(codes) < 3:
        return covered
    first, _ = _codes(pa.array(owner * different + codes))
    pairs, _ = _codes(pa.array(first[:-1] * different + codes[1:]))
    whole = np.flatnonzero(owner[:-2] == owner[2:])
    windows, _ = _codes(pa.array(pairs[whole] * different + codes[whole + 2]))
    again = whole[np.bincount(windows)[windows] > 1] if len(windows) else whole
    for k in range(3):
        covered[again + k] = True
    return covered


def judge(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray | list]:
    """Columns ADDED for the texts whose bytes lie between offsets."""
    docs = len(offsets) - 1
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([True], blank)) | edge
    after = np.concatenate((blank, [True])) | edge
    starts = np.flatnonzero(~blank & before[:-1])
    ends = np.flatnonzero(~blank & after[1:]) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    codes, words = _codes(_strings(data[~blank], ends - starts))

    # Line k of a text lies between its k-th newlines.
    newlines = np.flatnonzero(data == 10)
    passed = np.searchsorted(newlines, offsets, "left")
    place = np.arange(len(newlines)) + np.searchsorted(offsets, newlines, "right") - 1
    lines = len(newlines) + docs
    line_start, line_end = np.zeros(lines, np.int64), np.zeros(lines, np.int64)
    line_start[passed[:-1] + np.arange(docs)] = offsets[:-1]
    line_start[place + 1] = newlines + 1
    line_end[passed[1:] + np.arange(docs)] = offsets[1:]
    line_end[place] = newlines
    line_owner = np.repeat(np.arange(docs), np.diff(passed) + 1)
    line_of = np.searchsorted(line_start, starts, "right") - 1
    text = _strings(data[data != 10], line_end - line_start)

    def of_lines(values: np.ndarray) -> np.ndarray:
        return np.bincount(line_of, weights=values, minlength=lines).astype(np.int64)

    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = heads[ends] - heads[starts]
    n_words = np.bincount(line_of, minlength=lines)
    line_chars = of_lines(chars)
    separators = of_lines(_matches(words, SEPARATOR)[codes])
    marked = of_lines(_matches(words, MARKED)[codes])
    stopped = of_lines(_matches(words, STOPPED)[codes])
    same, _ = _codes(text)
    _, first = np.unique(line_owner * (same.max(initial=0) + 1) + same, return_index=True)
    repeated = n_words > 0
    repeated[first] = False

    full = n_words > 0
    navigation = full & (separators > 0) & (100 * separators >= rules.separators * n_words)
    punctuation = full & ~navigation & (
        (100 * marked >= rules.marks * n_words)
        | ((n_words >= rules.unstopped_words) & (stopped == 0))
    )
    boilerplate = full & ~navigation & ~punctuation & (
        repeated | ((n_words <= rules.phrase_words) & _matches(text, STOCK))
    )
    failed = navigation | punctuation | boilerplate

    def of_docs(values: np.ndarray, owners: np.ndarray = line_owner) -> np.ndarray:
        return np.bincount(owners, weights=values, minlength=docs).astype(np.int64)

    found = {
        "n_words": of_docs(n_words),
        "word_chars": of_docs(line_chars),
        "n_symbols": of_docs(*_symbols(data, offsets)),
        "n_dup_lines": of_docs(repeated),
        "n_repeat_words": of_docs(_windows_met_twice(codes, owner, len(words)), owner),
        "n_punctuation_lines": of_docs(punctuation),
        "n_navigation_lines": of_docs(navigation),
        "n_boilerplate_lines": of_docs(boilerplate),
        "lost_chars": of_docs(line_chars * failed),
    }
    base_failed = (found["n_words"] < rules.min_words) | (
        100 * found["n_repeat_words"] > rules.max_repeat * found["n_words"]
    )
    found["base_failed"] = base_failed
    found["kept"] = ~base_failed & (
        100 * found["lost_chars"] <= rules.max_loss * found["word_chars"]
    )
    clean = []
    lost = of_docs(failed) > 0
    first_line = passed[:-1] + np.arange(docs)
    for doc in range(docs):
        raw = data[offsets[doc] : offsets[doc + 1]].tobytes()
        if lost[doc]:
            at = range(first_line[doc], first_line[doc] + passed[doc + 1] - passed[doc] + 1)
            raw = b"\n".join(data[line_start[k] : line_end[k]].tobytes() for k in at if not failed[k])
        clean.append(raw)
    found["clean_text"] = clean
    return found


def _symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    at = np.flatnonzero(table[data])
    return np.ones(len(at)), np.searchsorted(offsets, at, "right") - 1


def clean_documents(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    rules: Rules = Rules(),
) -> DataFrame:
    """Rows of docs with columns keep (all if None) and the columns of ADDED.

    clean_text has the lines that passed; lines without a word always pass. lost_chars
    counts the code points of the words of the others. A null text counts as empty:
    it has no words, fails the base rules and has the empty clean text. Long texts are
    judged whole. Rows that repeat are judged each by itself. No rows give no rows;
    columns of docs that have an added name are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED.names]
    schema = T.StructType([docs.schema[c] for c in keep] + ADDED.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("_judged"))
            for low, high in row_groups(offsets, PIECE_BYTES):
                found = judge(
                    data[offsets[low] : offsets[high]],
                    offsets[low : high + 1] - offsets[low],
                    rules,
                )
                text = pa.array(found.pop("clean_text"), pa.binary()).view(pa.string())
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), *(pa.array(x) for x in found.values()), text],
                    names=schema.names,
                )

    return docs.select(*keep, docs[text_col].alias("_judged")).mapInArrow(run, schema)
