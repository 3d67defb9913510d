"""Fill-in-the-middle transformation by a regex with counted quantifiers.

`regexp_count` gives the n units of a text. Two cuts a <= b are drawn from a hash of
the row's id, and one pattern per row, `(unit{a}+)(unit{b-a}+)(rest)` with possessive
quantifiers, captures prefix, middle and suffix in a single match that cannot
backtrack. The replacement string of that row puts the groups into their order, so
the cut and the rearrangement are one `regexp_replace`. Another pattern takes the
output apart again. Nothing but built-in expressions runs, row by row, without an
exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.errors import ContractError
from hourgrid.llm.common import text_or_empty

CODE_POINT = r"(?s:.)"
# Units are counted in blocks of so many, so a long text never becomes an array of its units.
BLOCKS = (4096, 64)
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output", "restored")


@dataclass(frozen=True)
class Sentinels:
    """Marks put before prefix, suffix and middle; texts that hold one stay plain."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        # A mark that overlaps itself or another could be found one place too early.
        clash = any(
            x[-k:] == y[:k]
            for x in marks
            for y in marks
            for k in range(1, min(len(x), len(y)) + 1)
            if not (x is y and k == len(x))
        )
        if clash or len(set(marks)) < 3 or not all(marks):
            raise ContractError("sentinels must differ and must not overlap")


def _quoted(text: str) -> str:
    """The text as a literal of a pattern."""
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)


def _verbatim(text: str) -> str:
    """The text as a literal of a replacement."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def _replace(text: Column, pattern: Column, by: Column) -> Column:
    return F.call_function("regexp_replace", text, pattern, by)


def unit_count(text: Column, unit: str = CODE_POINT) -> Column:
    """How many units a text has, matched left to right."""
    n = F.lit(0).cast("long")
    for size in BLOCKS:
        block = rf"(?:{unit}){{{size}}}+"
        n = n + F.regexp_count(text, F.lit(block)).cast("long") * size
        text = F.regexp_replace(text, block, "")
    return n + F.regexp_count(text, F.lit(unit)).cast("long")


def draws(id_column: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and id; a null id is empty."""
    name = F.coalesce(id_column.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def restore(output: Column, form: Column, marks: Sentinels = Sentinels()) -> Column:
    """The text that an output of this form was made from."""
    p, s, m = (_quoted(x) for x in (marks.prefix, marks.suffix, marks.middle))
    psm = rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"
    spm = rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"
    return (
        F.when(form == "psm", F.regexp_replace(output, psm, "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, spm, "$2$3$1"))
        .otherwise(output)
    )


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = CODE_POINT,
    plain_percent: int = 10,
    spm_percent: int = 20,
    marks: Sentinels = Sentinels(),
    seed: int = 1,
) -> DataFrame:
    """Rows of docs with n, form, prefix_chars, middle_chars, output and restored added.

    unit is a pattern that is never empty and never backtracks, such as one code point
    or a possessive word. n counts the units of the whole text; the cuts lie between
    units, and what follows the last unit goes with the suffix. form is plain, psm or
    spm; a plain text is its own output and has no lengths. prefix_chars and
    middle_chars are code points.
    A null text counts as empty and is plain; texts of any length are cut whole. Rows
    that share id and text, null ids included, get the same result. No rows give no
    rows. Columns of docs that have an added name are replaced.
    """
    text, n = text_or_empty(text_col), F.col("made.n")
    h1, h2, h3, h4 = draws(F.col(id_col), seed)
    plain = (
        (text == "")
        | F.contains(text, F.lit(marks.prefix))
        | F.contains(text, F.lit(marks.suffix))
        | F.contains(text, F.lit(marks.middle))
        | (h3 % 100 >= 100 - plain_percent)
    )
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        text.alias("text"),
        F.array(h1, h2).alias("h"),
        F.struct(unit_count(text, unit).alias("n"), form.alias("form")).alias("made"),
    )
    cuts = F.transform("h", lambda h: h % (n + 1))
    low, high = F.array_min(cuts), F.array_max(cuts)
    one = f"(?:{unit})"
    pattern = F.concat(
        F.lit(rf"(?s)\A({one}{{"), low.cast("string"), F.lit(rf"}}+)({one}{{"),
        (high - low).cast("string"), F.lit(r"}+)(.*+)\z"),
    )
    p, s, m = (_verbatim(x) for x in (marks.prefix, marks.suffix, marks.middle))
    order = F.when(F.col("made.form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    moved = F.col("made.form") != "plain"
    rows = rows.select(
        "row",
        "made",
        F.length("text").alias("chars"),
        F.when(moved, _replace(F.col("text"), pattern, order)).otherwise(F.col("text")).alias("output"),
    )
    # Lengths of the parts, read off the places of the marks in the output.
    output, spm = F.col("output"), F.col("made.form") == "spm"
    at = {x: F.locate(x, output).cast("long") for x in (marks.prefix, marks.suffix, marks.middle)}
    until_suffix = at[marks.suffix] - 1 - len(marks.prefix)
    until_middle = at[marks.middle] - at[marks.prefix] - len(marks.prefix)
    middle = F.length(output).cast("long") - at[marks.middle] + 1 - len(marks.middle)
    return rows.select(
        *(F.col("row").getField(c).alias(c) for c in docs.columns if c not in ADDED),
        F.col("made.n").alias("n"),
        F.col("made.form").alias("form"),
        F.when(moved, F.when(spm, until_middle).otherwise(until_suffix)).alias("prefix_chars"),
        F.when(moved, middle).alias("middle_chars"),
        output.alias("output"),
        restore(output, F.col("made.form"), marks).alias("restored"),
    )
