"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text's features are its 1- to 3-grams of lower-case letters, where anything but a
letter is a blank; n-grams of blanks alone do not count. They are hashed to a fixed
number of buckets. Training sums counts by language and bucket on the cluster; the
matrix of log-probabilities, of a fixed size for each language, is broadcast. Tasks
score Arrow batches in numpy: the buckets of a piece of text are the columns of a
sparse matrix, of which each document is a row, and it is multiplied with the
log-probabilities by gathering and summing.

A matrix holds a group of languages. With more languages than a group, the groups are
scored one after the other, each in a written pass: the best language so far and the sum
of all likelihoods are carried on, which gives what one matrix of all would give.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm.common import free_prefix, held_out, small_side, stored
from hourgrid.llm.textbatch import Piece, letters, pieces

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
TRAIN_DOCS = 20_000  # expected number of documents of a language to learn from, at most
GROUP_LANGUAGES = 256  # a group's matrix takes 256 KB for each language
SMOOTHING = 0.5
UNKNOWN = "und"
ADDED = ["_lang", "_score"]


@dataclass(frozen=True)
class LanguageModel:
    """Log-probabilities by language and bucket; the last bucket counts nothing."""

    languages: list[str]
    prior: np.ndarray
    log_p: np.ndarray


def features(piece: Piece, order: int, points: np.ndarray) -> np.ndarray:
    """Bucket of the n-gram that ends at each code point; BUCKETS where there is none."""
    mixed = points * np.uint32(0x9E3779B1)
    blank = points == 32
    for back in range(1, order):
        mixed[back:] = mixed[back:] * np.uint32(31) + points[:-back] * np.uint32(
            (0x85EBCA6B + 0x27D4EB2E * back) & 0xFFFFFFFF
        )
        blank[back:] &= points[:-back] == 32
    mixed ^= mixed >> np.uint32(15)
    mixed = mixed * np.uint32((0x2C1B3C6D + 2 * order * 0x1234567) & 0xFFFFFFFF)
    found = (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)
    found[blank] = BUCKETS
    for back in range(order - 1):
        starts = piece.starts + back
        found[starts[starts < len(found)]] = BUCKETS
    found[: piece.seen] = BUCKETS
    return found


def train_groups(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
    group: int | None = GROUP_LANGUAGES,
) -> Iterator[LanguageModel]:
    """Models of `group` languages each, in the order of their names; one at least.

    Learns from rows with a language, about train_docs of each, chosen by a hash of the
    text. Priors count all rows with a language. The driver holds one group at a time;
    group None puts all languages into one model.
    """
    docs = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    docs = docs.where(F.col("lang").isNotNull())
    langs = stored(docs.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    rows_seen = langs.agg(F.sum("n")).first()[0] or 0
    share = langs.select("lang", F.least(F.lit(1.0), F.lit(train_docs) / F.col("n")).alias("share"))
    docs = docs.join(small_side(share, 16 + F.octet_length("lang")), "lang")
    docs = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    schema = "lang string, bucket int, n long"
    sums = docs.select("text", "lang").mapInArrow(_count, schema)
    sums = stored(sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-buckets")
    reference, done, left = None, None, True
    while left:
        part = langs if done is None else langs.where(F.col("lang") > done)
        part = part.orderBy("lang")
        counts = {r["lang"]: r["n"] for r in (part if group is None else part.limit(group)).collect()}
        if not counts and reference is not None:
            return
        languages = sorted(counts)
        left = group is not None and len(languages) == group
        here = sums.where(F.col("lang").between(languages[0], languages[-1])) if languages else sums
        table = np.full((len(languages), BUCKETS + 1), SMOOTHING)
        found = here.toPandas()  # up to BUCKETS rows for each language
        rows = found["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(dtype=int)
        table[rows, found["bucket"].to_numpy(dtype=int)] += found["n"].to_numpy(dtype=float)
        log_p = np.log(table[:, :BUCKETS]) - np.log(table[:, :BUCKETS].sum(axis=1, keepdims=True))
        if reference is None:  # only differences count, also between groups
            reference = log_p.mean(axis=0) if languages else np.zeros(BUCKETS)
        log_p = np.hstack([log_p - reference, np.zeros((len(languages), 1))]).astype(np.float32)
        seen = np.array([counts[x] for x in languages], float)
        yield LanguageModel(languages, np.log(seen / max(rows_seen, 1)), log_p)
        done = languages[-1] if languages else None


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
) -> LanguageModel:
    """One model of all languages, however many, for few of them; see train_groups."""
    return next(train_groups(docs, text_col, lang_col, train_docs, None))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for piece in pieces(batch.column("text"), max(ORDERS) - 1):
            ends = np.append(piece.starts[1:], len(piece.points))
            points = letters(piece.points)
            for order in ORDERS:
                found = features(piece, order, points)
                for k, (start, end) in enumerate(zip(piece.starts, ends)):
                    lang = langs[piece.first + k]
                    total = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                    if end - start < 4096:
                        np.add.at(total, found[start:end], 1)
                    else:
                        total += np.bincount(found[start:end], minlength=BUCKETS + 1)
    for lang, total in sums.items():
        hit = np.flatnonzero(total[:BUCKETS])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(hit), pa.string()),
                pa.array(hit, pa.int32()),
                pa.array(total[hit], pa.int64()),
            ],
            names=["lang", "bucket", "n"],
        )


def identify(
    docs: DataFrame,
    models: LanguageModel | Iterable[LanguageModel],
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of docs with columns keep (all if None), and _lang and _score added.

    models is one model, or those of train_groups. A null text, or one without a letter,
    is `und` with score 0, as is every text if nothing was learned. Otherwise _score is
    the posterior of _lang. Ties go to the first language by name. Texts of any length
    are read whole. No rows give no rows. Carried columns named _lang or _score are
    replaced.
    """
    models = iter([models] if isinstance(models, LanguageModel) else models)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ADDED]
    inputs = list(dict.fromkeys([*keep, text_col]))
    so_far = [free_prefix(inputs) + c for c in ("lang", "top", "sum")]
    model, seen = next(models), None
    for following in models:
        # Text and carried columns go on; the pass is written, so one matrix is in use at a time.
        passed = docs.select(*inputs) if seen is None else seen
        merge = so_far if seen is not None else None
        seen = stored(_pass(passed, model, text_col, inputs, merge, so_far), "languages-so-far")
        model = following
    if seen is None:
        return _pass(docs.select(*inputs), model, text_col, keep, None, ADDED)
    return _pass(seen, model, text_col, keep, so_far, ADDED)


def _pass(
    docs: DataFrame, model: LanguageModel, text_col: str, keep: list[str], before: list[str] | None, added: list[str]
) -> DataFrame:
    """Score one group and merge it with the groups before, whose columns `before` names.

    The first column added is the language, the others are its posterior, or the best
    score and the sum of likelihoods over it, for the next pass.
    """
    kinds = [T.StructField(c, T.DoubleType() if k else T.StringType()) for k, c in enumerate(added)]
    schema = T.StructType([*(docs.schema[c] for c in keep), *kinds])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, top, total = group_scores(batch.column(text_col), sent.value)
            if before:
                old = [batch.column(c).to_numpy(zero_copy_only=False) for c in before[1:]]
                names, top, total = merged(batch.column(before[0]).to_pylist(), *old, names, top, total)
            values = [names, 1.0 / total] if added == ADDED else [names, top, total]
            columns = [batch.column(c) for c in keep]
            new = [pa.array(v, pa.string() if k == 0 else pa.float64()) for k, v in enumerate(values)]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[*keep, *added])

    return docs.mapInArrow(score, schema)


def group_scores(
    column: pa.Array, model: LanguageModel
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """For each text: best language, its score, sum of all likelihoods over its own.

    Texts without a letter have an infinite sum, so that their posterior is 0.
    """
    n_langs = len(model.languages)
    totals = np.zeros((n_langs, len(column)))
    has_letter = np.zeros(len(column), bool)
    for piece in pieces(column, max(ORDERS) - 1):
        points = letters(piece.points)
        # An empty document's segment must not borrow its neighbour's first value.
        filled = np.append(piece.starts[1:], len(points)) > piece.starts
        starts = piece.starts[filled]
        rows = piece.first + np.flatnonzero(filled)
        if not len(rows):
            continue
        has_letter[rows] |= np.logical_or.reduceat(points != 32, starts)
        for order in ORDERS:
            found = features(piece, order, points)
            for k in range(n_langs):
                totals[k, rows] += np.add.reduceat(model.log_p[k][found], starts)
    if not n_langs:
        return [UNKNOWN] * len(column), np.zeros(len(column)), np.full(len(column), np.inf)
    totals += model.prior[:, None]
    top = totals.max(axis=0)
    best = totals.argmax(axis=0)
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, has_letter)]
    return names, top, np.where(has_letter, np.exp(totals - top).sum(axis=0), np.inf)


def merged(
    names: list[str], top: np.ndarray, total: np.ndarray, other: list[str], top2: np.ndarray, total2: np.ndarray
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Results of two groups as those of one; ties go to the earlier group."""
    high = np.maximum(top, top2)
    total = total * np.exp(top - high) + total2 * np.exp(top2 - high)
    return [b if late else a for a, b, late in zip(names, other, top2 > top)], high, total


def score_texts(column: pa.Array, model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and its posterior for each text of a column."""
    names, _, total = group_scores(column, model)
    return names, 1.0 / total


def learn_and_identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    keep: list[str] | None = None,
    group: int = GROUP_LANGUAGES,
) -> DataFrame:
    """Train on the rows that are not held out, then identify the language of all rows."""
    learned = docs.where(~held_out(id_col))
    return identify(docs, train_groups(learned, text_col, lang_col, group=group), text_col, keep)
