"""Toxicity by class-conditional Kneser-Ney models of characters.

The toxic and the ordinary model predict each character from the four before it.
Both discount their own counts by D and give what is saved to one distribution that
they share: interpolated Kneser-Ney of orders 4 to 1, whose counts are numbers of
different left neighbours over both classes. A context that a class has never seen
has the shared distribution alone, so rare expressions differ between the classes
only as far as there is evidence.

Counts are gathered from all labelled texts, n-grams are strings in DataFrames, and
each order is a join. For scoring, the log-ratio of the two models is a number for
each 5-gram seen, or else for its context. All of them are kept, by 64-bit keys: the
most frequent in a broadcast cache of bounded size, any others in stored tables, with
which the n-grams of the texts that the cache lacks are joined. A text's features are
the mean log-ratio of a character, which is the difference of length-normalised
log-likelihoods, and how far the sums over its words exceed a threshold. A logistic
curve over both, fitted on labelled texts that were not counted, gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm.common import held_out, small_side, stored
from hourgrid.llm.textbatch import Piece, letters, pieces

ORDER = 5
DISCOUNT = 0.75
CACHED_GRAMS = 1 << 22  # expected number of n-grams to broadcast, at most
CACHED_CONTEXTS = 1 << 20
WORD_EXCESS = 3.0
FIT_DOCS = 50_000  # expected number of texts to fit the logistic curve on, at most
FLUSH_GRAMS = 1_000_000
FLOOR = 1e-9


@dataclass(frozen=True)
class Cache:
    """Log-ratios by key, sorted; starts has the place of the first key of each prefix.

    values has one more entry than keys, 0, which is the ratio at place -1.
    """

    keys: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    shift: np.uint64

    @staticmethod
    def of(keys: np.ndarray, values: np.ndarray) -> Cache:
        order = np.argsort(keys)
        keys = keys[order]
        bits = min(max(len(keys).bit_length(), 1), 24)
        shift = np.uint64(64 - bits)
        prefixes = np.arange((1 << bits) + 1, dtype=np.uint64)
        starts = np.searchsorted(keys >> shift, prefixes).astype(np.int32)
        return Cache(keys, np.append(values[order], 0).astype(np.float32), starts, shift)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        prefix = (keys >> self.shift).astype(np.int64)
        at, end = self.starts[prefix], self.starts[prefix + 1]
        found = np.full(len(keys), -1, np.int64)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            hit = self.keys[here] == keys[left]
            found[left[hit]] = here[hit]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return found


@dataclass(frozen=True)
class ToxicityModel:
    """Caches of log-ratios, tables (key, ratio) of all others or None if there are none,
    and the logistic curve over two features."""

    grams: Cache
    contexts: Cache
    other_grams: DataFrame | None
    other_contexts: DataFrame | None
    mean: np.ndarray
    spread: np.ndarray
    curve: np.ndarray


def _squeezed(points: np.ndarray, starts: np.ndarray, seen: int):
    """Letters with single blanks between words; starts and seen moved along.

    Each text begins with a blank of its own, so an empty one has one point.
    """
    found = letters(points)
    kept = np.ones(len(found), bool)
    kept[1:] = (found[1:] != 32) | (found[:-1] != 32)
    inner = starts[starts < len(found)]
    kept[inner] = found[inner] != 32
    counts = np.concatenate(([0], np.cumsum(kept)))
    squeezed = found[kept]
    if seen:
        return squeezed, np.zeros(1, np.int64), int(counts[seen])
    at = counts[starts]
    return np.insert(squeezed, at, 32), at + np.arange(len(at)), 0


def _grams(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Row k: the ORDER code points that end at k, blank before the text's start."""
    n = len(points)
    first = np.repeat(starts, np.diff(np.append(starts, n)))
    grams = np.full((n, ORDER), 32, np.uint32)
    at = np.arange(n)
    for back in range(ORDER):
        ok = at - back >= first
        grams[ok, ORDER - 1 - back] = points[at[ok] - back]
    return grams


def _hash(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row."""
    found = np.full(len(grams), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(grams.shape[1]):
        found = (found ^ grams[:, k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        found ^= found >> np.uint64(31)
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct grams of a task with their counts in toxic and ordinary texts."""
    keys = np.zeros(0, np.uint64)
    counts = np.zeros((0, 2), np.int64)
    grams = np.zeros((0, ORDER), np.uint32)
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False) == 1
        for piece in pieces(batch.column("text"), ORDER - 1):
            points, starts, seen = _squeezed(piece.points, piece.starts, piece.seen)
            rows = _grams(points, starts)[seen:]
            classes = np.repeat(
                toxic[piece.first : piece.first + len(starts)],
                np.diff(np.append(starts, len(points))),
            )[seen:]
            fresh, where, back = np.unique(_hash(rows), return_index=True, return_inverse=True)
            one = np.stack(
                [
                    np.bincount(back, classes, minlength=len(fresh)),
                    np.bincount(back, ~classes, minlength=len(fresh)),
                ],
                axis=1,
            ).astype(np.int64)
            keys, where_all, back = np.unique(
                np.concatenate([keys, fresh]), return_index=True, return_inverse=True
            )
            both = np.concatenate([counts, one])
            counts = np.stack(
                [np.bincount(back, both[:, k], minlength=len(keys)) for k in (0, 1)], axis=1
            ).astype(np.int64)
            grams = np.concatenate([grams, rows[where]])[where_all]
            if len(keys) > FLUSH_GRAMS:
                yield _counted(grams, counts)
                keys, counts, grams = keys[:0], counts[:0], grams[:0]
    if len(keys):
        yield _counted(grams, counts)


def _counted(grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    texts = grams.astype("<u4").tobytes().decode("utf-32-le")
    found = [texts[k * ORDER : (k + 1) * ORDER] for k in range(len(grams))]
    return pa.RecordBatch.from_arrays(
        [pa.array(found, pa.string()), pa.array(counts[:, 0]), pa.array(counts[:, 1])],
        names=["gram", "toxic", "ordinary"],
    )


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary) counts over all rows of (text, toxic)."""
    parts = labelled.mapInArrow(_count, "gram string, toxic long, ordinary long")
    return parts.groupBy("gram").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")
    )


def shared_probabilities(grams: DataFrame) -> DataFrame:
    """(gram, p): interpolated Kneser-Ney of order ORDER - 1 over both classes together."""
    types = {ORDER: grams.select("gram")}
    for n in range(ORDER - 1, 0, -1):
        types[n] = (
            types[n + 1]
            .groupBy(F.expr("substring(gram, 2)").alias("gram"))
            .agg(F.count("*").alias("lefts"))
        )
    lower = None
    for n in range(1, ORDER):
        rows = types[n].withColumn("context", F.expr(f"left(gram, {n - 1})"))
        sums = rows.groupBy("context").agg(
            F.sum("lefts").alias("total"), F.count("*").alias("followers")
        )
        rows = rows.join(sums, "context")
        if lower is None:
            p_lower = F.lit(1.0) / F.col("followers")
        else:
            suffix = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("p_lower"))
            rows = rows.withColumn("suffix", F.expr("substring(gram, 2)")).join(suffix, "suffix")
            p_lower = F.col("p_lower")
        p = (
            F.greatest(F.col("lefts") - DISCOUNT, F.lit(0.0))
            + F.lit(DISCOUNT) * F.col("followers") * p_lower
        ) / F.col("total")
        lower = stored(rows.select("gram", p.alias("p")), "toxic-shared")
    return lower


def log_ratios(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, ratio, n) of the 5-grams seen and (context, ratio, n) for all others."""
    shared = shared_probabilities(grams).select(F.col("gram").alias("suffix"), "p")
    rows = grams.withColumns(
        {
            "context": F.expr(f"left(gram, {ORDER - 1})"),
            "suffix": F.expr("substring(gram, 2)"),
        }
    )
    contexts = rows.groupBy("context").agg(
        *(F.sum(k).alias(f"{k}_total") for k in ("toxic", "ordinary")),
        *(F.count_if(F.col(k) > 0).alias(f"{k}_kinds") for k in ("toxic", "ordinary")),
    )
    contexts = stored(contexts, "toxic-contexts")
    rows = rows.join(contexts, "context").join(shared, "suffix")

    def saved(kind: str) -> F.Column:
        return F.lit(DISCOUNT) * F.col(f"{kind}_kinds") / F.col(f"{kind}_total")

    def p(kind: str) -> F.Column:
        seen = F.greatest(F.col(kind) - DISCOUNT, F.lit(0.0)) / F.col(f"{kind}_total")
        mixed = seen + saved(kind) * F.col("p")
        return F.greatest(
            F.when(F.col(f"{kind}_total") > 0, mixed).otherwise(F.col("p")), F.lit(FLOOR)
        )

    def weight(kind: str) -> F.Column:
        return F.when(F.col(f"{kind}_total") > 0, saved(kind)).otherwise(F.lit(1.0))

    of_grams = rows.select(
        "gram",
        (F.log(p("toxic")) - F.log(p("ordinary"))).alias("ratio"),
        (F.col("toxic") + F.col("ordinary")).alias("n"),
    )
    of_contexts = contexts.select(
        F.col("context").alias("gram"),
        (F.log(weight("toxic")) - F.log(weight("ordinary"))).alias("ratio"),
        (F.col("toxic_total") + F.col("ordinary_total")).alias("n"),
    )
    return of_grams, of_contexts


def _most_frequent(counts: DataFrame, limit: int) -> Column | None:
    """Whether an n-gram of (gram, n) is among the most frequent, about limit; None: all are.

    Frequencies are compared by their logarithm; of the last level that has room for
    some only, those are chosen by hash.
    """
    level = F.floor(F.log2("n"))
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("size")).collect()
    if sum(r["size"] for r in levels) <= limit:
        return None
    for last, size in sorted(((r["level"], r["size"]) for r in levels), reverse=True):
        if size > limit:
            break
        limit -= size
    share = int(limit / size * (1 << 20))
    chosen = F.pmod(F.xxhash64("gram"), F.lit(1 << 20)) < share
    return (level > last) | ((level == last) & chosen)


def _kept(
    counts: DataFrame, ratios: DataFrame, limit: int, name: str
) -> tuple[Cache, DataFrame | None]:
    """Cache of the most frequent n-grams' ratios, and the table (key, ratio) of the others.

    counts has (gram, n) of the rows of ratios, which is costlier to read.
    """
    frequent = _most_frequent(counts, limit)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = "".join(batch.column("gram").to_pylist())
            grams = np.frombuffer(texts.encode("utf-32-le"), np.uint32).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_hash(grams).view(np.int64)), *batch.columns[1:]],
                names=["key", "ratio", "frequent"],
            )

    rows = ratios.select(
        "gram",
        F.col("ratio").cast("float").alias("ratio"),
        (F.lit(True) if frequent is None else frequent).alias("frequent"),
    ).mapInArrow(keyed, "key long, ratio float, frequent boolean")
    others = None
    if frequent is not None:
        rows = stored(rows, name)
        others = rows.where(~F.col("frequent")).select("key", "ratio")
    found = rows.where("frequent").select("key", "ratio").toPandas()
    keys = found["key"].to_numpy(np.int64).view(np.uint64)
    return Cache.of(keys, found["ratio"].to_numpy(np.float32)), others


def _ratios(grams: np.ndarray, of_grams: Cache, of_contexts: Cache) -> tuple:
    """Of each row the key and the cached ratio; the rows whose 5-gram is not cached, with
    the keys of their contexts and whether those are not cached either."""
    keys = _hash(grams)
    places = of_grams.places(keys)
    ratio = of_grams.values[places].astype(np.float64)
    unseen = np.flatnonzero(places < 0)
    context_keys = _hash(grams[unseen, :-1])
    places = of_contexts.places(context_keys)
    ratio[unseen] = of_contexts.values[places]
    return ratio, keys, unseen, context_keys, places < 0


def text_features(column: pa.Array, of_grams: Cache, of_contexts: Cache) -> np.ndarray:
    """Of each text: mean log-ratio of a character, and log(1 + excess of its words)."""
    sums = np.zeros((3, len(column)))  # characters, log-ratio, excess
    for piece in pieces(column, ORDER - 1):
        points, starts, seen = _squeezed(piece.points, piece.starts, piece.seen)
        ratio = _ratios(_grams(points, starts), of_grams, of_contexts)[0]
        ratio[:seen] = 0
        rows = np.arange(piece.first, piece.first + len(starts))
        sums[0, rows] += np.diff(np.append(starts, len(points)))
        sums[0, rows[0]] -= seen
        sums[1, rows] += np.add.reduceat(ratio, starts)
        words = np.flatnonzero(points == 32)
        words = np.union1d(words, starts)
        excess = np.maximum(np.add.reduceat(ratio, words) - WORD_EXCESS, 0)
        text = np.searchsorted(starts, words, "right") - 1
        sums[2] += np.bincount(rows[text], excess, minlength=len(column))
    return np.stack([sums[1] / np.maximum(sums[0], 1), np.log1p(sums[2])], axis=1)


PART = (
    "_doc long, _chars long, _ratio double, _excess double, _terms array<struct<"
    "word: long, times: long, known: double, gram: long, context: long, ratio: double>>"
)


def _part(piece: Piece, of_grams: Cache, of_contexts: Cache, joins: tuple, word: int) -> tuple:
    """Columns _chars to _terms of PART for each text of a piece, and the next free word.

    joins says whether there are other 5-grams and contexts than the cached ones. Words
    whose n-grams are all known are summed up here. Of the others, each different one of
    a text has a term for each n-gram to look up: known is the sum of the word's other
    n-grams, ratio what holds if the tables do not have it, context is null if that is
    known. Words are numbered from word.
    """
    points, starts, seen = _squeezed(piece.points, piece.starts, piece.seen)
    ratio, keys, unseen, context_keys, no_context = _ratios(
        _grams(points, starts), of_grams, of_contexts
    )
    ratio[:seen], keys[:seen] = 0, 0
    no_context &= joins[1]
    wanted = (unseen >= seen) & (joins[0] | no_context)
    unseen, context_keys, no_context = unseen[wanted], context_keys[wanted], no_context[wanted]
    words = np.union1d(np.flatnonzero(points == 32), starts)
    text = np.searchsorted(starts, words, "right") - 1
    of_word = np.searchsorted(words, unseen, "right") - 1
    fallback = ratio[unseen]
    ratio[unseen] = 0
    known = np.add.reduceat(ratio, words)
    waits = np.zeros(len(words), bool)
    waits[of_word] = True
    chars = np.diff(np.append(starts, len(points)))
    chars[0] -= seen
    done = np.where(waits, 0, known)
    excess = np.where(waits, 0, np.maximum(known - WORD_EXCESS, 0))
    # Equal n-grams make equal words; the first of them in a text stands for all.
    same = np.stack([text.astype(np.uint64), np.add.reduceat(keys, words)], axis=1)[waits]
    _, first, times = np.unique(same, axis=0, return_index=True, return_counts=True)
    number = np.zeros(len(words), np.int64)
    number[np.flatnonzero(waits)[first]] = times
    stands = number[of_word] > 0
    of_word = of_word[stands]
    terms = pa.StructArray.from_arrays(
        [
            pa.array(word + of_word),
            pa.array(number[of_word]),
            pa.array(known[of_word]),
            pa.array(keys[unseen[stands]].view(np.int64)),
            pa.array(context_keys[stands].view(np.int64), mask=~no_context[stands]),
            pa.array(fallback[stands]),
        ],
        names=["word", "times", "known", "gram", "context", "ratio"],
    )
    ends = np.cumsum(np.bincount(text[of_word], minlength=len(starts)))
    return [
        pa.array(chars.astype(np.int64)),
        pa.array(np.bincount(text, done, minlength=len(starts))),
        pa.array(np.bincount(text, excess, minlength=len(starts))),
        pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), terms),
    ], word + len(words)


def scores(features: np.ndarray, model: ToxicityModel) -> np.ndarray:
    if model.curve[0] == -np.inf:
        return np.zeros(len(features))
    scaled = (features - model.mean) / model.spread
    return 1 / (1 + np.exp(-np.clip(model.curve[0] + scaled @ model.curve[1:], -500, 500)))


def fit_curve(
    features: np.ndarray, toxic: np.ndarray, times: np.ndarray, ridge: float = 1e-3
) -> tuple:
    """Mean and spread of the features and the coefficients of the logistic curve.

    Each row counts as many times as times says.
    """
    mean = np.average(features, axis=0, weights=times)
    spread = np.sqrt(np.average((features - mean) ** 2, axis=0, weights=times)) + 1e-9
    rows = np.column_stack([np.ones(len(features)), (features - mean) / spread])
    penalty = ridge * times.sum() * np.diag([0.0] + [1.0] * features.shape[1])
    curve = np.zeros(rows.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ curve, -30, 30)))
        slope = rows.T @ (times * (p - toxic)) + penalty @ curve
        bend = (rows * (times * p * (1 - p))[:, None]).T @ rows + penalty + 1e-9 * np.eye(len(curve))
        step = np.linalg.solve(bend, slope)
        curve -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-10:
            break
    return mean, spread, curve


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> ToxicityModel:
    """Learn from docs (doc_id, text) and labels (doc_id, toxic) that are not held out.

    A quarter of the different labelled texts, by a hash of the text, but about fit_docs
    at most, fit the curve; all others are counted. Copies of a fitted text reach the
    driver as one row with their number.
    Without both classes in both parts the score is the toxic share of the labels.
    """
    spark = docs.sparkSession
    labels = labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labels = small_side(stored(labels, "toxic-labels"), 32)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(labels, "doc_id")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(1 << 20)))
    seen = labels.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    bound = int((1 << 18) * min(1.0, fit_docs / max(1.0, seen["n"] / 4)))
    grams = stored(
        gram_counts(rows.where(F.col("part") >= bound).select("text", "toxic")), "toxic-grams"
    )
    of_grams, of_contexts = log_ratios(grams)
    counts = grams.select("gram", (F.col("toxic") + F.col("ordinary")).alias("n"))
    cached_grams, other_grams = _kept(counts, of_grams, CACHED_GRAMS, "toxic-ratios")
    cached_contexts, other_contexts = _kept(
        of_contexts.select("gram", "n"), of_contexts, CACHED_CONTEXTS, "toxic-context-ratios"
    )
    flat = ToxicityModel(
        cached_grams, cached_contexts, other_grams, other_contexts,
        np.zeros(2), np.ones(2), np.array([-np.inf, 0.0, 0.0]),
    )
    if not seen["n"]:
        return flat
    rows = rows.where(F.col("part") < bound).withColumn("copy", F.xxhash64("text"))
    fitted = (
        featured(spark, rows, flat, ["copy", "toxic"])
        .groupBy("copy", "toxic")
        .agg(F.first("f0").alias("f0"), F.first("f1").alias("f1"), F.count("*").alias("times"))
        .toPandas()
    )
    toxic = fitted["toxic"].to_numpy(float)
    if len(set(toxic)) < 2 or seen["toxic"] in (0, seen["n"]):
        share = seen["toxic"] / seen["n"]
        base = np.array([np.log(max(share, 1e-12) / max(1 - share, 1e-12)), 0.0, 0.0])
        mean, spread, curve = np.zeros(2), np.ones(2), base
    else:
        mean, spread, curve = fit_curve(
            fitted[["f0", "f1"]].to_numpy(), toxic, fitted["times"].to_numpy(float)
        )
    return replace(flat, mean=mean, spread=spread, curve=curve)


def featured(
    spark: SparkSession, docs: DataFrame, model: ToxicityModel, keep: list[str]
) -> DataFrame:
    """Columns keep of docs, the two features f0 and f1 of each text, and its score."""
    if model.other_grams is not None or model.other_contexts is not None:
        return _joined(spark, docs, model, keep)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_features(batch.column("text"), sent.value.grams, sent.value.contexts)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array(found[:, 0]),
                    pa.array(found[:, 1]),
                    pa.array(scores(found, sent.value)),
                ],
                names=[*keep, "f0", "f1", "_score"],
            )

    added = [T.StructField(c, T.DoubleType()) for c in ("f0", "f1", "_score")]
    schema = T.StructType([docs.schema[c] for c in keep] + added)
    return docs.select(*keep, "text").mapInArrow(run, schema)


def _joined(
    spark: SparkSession, docs: DataFrame, model: ToxicityModel, keep: list[str]
) -> DataFrame:
    """What featured returns, with the n-grams that are not cached joined to their tables.

    Texts are read once: their parts are stored with what the cache does not know.
    """
    joins = (model.other_grams is not None, model.other_contexts is not None)
    sent = spark.sparkContext.broadcast((model.grams, model.contexts))
    fields = T.StructType.fromDDL(PART)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, word = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            for piece in pieces(batch.column("text"), ORDER - 1):
                columns, word = _part(piece, *sent.value, joins, word)
                rows = len(columns[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(piece.first, rows) for c in keep),
                        pa.array(np.arange(rows) + (doc + piece.first)),
                        *columns,
                    ],
                    names=[*keep, *fields.names],
                )
            doc += batch.num_rows

    schema = T.StructType([docs.schema[c] for c in keep] + fields.fields)
    parts = stored(docs.select(*keep, "text").mapInArrow(run, schema), "toxic-parts")
    terms = parts.select("_doc", F.inline("_terms"))
    if joins[1]:
        found = model.other_contexts.select(F.col("key").alias("context"), F.col("ratio").alias("found"))
        asked = terms.where(F.col("context").isNotNull()).join(found, "context", "left")
        asked = asked.withColumn("ratio", F.coalesce(F.col("found").cast("double"), F.lit(0.0)))
        terms = terms.where(F.col("context").isNull()).unionByName(asked.select(*terms.columns))
    if joins[0]:
        found = model.other_grams.select(F.col("key").alias("gram"), F.col("ratio").alias("found"))
        terms = terms.join(found, "gram", "left")
        terms = terms.withColumn("ratio", F.coalesce(F.col("found").cast("double"), F.col("ratio")))
    words = terms.groupBy("_doc", "word").agg(
        F.first("times").alias("times"), (F.first("known") + F.sum("ratio")).alias("sum")
    )
    over = F.greatest(F.col("sum") - WORD_EXCESS, F.lit(0.0))
    words = words.groupBy("_doc").agg(
        F.sum(F.col("times") * F.col("sum")).alias("more_ratio"),
        F.sum(F.col("times") * over).alias("more_excess"),
    )
    sums = parts.groupBy("_doc").agg(
        *(F.first(c).alias(c) for c in keep),
        *(F.sum(c).alias(c) for c in ("_chars", "_ratio", "_excess")),
    )
    rows = sums.join(words, "_doc", "left")
    none = F.lit(0.0)
    rows = rows.select(
        *keep,
        (
            (F.col("_ratio") + F.coalesce("more_ratio", none))
            / F.greatest(F.col("_chars"), F.lit(1))
        ).alias("f0"),
        F.log1p(F.col("_excess") + F.coalesce("more_excess", none)).alias("f1"),
    )
    score = none
    if model.curve[0] != -np.inf:
        score = F.lit(float(model.curve[0]))
        for k, name in enumerate(("f0", "f1")):
            scaled = (F.col(name) - float(model.mean[k])) / float(model.spread[k])
            score = score + scaled * float(model.curve[k + 1])
        score = 1 / (1 + F.exp(-F.greatest(F.least(score, F.lit(500.0)), F.lit(-500.0))))
    return rows.withColumn("_score", score)


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, score) for each row of docs.

    Null texts count as empty and are scored like any other. Labels other than 0 and 1
    and null ids are ignored; of several labels of a document the largest counts. No
    rows give no rows; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = train(docs, labels.select("doc_id", "toxic"))
    rows = featured(docs.sparkSession, docs, model, ["doc_id"])
    return rows.select("doc_id", F.col("_score").alias("score"))
