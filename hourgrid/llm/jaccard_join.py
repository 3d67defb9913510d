"""Jaccard join of documents on word n-grams, by vertical partitioning.

N-grams have a global order: by how often they occur, then by hash. How often is
counted over all documents, in a fixed number of buckets. The order is cut into
fragments of similar weight, and each document into the parts of its n-grams that
fall into each fragment. A candidate pair's overlap is counted in each fragment by
itself and summed.

Candidates: two sets of a and b n-grams with a Jaccard similarity of at least t
overlap in o = t * (a + b) / (1 + t) at least, so they share one among the first
a - o + 1 and b - o + 1 in the global order. Rare n-grams come first, so a
passage that many documents share proposes a pair only if they have little else.
Documents with equal sets are one node. Not all pairs of a posting list are formed:
first each list compares its members with one of them, the copy with the least of
its own. Members that these links have joined need no more comparison; only members
of different components are paired then. No link between components is missed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import scratch_path, small_side, stored
from hourgrid.llm.components import components
from hourgrid.llm.textbatch import row_groups, utf8

WORDS = 5
SIMILARITY_PERCENT = 75
ORDER_BITS = 20
ORDER_CHUNKS = 64
FRAGMENTS = 4
HOT_LEAST = 1000
HOT_SHARE = 1000  # a list is hot if it may hold a thousandth of all documents
HOT_SALTS = 64
PIECE_BYTES = 1 << 18

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_POWERS: list[np.ndarray] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of up to PIECE_BYTES bytes, A-Z lower-cased."""
    if not _POWERS:
        _POWERS.extend([_powers(_BASE, PIECE_BYTES + 1), _powers(_INVERSE, PIECE_BYTES + 1)])
    blank = np.concatenate(([True], _BLANK[data], [True]))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    ends = np.flatnonzero(~blank[:-1] & blank[1:])
    sums = np.concatenate(
        (np.zeros(1, np.uint64), np.cumsum((_LOWER[data] + np.uint64(1)) * _POWERS[0][: len(data)]))
    )
    found = (sums[ends] - sums[starts]) * _POWERS[1][starts]
    return starts, _mixed(found + (ends - starts).astype(np.uint64))


def _long_word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one long text, read in pieces that end between words."""
    found, at = [], 0
    while at < len(data):
        stop = min(len(data), at + PIECE_BYTES)
        if stop < len(data) and not _BLANK[data[stop]]:
            gaps = np.flatnonzero(_BLANK[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:  # one word longer than a piece: its hash is over the hashes of its parts
                gaps = np.flatnonzero(_BLANK[data[stop:]])
                stop = stop + int(gaps[0]) if len(gaps) else len(data)
                whole = np.zeros(1, np.uint64)
                for low in range(at, stop, PIECE_BYTES):
                    part = data[low : min(stop, low + PIECE_BYTES)]
                    whole = _mixed(whole * np.uint64(_BASE) + word_hashes(part)[1])
                found.append(whole)
                at = stop
                continue
        found.append(word_hashes(data[at:stop])[1])
        at = stop
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _grams(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each run of width words; of the whole sequence if shorter."""
    runs = max(0, len(words) - width + 1)
    if not runs:
        width, runs = len(words), 1
    found = np.full(runs, width, np.uint64)
    for k in range(width):
        found = _mixed(found * np.uint64(_BASE) + words[k : k + runs])
    return found


def gram_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct gram hashes) of each text; no words give an empty set."""
    data, offsets = utf8(column)
    for row, end in row_groups(offsets, PIECE_BYTES):
        part = data[offsets[row] : offsets[end]]
        if len(part) > PIECE_BYTES:
            words = _long_word_hashes(part)
            yield row, np.unique(_grams(words, width)) if len(words) else words
            continue
        # Texts are hashed together; a blank keeps the last word of one from the next.
        at = offsets[row : end + 1] - offsets[row]
        spaced = np.insert(part, at[1:-1], np.uint8(32))
        at = at + np.minimum(np.arange(len(at)), len(at) - 2)
        if len(spaced) > PIECE_BYTES:
            for one in range(row, end):
                words = word_hashes(data[offsets[one] : offsets[one + 1]])[1]
                yield one, np.unique(_grams(words, width)) if len(words) else words
            continue
        starts, words = word_hashes(spaced)
        cuts = np.searchsorted(starts, at)
        for k in range(end - row):
            own = words[cuts[k] : cuts[k + 1]]
            yield row + k, np.unique(_grams(own, width)) if len(own) else own


def _node(grams: np.ndarray) -> int:
    """64-bit identity of a set."""
    sums = np.array([grams.sum(dtype=np.uint64), np.bitwise_xor.reduce(grams)], np.uint64)
    squares = (grams * (grams | np.uint64(1))).sum(dtype=np.uint64)
    mixed = _mixed(np.array([len(grams)], np.uint64) * np.uint64(_BASE) + sums[:1])
    mixed = _mixed(mixed * np.uint64(_BASE) + sums[1:])
    return int(_mixed(mixed * np.uint64(_BASE) + squares).view(np.int64)[0])


def _order_bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


@dataclass(frozen=True)
class GlobalOrder:
    """Occurrences by bucket of grams, and the counts at which fragments begin."""

    counts: np.ndarray
    cuts: np.ndarray

    def ranked(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[_order_bucket(grams)]
        order = np.lexsort((grams, counts))
        return grams[order], counts[order]


def _survey(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (row key, node, n) for each text, and the task's counts in chunks."""
        counts = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            nodes, sizes, waiting = [], [], []
            for _, grams in gram_sets(batch.column("text"), width):
                nodes.append(_node(grams) if len(grams) else None)
                sizes.append(len(grams))
                waiting.append(grams)
                if len(waiting) % 512 == 0 or len(grams) > PIECE_BYTES // 8:
                    np.add.at(counts, _order_bucket(np.concatenate(waiting)), 1)
                    waiting = []
            if waiting:
                np.add.at(counts, _order_bucket(np.concatenate(waiting)), 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.nulls(len(nodes), pa.int32()),
                    pa.nulls(len(nodes), pa.binary()),
                ],
                names=["doc_id", "node", "n", "chunk", "counts"],
            )
        parts = [c.tobytes() for c in np.split(counts, ORDER_CHUNKS)]
        none = pa.nulls(ORDER_CHUNKS, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, pa.array(range(ORDER_CHUNKS), pa.int32()), pa.array(parts, pa.binary())],
            names=["doc_id", "node", "n", "chunk", "counts"],
        )

    return run


def _sum_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of counts by chunk; a task holds one sum for each chunk it meets."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            found = np.frombuffer(counts.as_buffer(), np.int64)
            sums[chunk] = sums[chunk] + found if chunk in sums else found.copy()
    if sums:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([s.tobytes() for s in sums.values()], pa.binary()),
            ],
            names=["chunk", "counts"],
        )


def _global_order(chunks: DataFrame, fragments: int) -> GlobalOrder:
    summed = chunks.repartition("chunk").mapInArrow(_sum_chunks, "chunk int, counts binary")
    parts = sorted((r["chunk"], bytes(r["counts"])) for r in summed.collect())  # ORDER_CHUNKS rows
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    if parts:
        counts = np.concatenate([np.frombuffer(p, np.int64) for _, p in parts])
    levels = np.sort(counts[counts > 0])
    weight = np.cumsum(levels)
    at = np.searchsorted(weight, [weight[-1] * k / fragments for k in range(1, fragments)]) if len(levels) else []
    return GlobalOrder(counts, levels[at] if len(levels) else np.zeros(fragments - 1, np.int64))


def _prefixes(width: int, percent: int, hot_from: int, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first grams of each set in the global order.

        cold is how many of them are too rare for a hot list; rare ones come first.
        """
        done: set[int] = set()
        for batch in batches:
            nodes, sizes, cold, firsts = [], [], [], []
            for _, grams in gram_sets(batch.column("text"), width):
                if not len(grams) or (node := _node(grams)) in done:
                    continue
                done.add(node)
                if len(done) > 200_000:
                    done.clear()
                n = len(grams)
                probe = n - -(-percent * n // 100) + 1
                nodes.append(node)
                sizes.append(n)
                ranked, counts = sent.value.ranked(grams)
                cold.append(int(np.searchsorted(counts[:probe], hot_from)))
                firsts.append(ranked[:probe].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(cold, pa.int64()),
                    pa.array(firsts, pa.list_(pa.int64())),
                ],
                names=["node", "n", "cold_n", "grams"],
            )

    return run


def _fragmented(width: int, fragments: int, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each set's part in each fragment of the global order that it reaches."""
        for batch in batches:
            nodes, places, parts = [], [], []
            for _, grams in gram_sets(batch.column("text"), width):
                if not len(grams):
                    continue
                node = _node(grams)
                ranked, counts = sent.value.ranked(grams)
                ends = np.searchsorted(counts, sent.value.cuts, "right")
                for k, part in enumerate(np.split(ranked, ends)):
                    if len(part):
                        nodes.append(node)
                        places.append(k)
                        parts.append(np.sort(part).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.array(places, pa.int32()),
                    pa.array(parts, pa.list_(pa.int64())),
                ],
                names=["node", "fragment", "grams"],
            )

    return run


class FragmentTable:
    """Parts of sets, bucketed by (node, fragment) so that verifying never moves them."""

    def __init__(self, spark: SparkSession, parts: DataFrame, fragments: int):
        self.spark = spark
        self.fragments = fragments
        self.name = f"gram_parts_{uuid.uuid4().hex}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        (
            parts.repartition(buckets, "node", "fragment")
            .dropDuplicates(["node", "fragment"])
            .write.bucketBy(buckets, "node", "fragment")
            .option("path", scratch_path(spark, "gram-parts"))
            .saveAsTable(self.name)
        )

    def linked(self, pairs: DataFrame, percent: int) -> DataFrame:
        """Pairs (a, b, n_a, n_b) with `linked`: overlaps by fragment, summed for each pair."""
        parts = self.spark.table(self.name)
        tasks = pairs.withColumn(
            "fragment", F.explode(F.sequence(F.lit(0), F.lit(self.fragments - 1)))
        )
        of_a = parts.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("of_a"))
        of_b = parts.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("of_b"))
        partial = (
            tasks.join(of_a, ["a", "fragment"])
            .join(of_b, ["b", "fragment"])
            .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("of_a", "of_b")).alias("k"))
        )
        shared = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("k").alias("shared"))
        union = F.col("n_a") + F.col("n_b") - F.col("shared")
        return shared.where(100 * F.col("shared") >= percent * union).select("a", "b")

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def near_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WORDS,
    percent: int = SIMILARITY_PERCENT,
    fragments: int = FRAGMENTS,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Words are runs without ASCII blanks, A-Z lower-cased. A set holds the distinct runs
    of width words; fewer words are one run; null, empty and blank texts have none and
    are components of their own. Two documents link if 100 * intersection >= percent *
    union; component_id is the smallest id reachable by links. Rows that repeat an id
    are documents of their own with one name. A null id is a component id only if all
    reachable ids are null. No rows give no rows; other columns are ignored.

    Sets are compared by 64-bit hashes of n-grams and identified by a 64-bit hash.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    schema = "doc_id long, node long, n long, chunk int, counts binary"
    survey = stored(texts.mapInArrow(_survey(width), schema), "gram-survey")
    order = _global_order(survey.where("chunk is not null").select("chunk", "counts"), fragments)
    sent = spark.sparkContext.broadcast(order)
    rows = survey.where("chunk is null").select("doc_id", "node", "n")

    postings = stored(_postings(texts, rows, order, width, percent, sent), "gram-postings")
    parts_of = _parts_maker(texts, rows, width, fragments, sent)
    roots = _linked_components(postings, parts_of, fragments, percent)
    named = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("node", "component_id")
    return rows.join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _postings(
    texts: DataFrame, rows: DataFrame, order: GlobalOrder, width: int, percent: int, sent
) -> DataFrame:
    """(gram, node, n, place) of the prefix grams that several nodes may share.

    Lists that may be hot, by the counts of the global order, skip the test: all
    other lists have a bounded length and meet in one task, where the grams of a
    single node are dropped.
    """
    hot_from = max(HOT_LEAST, rows.count() // HOT_SHARE)
    spread = (
        texts.select("text")
        .mapInArrow(
            _prefixes(width, percent, hot_from, sent),
            "node long, n long, cold_n long, grams array<long>",
        )
        .select("node", "n", "cold_n", F.posexplode("grams").alias("place", "gram"))
        .select(
            "gram",
            "node",
            "n",
            "place",
            F.when(F.col("place") < F.col("cold_n"), -1)
            .otherwise(F.pmod("node", F.lit(HOT_SALTS)))
            .cast("int")
            .alias("salt"),
        )
    )
    dealt = spread.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "gram", "salt")
    lists = Window.partitionBy("gram", "salt").orderBy("node")
    whole = lists.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A node may come again, from equal texts in other tasks, so the next row may be its own.
    marked = dealt.withColumns(
        {"before": F.lag("node").over(lists), "last": F.last("node").over(whole)}
    )
    again = F.coalesce(F.col("before") == F.col("node"), F.lit(False))
    others = (
        F.col("before").isNotNull() | (F.col("last") != F.col("node")) | (F.col("salt") >= 0)
    )
    return marked.where(~again & others).select("gram", "node", "n", "place")


def _parts_maker(texts: DataFrame, rows: DataFrame, width: int, fragments: int, sent):
    def parts(nodes: DataFrame) -> DataFrame:
        """(node, fragment, grams) of the given nodes, and perhaps of others with their ids."""
        asked = stored(
            rows.join(nodes, "node", "left_semi")
            .groupBy("node")
            .agg(F.min("doc_id").alias("doc_id"), F.count_if(F.col("doc_id").isNull()).alias("k"))
            .select("doc_id", (F.col("doc_id").isNull()).alias("unnamed")),
            "gram-asked",
        )
        ids = asked.where("not unnamed").select("doc_id").distinct()
        chosen = texts.join(small_side(ids, 16), "doc_id", "left_semi")
        if not asked.where("unnamed").isEmpty():
            chosen = chosen.unionByName(texts.where("doc_id is null"))
        return chosen.select("text").mapInArrow(
            _fragmented(width, fragments, sent), "node long, fragment int, grams array<long>"
        )

    return parts


def _linked_components(
    postings: DataFrame, parts_of, fragments: int, percent: int
) -> DataFrame:
    """(node, root) of all nodes that have a link."""
    spark = postings.sparkSession
    edges: list[DataFrame] = []
    roots = tried = None
    for propose in (_star_pairs, _remaining_pairs):
        members = postings
        if roots is None:
            members = members.withColumn("root", F.col("node"))
        else:
            members = members.join(roots, "node", "left").withColumn(
                "root", F.coalesce("root", "node")
            )
        pairs = _filtered(propose(members), percent)
        if tried is not None:
            pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        pairs = tried = stored(pairs, "gram-pairs")
        if pairs.isEmpty():
            continue
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        table = FragmentTable(spark, parts_of(nodes), fragments)
        try:
            edges.append(stored(table.linked(pairs, percent), "gram-links"))
        finally:
            table.close()
        if not edges[-1].isEmpty():
            roots = stored(components(reduce(DataFrame.unionByName, edges)), "gram-roots")
    if roots is None:
        roots = postings.select("node", F.col("node").alias("root")).limit(0)
    return roots


def _filtered(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs, a < b, that share a gram within both of their prefixes.

    A link of sets of these sizes needs an overlap of at least `needed`, so the two
    sets share a gram that is within the first n - needed + 1 of each.
    """
    needed = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    near = (F.col("p_a") <= F.col("n_a") - needed) & (F.col("p_b") <= F.col("n_b") - needed)
    swap = F.col("a") > F.col("b")
    return (
        pairs.where(near)
        .select(
            F.least("a", "b").alias("a"),
            F.greatest("a", "b").alias("b"),
            F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"),
            F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"),
        )
        .distinct()
    )


def _star_pairs(members: DataFrame) -> DataFrame:
    """Each list's members against the one in whose order the gram comes first.

    It has the smallest share of rarer grams of its own; such a copy links with more
    copies than any other.
    """
    own = (F.col("place") / F.col("n")).alias("own")
    lists = members.groupBy("gram").agg(
        F.min(F.struct(own, "node", "n", "place")).alias("c"), F.count("*").alias("k")
    )
    lists = lists.where("k > 1").select("gram", "c")
    return (
        members.join(lists, "gram")
        .where(F.col("node") != F.col("c.node"))
        .select(
            F.col("c.node").alias("a"),
            F.col("node").alias("b"),
            F.col("c.n").alias("n_a"),
            F.col("n").alias("n_b"),
            F.col("c.place").alias("p_a"),
            F.col("place").alias("p_b"),
        )
    )


def _remaining_pairs(members: DataFrame) -> DataFrame:
    """Members of a list outside its largest component, against all of other components."""
    sizes = members.groupBy("gram", "root").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("gram").agg(
        F.max(F.struct("size", "root")).alias("top"), F.count("*").alias("parts")
    )
    largest = largest.where("parts > 1").select("gram", F.col("top.root").alias("top_root"))
    outside = (
        members.join(largest, "gram")
        .where("root <> top_root")
        .select(
            "gram",
            "top_root",
            F.col("node").alias("a"),
            F.col("n").alias("n_a"),
            F.col("place").alias("p_a"),
            F.col("root").alias("root_a"),
        )
    )
    others = members.select(
        "gram",
        F.col("node").alias("b"),
        F.col("n").alias("n_b"),
        F.col("place").alias("p_b"),
        F.col("root").alias("root_b"),
    )
    # A pair outside the largest component would meet twice in a list.
    once = "root_a <> root_b AND (root_b = top_root OR a < b)"
    return outside.join(others, "gram").where(once).drop("top_root", "root_a", "root_b", "gram")
