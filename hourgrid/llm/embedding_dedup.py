"""Near-duplicate embeddings by spherical-cap filters.

Filter directions come from a random product code: vectors are rotated, split into
blocks, and each block has a small codebook of random unit directions; a direction
is one choice from each. A vector is list-decoded to all directions whose score
passes a threshold, growing the list block by block and dropping every prefix that
even the best rest cannot lift over the threshold. The threshold gives a stated
mean list length on random vectors; a vector that lies badly to the code, and has a
shorter list, takes its own lower threshold, which gives that length. Vectors meet in the cells of their label and
directions, and all pairs of a cell are verified by their cosine in double
precision. At cosine 0.93 two lists share about sixteen directions.

The code grows with the largest label: the number of directions is in proportion to its
vectors, so that a cell keeps about CELL_MEAN vectors that have nothing in common, and
lists grow with its logarithm, so that the share of pairs found stays the same.

Equal vectors of a label are one vector with a weight. A cell with many vectors is
cut into blocks, and pairs of blocks are verified in separate tasks. A task returns
no pairs, but link counts and the edges of a spanning forest: a pair counts only in
the first cell that both vectors are in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import stored
from hourgrid.llm.components import components

COSINE = 0.93
BLOCKS = 2
CODES = 1024  # of a block, at least
LIST_LENGTH = 32
LONGER = 8  # directions more in a list each time the codes of a block double
CELL_MEAN = 32
DECODE_SCORES = 1 << 19  # scores of a block that are held at once
CELL_ROWS = 1024
SEED = 20260
PROBES = 256
SPLIT_FROM = 16  # dimensions; fewer have one block
WIDEST = 0.95  # caps must be wide enough for two vectors at COSINE to share some


def code_size(vectors: int) -> tuple[int, int]:
    """Codes of a block and list length for the number of vectors of the largest label.

    The codes are the first power of two for which vectors * length / codes ** BLOCKS,
    the mean number of unrelated vectors in a cell, is CELL_MEAN or less.
    """
    codes, length = CODES, LIST_LENGTH
    while vectors * length > CELL_MEAN * codes**BLOCKS:
        codes, length = 2 * codes, length + LONGER
    return codes, length


class ProductCode:
    """Rotation, codebooks and threshold for vectors of one dimension."""

    def __init__(self, dim: int, blocks: int = BLOCKS, codes: int = CODES, length: int = LIST_LENGTH):
        rng = np.random.default_rng([SEED, dim])
        self.codes, self.length = codes, length
        self.blocks = blocks if dim >= SPLIT_FROM else 1
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = np.linspace(0, dim, self.blocks + 1).astype(int)
        self.books = []
        for low, high in zip(self.cuts, self.cuts[1:]):
            book = rng.standard_normal((high - low, codes))
            book *= np.sqrt((high - low) / dim) / np.linalg.norm(book, axis=0)
            self.books.append(book)
        probe = rng.standard_normal((PROBES, dim))
        probe /= np.linalg.norm(probe, axis=1, keepdims=True)
        top = [self._best(scores, 8 * length) for scores in zip(*self._scores(probe))]
        top = np.sort(np.concatenate(top))
        self.threshold = min(float(top[-min(len(top), length * PROBES)]), WIDEST)

    @staticmethod
    def _best(scores: tuple[np.ndarray, ...], k: int) -> np.ndarray:
        """The k best sums of one score from each block."""
        best = np.zeros(1)
        for score in scores:
            best = (best[:, None] + np.sort(score)[-k:]).ravel()
            best = np.partition(best, -k)[-k:] if len(best) > k else best
        return best

    def _kth(self, scores: list[np.ndarray]) -> np.ndarray:
        """Score of each row's direction number `length`: no list is shorter."""
        k = self.length
        best = np.zeros((len(scores[0]), 1))
        for score in scores:
            top = np.partition(score, -min(k, score.shape[1]), axis=1)[:, -k:]
            best = (best[:, :, None] + top[:, None, :]).reshape(len(score), -1)
            best = np.partition(best, -min(k, best.shape[1]), axis=1)[:, -k:]
        return best.min(axis=1)

    def _scores(self, unit: np.ndarray) -> list[np.ndarray]:
        turned = unit @ self.rotation
        return [
            turned[:, low:high] @ book
            for low, high, book in zip(self.cuts, self.cuts[1:], self.books)
        ]

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of every direction over the threshold, and of each row's best."""
        scores = self._scores(unit)
        best = [s.max(axis=1) for s in scores]
        rest = [sum(best[k + 1 :], np.zeros(len(unit))) for k in range(self.blocks)]
        goal = np.minimum(self.threshold, self._kth(scores) - 1e-12)
        rows = np.arange(len(unit))
        codes, sums = np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for k, score in enumerate(scores):
            found = sums[:, None] + score[rows]
            at, code = np.nonzero(found >= (goal - rest[k])[rows][:, None])
            sums, codes, rows = found[at, code], codes[at] * self.codes + code, rows[at]
        return rows, codes


_CODES: dict[tuple[int, int, int], ProductCode] = {}


def _code(dim: int, codes: int, length: int) -> ProductCode:
    key = (dim, codes, length)
    if key not in _CODES:
        _CODES[key] = ProductCode(dim, codes=codes, length=length)
    return _CODES[key]


def _lists(column: pa.Array) -> list[np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    return np.split(values, np.cumsum(sizes)[:-1])


def _decode(codes: int, length: int):
    rows_at_once = max(1, DECODE_SCORES // codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Add to each vector its sorted list of directions."""
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _lists(batch.column("vector"))
            found: list = [None] * len(vectors)
            dims = np.array([len(v) for v in vectors])
            for dim in np.unique(dims):
                where = np.flatnonzero(dims == dim)
                for part in np.array_split(where, math.ceil(len(where) / rows_at_once)):
                    stacked = np.stack([vectors[k] for k in part])
                    scale = np.abs(stacked).max(axis=1, keepdims=True)
                    stacked = stacked / scale
                    stacked /= np.linalg.norm(stacked, axis=1, keepdims=True)
                    rows, at = _code(int(dim), codes, length).decode(stacked)
                    order = np.lexsort((at, rows))
                    ends = np.searchsorted(rows[order], np.arange(1, len(part)))
                    for k, codes_of in zip(part, np.split(at[order], ends)):
                        found[k] = codes_of
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["node", "filters"]
            )

    return run


CELL = ["label", "dim", "filter", "block", "other"]


def _verify(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each cell; a partition is sorted by cell, and one cell is held at a time."""
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            keys = np.stack([table.column(c).to_numpy() for c in CELL], axis=1)
            new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            starts = np.concatenate(([0], new))
            yield from _cells(table.slice(0, starts[-1]), starts, cosine)
            rest = table.slice(starts[-1])
        if rest is not None and rest.num_rows:
            yield from _cells(rest, np.array([0, rest.num_rows]), cosine)

    return run


def _cells(table: pa.Table, starts: np.ndarray, cosine: float) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    table = table.combine_chunks()
    arrays = [table.column(c).chunk(0) for c in ("vector", "filters")]
    vectors, filters = _lists(arrays[0]), _filter_lists(arrays[1])
    node, weight, home, block, other, cell = (
        table.column(c).to_numpy() for c in ("node", "weight", "home", "block", "other", "filter")
    )
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low, high in zip(starts, starts[1:]):
        if high - low < 2:
            continue
        here = slice(low, high)
        unit = np.stack(vectors[low:high])
        unit = unit / np.abs(unit).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        linked = unit @ unit.T >= cosine
        np.fill_diagonal(linked, False)
        if block[low] != other[low]:  # pairs within a block have a task of their own
            linked &= home[here][:, None] != home[here][None, :]
        if not linked.any():
            continue
        earlier = [f[f < cell[low]] for f in filters[low:high]]
        known, at = np.unique(np.concatenate(earlier), return_inverse=True)
        met = np.zeros((high - low, len(known)), np.float32)
        met[np.repeat(np.arange(high - low), [len(f) for f in earlier]), at] = 1
        first = linked & (met @ met.T == 0)
        links = first @ weight[here]
        root = np.arange(high - low)
        while True:
            lower = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1))
            lower = lower[lower]
            if (lower == root).all():
                break
            root = lower
        told = (links > 0) | (root != np.arange(len(root)))
        out.append((node[here][told], node[here][root][told], links[told]))
    if out:
        a, b, links = (np.concatenate(x) for x in zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), pa.array(links.astype(np.int64))], names=["a", "b", "links"]
        )


def _filter_lists(column: pa.Array) -> list[np.ndarray]:
    values = column.flatten().to_numpy()
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    return np.split(values, np.cumsum(sizes)[:-1])


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    cell_rows: int = CELL_ROWS,
    expected: int = 0,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    The code is made for the vectors of the largest label, or for `expected` of them if
    that is more.

    Only rows with equal labels are compared. Null labels, null, empty or zero vectors
    and vectors with a null or non-finite component link with nothing: their
    component is their own id. Vectors of different lengths never link. Rows that
    repeat an id are vectors of their own. A null id is no component id unless all ids
    reachable are null. No rows give no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    usable = (
        F.col(label_col).isNotNull()
        & (F.size(vector_col) > 0)
        & F.forall(
            vector,
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
        )
        & F.exists(vector, lambda x: x != 0)
    )
    rows = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(F.coalesce(usable, F.lit(False)), vector).alias("vector"),
        F.col(label_col).alias("label"),
    )
    usable_rows = rows.where(F.col("vector").isNotNull())
    classes = usable_rows.groupBy("label", "vector").agg(
        F.min("vec_id").alias("least_id"), F.count("*").alias("weight")
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    codes, length = code_size(max(largest, expected))
    lists = classes.select("node", "vector").mapInArrow(
        _decode(codes, length), "node long, filters array<long>"
    )
    lists = stored(lists, "vector-filters")
    narrow = classes.select("node", "weight", "label", F.size("vector").alias("dim")).join(lists, "node")
    cells = narrow.select("node", "label", "dim", F.explode("filters").alias("filter"))
    full = (
        cells.groupBy("label", "dim", "filter")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )
    met = cells.join(full, ["label", "dim", "filter"])
    # A cell of n vectors has ceil(n / cell_rows) blocks; each vector goes to all pairs with its own.
    met = met.withColumn("blocks", F.ceil(F.col("n") / cell_rows).cast("int"))
    met = met.withColumn("home", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = met.withColumn("away", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "node",
        F.xxhash64("label").alias("label"),
        "dim",
        "filter",
        F.least("home", "away").alias("block"),
        F.greatest("home", "away").alias("other"),
        "home",
    )
    payload = classes.select("node", "weight", "vector").join(lists, "node")
    met = met.join(payload, "node").repartition(*CELL).sortWithinPartitions(*CELL)
    found = met.mapInArrow(_verify(cosine), "a long, b long, links long")
    found = stored(found, "vector-links")
    roots = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    judged = classes.select("node", "label", "vector", "weight", "least_id")
    judged = judged.join(roots, "node", "left").join(links, "node", "left")
    judged = judged.withColumn("root", F.coalesce("root", "node"))
    least = judged.groupBy("root").agg(F.min("least_id").alias("component_id"))
    judged = judged.join(least, "root").select(
        "label",
        "vector",
        (F.coalesce("links", F.lit(0).cast("long")) + F.col("weight") - 1).alias("n_links"),
        "component_id",
    )
    judged = stored(judged, "vector-classes")
    of_rows = usable_rows.join(judged, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("vector").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return of_rows.union(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
