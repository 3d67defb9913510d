"""Shards of near equal bytes by histogram sort.

Rows are ordered by a 64-bit key. Splitters between shards are found by counting
the exact bytes below candidate boundaries on all partitions: each round divides
every range that still holds a splitter into 1,024 probes, until each splitter has
a probe within tolerance of its share, or its range is a single key. The counts of
a round are at most 1,024 rows for each splitter, whatever the input. Rows are
exchanged once, when their place is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import small_side, stored

ROUND_BITS = 10
TOLERANCE = 0.001
ROWS_PER_RUN = 50_000
KEY_BITS = 64
LAST_KEY = 2**63 - 1


def find_splitters(
    rows: DataFrame,
    shards: int,
    key: str = "key",
    weight: str = "size",
    tolerance: float = TOLERANCE,
) -> list[int]:
    """The shards - 1 keys at which shards 1, 2, ... begin, in order.

    rows should be cheap to read several times. The weight below a splitter is within
    tolerance of its share, or the splitter is the best that whole keys allow.
    """
    total = rows.agg(F.sum(weight)).first()[0]
    if not total:
        return [LAST_KEY] * (shards - 1)
    share = total / shards
    goals = {i: i * share for i in range(1, shards)}
    best = dict.fromkeys(goals, (float("inf"), LAST_KEY))
    # The range that holds each goal: prefix of its keys and weight below it.
    ranges: dict[int, tuple[int | None, int]] = dict.fromkeys(goals, (None, 0))
    bits = 0
    while ranges:
        done, bits = bits, min(KEY_BITS, bits + ROUND_BITS)
        counted = _probe(rows, key, weight, done, bits, {p for p, _ in ranges.values()})
        refined = {}
        for i, (prefix, below) in ranges.items():
            for probe, probed in counted[prefix]:
                if below + probed > goals[i]:
                    break
                below += probed
            low = probe << (KEY_BITS - bits)
            high = min((probe + 1) << (KEY_BITS - bits), LAST_KEY)
            best[i] = min(
                best[i],
                (abs(below - goals[i]), low),
                (abs(below + probed - goals[i]), high),
            )
            if best[i][0] > tolerance * share and bits < KEY_BITS:
                refined[i] = (probe, below)
        ranges = refined
    return sorted(start for _, start in best.values())


def _probe(
    rows: DataFrame, key: str, weight: str, done: int, bits: int, prefixes: set
) -> dict[int | None, list[tuple[int, int]]]:
    """Exact weight between neighbouring probes, in order, of each range to divide."""
    if done:
        rows = rows.where(F.shiftright(key, KEY_BITS - done).isin(sorted(prefixes)))
    counted = (
        rows.groupBy(F.shiftright(key, KEY_BITS - bits).alias("probe"))
        .agg(F.sum(weight).alias("weight"))
        .collect()
    )
    found: dict[int | None, list[tuple[int, int]]] = {p: [] for p in prefixes}
    for probe, probed in sorted((r["probe"], r["weight"]) for r in counted):
        found[probe >> (bits - done) if done else None].append((probe, probed))
    return found


def byte_shards(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot.

    size is the text's UTF-8 bytes (null: none) plus 1; slot counts from 0 within the
    shard without gaps. The key is a hash of id and text, so that null ids and copies
    spread; rows that repeat both stay in one shard. No rows give no rows; other
    columns of docs are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(F.col(id_col).cast("long"), text).alias("key"),
        ),
        "shard-rows",
    )
    splitters = find_splitters(rows, shards, tolerance=tolerance)
    shard = sum(((F.col("key") >= s).cast("int") for s in splitters), F.lit(0))
    # Runs of a shard are short key ranges; a run's first slot follows from the counts.
    bits = 8
    while rows.count() >> bits > ROWS_PER_RUN:
        bits += 1
    placed = rows.select("*", shard.alias("shard"), F.shiftright("key", KEY_BITS - bits).alias("run"))
    counts = placed.groupBy("shard", "run").agg(F.count("*").alias("n"))
    first = counts.select(
        "shard",
        "run",
        (
            F.sum("n").over(
                Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
            )
            - F.col("n")
        ).alias("first_slot"),
    )
    first = small_side(stored(first, "shard-runs"), 48)
    order = Window.partitionBy("shard", "run").orderBy("key", "doc_id", "text_crc32", "size")
    return (
        placed.join(first, ["shard", "run"])
        .withColumn("slot", F.col("first_slot") + F.row_number().over(order) - 1)
        .select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write docs as one folder per shard, rows in slot order; ids must be unique."""
    placed = placed.select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    (
        docs.join(placed, docs[id_col].eqNullSafe(placed["_id"]))
        .drop("_id")
        .repartitionByRange("_shard", "_slot")
        .sortWithinPartitions("_shard", "_slot")
        .drop("_slot")
        .write.partitionBy("_shard")
        .parquet(path)
    )
