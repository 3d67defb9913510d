"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only.

Documents come in batches, largest ids first. A batch's run holds a row for each
line hash: in how many documents of the batch it stands, and the largest of their
ids. The run is bucketed and sorted by hash, so that joining runs is a merge. The
new run is anti-joined with all earlier ones: a hash not met before has its keeper
in this batch, since later batches hold smaller ids. Then the run joins level 0;
when a level holds FAN_OUT runs they are compacted into one of the next level.
At the end the runs give each hash's document count and the anti-joins its keeper.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import ascii_lower, scratch_path, stored

MIN_POINTS = 40
MIN_DOCS = 5
BATCHES = 4
FAN_OUT = 3
BLANKS = " \t\n\x0b\x0c\r"
NO_ID = -(2**63)
HASH = ["h1", "h2"]


class LineRuns:
    """Levelled sorted runs of (h1, h2, n_docs, top_id) and the keepers found so far."""

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT):
        self.spark = spark
        self.fan_out = fan_out
        self.levels: list[list[str]] = []
        self.keepers: list[DataFrame] = []
        self.tables: list[str] = []

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (doc, h1, h2); its ids must be below those of earlier batches."""
        batch = lines.groupBy(*HASH).agg(
            F.countDistinct("doc").alias("n_docs"), F.max("doc").alias("top_id")
        )
        run = self._write(batch)
        fresh = self.spark.table(run)
        for older in (name for level in self.levels for name in level):
            fresh = fresh.join(self.spark.table(older).select(*HASH).hint("merge"), HASH, "left_anti")
        self.keepers.append(stored(fresh.select(*HASH, "top_id"), "line-keepers"))
        self._place(run, 0)

    def _place(self, run: str, level: int) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_out:
            full, self.levels[level] = self.levels[level], []
            merged = self._write(self._summed(full))
            self._place(merged, level + 1)

    def _summed(self, runs: list[str]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, (self.spark.table(r) for r in runs))
        return rows.groupBy(*HASH).agg(
            F.sum("n_docs").alias("n_docs"), F.max("top_id").alias("top_id")
        )

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (
            rows.repartition(buckets, *HASH)
            .write.bucketBy(buckets, *HASH)
            .sortBy(*HASH)
            .option("path", scratch_path(self.spark, "line-run"))
            .saveAsTable(name)
        )
        self.tables.append(name)
        return name

    def repeated(self, min_docs: int) -> DataFrame:
        """Hashes found in at least min_docs documents, with the id that keeps its lines."""
        runs = [name for level in self.levels for name in level]
        frequent = self._summed(runs).where(F.col("n_docs") >= min_docs).select(*HASH)
        keepers = reduce(DataFrame.unionByName, self.keepers)
        return keepers.join(frequent, HASH).select(*HASH, F.col("top_id").alias("keep_id"))

    def close(self) -> None:
        """Forget the runs; their files stay in the shared folder like other checkpoints."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_points: int = MIN_POINTS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """All rows and columns of docs, with _kept_text, _n_lines and _n_dropped added.

    A line whose key has at least min_points code points and stands in at least
    min_docs documents goes, except from the document with the largest id that holds
    it, where every occurrence stays. Null and empty texts are one empty line. Rows
    that share an id count as one document; null ids together count as one, smaller
    than any other. Columns of docs keep their names; added ones begin with an
    underscore and must not be taken. No rows give no rows.
    """
    spark = docs.sparkSession
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    keys = F.transform(
        lines,
        lambda line, i: F.struct(i.alias("line"), line_key(line).alias("key")),
    )
    hashed = (
        docs.select(doc.alias("doc"), F.xxhash64(text).alias("row"), F.explode(keys).alias("k"))
        .where(F.length("k.key") >= min_points)
        .select(
            "doc",
            "row",
            F.col("k.line").alias("line"),
            F.xxhash64("k.key").alias("h1"),
            F.xxhash64(F.lit("second"), "k.key").alias("h2"),
        )
    )
    hashed = stored(hashed, "line-hashes")
    runs = LineRuns(spark, fan_out)
    bounds = _batch_bounds(hashed, batches)
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = hashed
        if low is not None:
            part = part.where(F.col("doc") < low)
        if high is not None:
            part = part.where(F.col("doc") >= high)
        runs.add(part)
    repeated = stored(runs.repeated(min_docs), "line-repeated")
    runs.close()
    drops = (
        hashed.join(repeated, HASH)
        .where(F.col("doc") != F.col("keep_id"))
        .groupBy("doc", "row")
        .agg(F.collect_set("line").alias("_drop"))
    )
    marked = docs.withColumns({"_doc": doc, "_row": F.xxhash64(text)})
    drops = drops.select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), "_drop")
    none = F.array().cast("array<int>")
    joined = marked.join(drops, ["_doc", "_row"], "left").withColumn("_lines", lines)
    kept = F.array_except(
        F.sequence(F.lit(0), F.size("_lines") - 1), F.coalesce("_drop", none)
    )
    kept_text = F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
    return joined.select(
        *(joined[c] for c in docs.columns),
        F.when(F.col("_drop").isNull(), text).otherwise(kept_text).alias("_kept_text"),
        F.size("_lines").cast("long").alias("_n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("_n_dropped"),
    )


def _batch_bounds(hashed: DataFrame, batches: int) -> list[int]:
    """Ids that part the lines into batches of similar size, largest first."""
    shares = [i / batches for i in range(batches - 1, 0, -1)]
    found = hashed.agg(F.percentile_approx("doc", shares).alias("at")).first()["at"]
    return list(dict.fromkeys(found or []))
