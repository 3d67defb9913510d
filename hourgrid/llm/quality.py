"""Quality classifier by hierarchical empirical Bayes.

Evidence of a text: features of its words and characters are cut into a fixed number
of bins, and each bin has a log-ratio of good to bad labelled documents, smoothed.
Evidence of its site: the share of good documents on a host is shrunk toward the
global share, and that of a path on the host toward the host's. How strongly is
estimated from the spread of the groups' shares by the method of moments, so hosts
with few labels stay near the prior. The score is the sigmoid of the path's
posterior log-odds plus the calibrated evidence of the text.

All statistics are grouped aggregations, first by path, then by host, then of all
hosts; no group of rows is ever gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import held_out, small_side, stored

BINS = 12
SMOOTHING = 1.0
EVIDENCE_WEIGHT = 1.0
# Losing a good document costs more than keeping a bad one.
KEEP_FROM = 0.1
WORDS = r"[^\x20\x09-\x0D]+"


def text_features(text: Column) -> dict[str, Column]:
    """Shares between 0 and 1, and the logarithm of the length, of a text."""
    text = F.coalesce(text, F.lit(""))
    points = F.greatest(F.length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / points

    words = F.greatest(F.regexp_count(text, F.lit(WORDS)), F.lit(1))
    repeats = F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]+)(?=[\x20\x09-\x0D]\1(?![^\x20\x09-\x0D]))"))
    return {
        "symbols": share(r"[^\p{L}\p{N}\s.,]"),
        "capitals": share(r"\p{Lu}"),
        "digits": share(r"\p{N}"),
        "stops": share(r"[.,]"),
        "repeats": repeats / words,
        "long_words": F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]{25,}")) / words,
        "length": F.least(F.log1p(F.length(text)) / 16, F.lit(1.0)),
    }


def binned(share: Column) -> Column:
    """Bin of a share: 0 alone, then bins that halve toward 0."""
    return F.when(share <= 0, 0).otherwise(
        F.greatest(F.lit(1), F.lit(BINS - 1) + F.floor(F.log2(share)).cast("int"))
    )


@dataclass(frozen=True)
class Priors:
    """Global share of good documents, and the strengths of the two shrinkages."""

    good: float
    host_strength: float
    path_strength: float


def moment_strength(groups: DataFrame, prior: Column) -> float:
    """Pseudo-count with which groups (good, n) are drawn toward prior.

    The variance of the groups' shares beyond sampling noise gives the strength of a
    beta prior; no excess variance gives the largest strength allowed.
    """
    share = F.col("good") / F.col("n")
    spread = groups.select(
        "n",
        (F.col("n") * (share - prior) * (share - prior)).alias("square"),
        prior.alias("p"),
    ).agg(
        F.sum("square").alias("between"),
        F.count("*").alias("groups"),
        F.sum("n").alias("n"),
        F.sum(F.col("p") * (1 - F.col("p")) * F.col("n")).alias("noise"),
    ).first()
    if not spread["n"] or not spread["noise"]:
        return 1e6
    noise = spread["noise"] / spread["n"]
    excess = spread["between"] - spread["groups"] * noise
    variance = excess / max(spread["n"] - spread["groups"], 1)
    if variance <= 0:
        return 1e6
    return float(min(max(noise / variance - 1, 1.0), 1e6))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """One row per row of docs: doc_id, host, path, evidence, site_posterior, score, kept.

    labels has doc_id and quality; other values than 0 and 1 are ignored, of several
    labels of a document the smallest counts, and the held-out fold is not learned
    from. Null texts count as empty. A null host or path is a site of its own. Without
    labels every score is 0.5 and all documents stay. Rows that repeat an id are
    scored each by itself. No rows give no rows; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        F.array(
            *(binned(f).cast("int") for f in text_features(F.col(text_col)).values())
        ).alias("bins"),
    )
    rows = stored(rows, "quality-rows")
    truth = labels.where(F.col("quality").isin(0, 1) & ~held_out("doc_id"))
    truth = truth.groupBy("doc_id").agg(F.min("quality").alias("good"))
    learned = stored(rows.join(truth, "doc_id"), "quality-learned")

    total = learned.agg(F.count("*").alias("n"), F.sum("good").alias("good")).first()
    good = (float(total["good"] or 0) + 0.5) / (total["n"] + 1.0)
    paths = learned.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    paths = stored(paths, "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    host_strength = moment_strength(hosts, F.lit(good))
    shrunk = hosts.select(
        F.col("host").alias("_host"),
        ((F.col("good") + host_strength * good) / (F.col("n") + host_strength)).alias("host_share"),
    )
    on_host = F.col("host").eqNullSafe(F.col("_host"))
    within = paths.join(shrunk, on_host)
    path_strength = moment_strength(within, F.col("host_share"))
    sites = within.select(
        F.col("host").alias("_host"),
        F.col("path").alias("_path"),
        (
            (F.col("good") + path_strength * F.col("host_share")) / (F.col("n") + path_strength)
        ).alias("path_share"),
    )

    # Evidence: naive Bayes over the bins, shrunk to its calibrated weight.
    bins = learned.select("good", F.posexplode("bins").alias("feature", "bin"))
    counted = bins.groupBy("feature", "bin").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")
    )
    whole = Window.partitionBy("feature")
    ratio = F.log(
        ((F.col("good") + SMOOTHING) / (F.sum("good").over(whole) + SMOOTHING * BINS))
        / ((F.col("bad") + SMOOTHING) / (F.sum("bad").over(whole) + SMOOTHING * BINS))
    )
    table = {
        (r["feature"], r["bin"]): r["ratio"]
        for r in counted.select("feature", "bin", ratio.alias("ratio")).collect()
    }  # at most BINS rows for each feature
    evidence = F.lit(0.0)
    for k in range(len(text_features(F.lit("")))):
        of_bin = F.array(*(F.lit(float(table.get((k, b), 0.0))) for b in range(BINS)))
        evidence = evidence + F.get(of_bin, F.get("bins", k))
    evidence = evidence * EVIDENCE_WEIGHT if total["n"] else F.lit(0.0)

    judged = rows.withColumn("evidence", evidence)
    judged = judged.join(small_side(stored(shrunk, "quality-hosts"), 64), on_host, "left").drop("_host")
    sites = small_side(stored(sites, "quality-sites"), 96)
    same = on_host & F.col("path").eqNullSafe(F.col("_path"))
    judged = judged.join(sites, same, "left")
    base = good if total["n"] else 0.5
    posterior = F.coalesce("path_share", "host_share", F.lit(base))
    log_odds = F.log(posterior) - F.log(1 - posterior) + F.col("evidence")
    score = 1 / (1 + F.exp(-log_odds))
    return judged.select(
        "doc_id",
        "host",
        "path",
        "evidence",
        posterior.alias("site_posterior"),
        score.alias("score"),
        (score >= keep_from).alias("kept"),
    )
