"""Exact interpolated quantiles without holding all values in one task.

The built-in exact percentile keeps every distinct value of a group in one
aggregation buffer. Here the values are first counted (partial aggregation
collapses repeats) and written out once, then laid into buckets by sign and
logarithm, which is monotone and as fine near zero as elsewhere. A running total
over the few buckets says which of them hold the wanted ranks, and only those
buckets are ordered value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.session import cut_lineage

# Buckets for each doubling of |x|. No double lies below 2 ** -1075.
BUCKETS_PER_DOUBLING = 256
LOWEST_EXPONENT = 1075


def exact_quantiles(
    df: DataFrame, value: str, probabilities: tuple[float, ...], by: tuple[str, ...]
) -> DataFrame:
    """Linear-interpolated quantiles of a column per group: (by..., probability, quantile)."""
    v = F.col(value).cast("double")
    keys = list(by)
    values = (
        df.where(v.isNotNull())
        .select(*keys, (v + F.lit(0.0)).alias("v"))
        .groupBy(*keys, "v")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "bucket",
            F.when(F.col("v") == 0, 0).otherwise(
                F.signum("v")
                * (F.floor((F.log2(F.abs("v")) + LOWEST_EXPONENT) * BUCKETS_PER_DOUBLING) + 1)
            ).cast("long"),
        )
    )
    values = cut_lineage(values)

    group = Window.partitionBy(*keys)
    running = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = F.col("probability") * (F.col("total") - 1)
    holds = [
        (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("upto")) for rank in ("low", "high")
    ]
    wanted = (
        values.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("bucket_n"))
        .withColumn("upto", F.sum("bucket_n").over(running))
        .withColumn("total", F.sum("bucket_n").over(group))
        .withColumn("before", F.col("upto") - F.col("bucket_n"))
        .withColumn("probability", F.explode(F.array(*[F.lit(p) for p in probabilities])))
        .withColumn("low", F.floor(position).cast("long"))
        .withColumn("high", F.ceil(position).cast("long"))
        .withColumn("fraction", position - F.col("low"))
        .where(holds[0] | holds[1])
        .groupBy(*keys, "bucket", "before")
        .agg(F.collect_list(F.struct("probability", "low", "high", "fraction")).alias("ranks"))
    )

    inside = (
        Window.partitionBy(*keys, "bucket")
        .orderBy("v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    spans = (
        values.join(wanted, [*keys, "bucket"])
        .withColumn("upto", F.col("before") + F.sum("n").over(inside))
        .withColumn("before", F.col("upto") - F.col("n"))
        .select(*keys, "v", "before", "upto", F.inline("ranks"))
    )
    return (
        spans.where(holds[0] | holds[1])
        .groupBy(*keys, "probability")
        .agg(
            F.max(F.when(holds[0], F.col("v"))).alias("low_v"),
            F.max(F.when(holds[1], F.col("v"))).alias("high_v"),
            F.max("fraction").alias("fraction"),
        )
        .select(
            *keys,
            "probability",
            (F.col("low_v") + (F.col("high_v") - F.col("low_v")) * F.col("fraction")).alias(
                "quantile"
            ),
        )
    )
