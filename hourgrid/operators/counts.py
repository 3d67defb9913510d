"""Observed counts per zone and UTC hour, and the contracts on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.errors import ContractError
from hourgrid.functions.scoring import count_where
from hourgrid.schemas import KEY, ZONE_DISPOSITIONS


def source_activity(cells: DataFrame) -> DataFrame:
    """Counts per (zone, hour, disposition) of every row that proves the source was up.

    Rejected zones count too; rows rejected by their timestamp do not.
    """
    return (
        cells.where(F.col("disposition").isin(*ZONE_DISPOSITIONS))
        .groupBy(
            F.when(~F.col("zone_missing"), F.col("zone_id")).alias("zone_id"),
            "target_hour_utc",
            "disposition",
        )
        .agg(F.sum("cell_rows").alias("trip_count"))
    )


def hourly_counts(cells: DataFrame) -> DataFrame:
    """Retained events per (zone, UTC hour), tagged with the source month."""
    return (
        cells.where(F.col("disposition") == "retained")
        .groupBy("source_month", "zone_id", "target_hour_utc")
        .agg(F.sum("cell_rows").alias("trip_count"))
        .select("zone_id", "target_hour_utc", "trip_count", "source_month")
    )


def duplicate_keys(df: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def counts_summary(counts: DataFrame) -> DataFrame:
    """One row: output rows and trips, zones, hour range, surplus rows on repeated keys."""
    by_key = counts.groupBy(*KEY).agg(
        F.count("*").alias("rows"), F.sum("trip_count").alias("trips")
    )
    return by_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("output_rows"),
        F.coalesce(F.sum("trips"), F.lit(0)).alias("output_trip_count"),
        F.count_distinct("zone_id").alias("zone_count"),
        F.min("target_hour_utc").alias("min_target_hour_utc"),
        F.max("target_hour_utc").alias("max_target_hour_utc"),
        count_where(F.col("rows") > 1).alias("duplicate_keys"),
    )


def conservation(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """One row: trips in the counts against retained raw rows."""
    sides = counts.select(
        F.col("trip_count").alias("counted"), F.lit(0).cast("long").alias("kept")
    ).unionByName(
        cells.where(F.col("disposition") == "retained").select(
            F.lit(0).cast("long").alias("counted"), F.col("cell_rows").alias("kept")
        )
    )
    totals = sides.agg(
        F.coalesce(F.sum("counted"), F.lit(0)).alias("output_trip_count"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("retained_rows"),
    )
    return totals.withColumn(
        "is_conserved", F.col("output_trip_count") == F.col("retained_rows")
    )


def check_counts(counts: DataFrame, cells: DataFrame) -> dict:
    """Raise unless keys are unique and every retained row is counted once."""
    summary = counts_summary(counts).first().asDict()
    balance = conservation(counts, cells).first()
    if summary["duplicate_keys"]:
        raise ContractError(f"{summary['duplicate_keys']} zone-hours appear in several rows")
    if not balance.is_conserved:
        raise ContractError(
            f"{balance.retained_rows} events were retained, but the counts add up to "
            f"{balance.output_trip_count}"
        )
    return summary
