"""Assignment of grid rows to contiguous time splits."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.errors import ContractError, ParameterError
from hourgrid.functions.calendar import instant
from hourgrid.functions.scoring import count_where
from hourgrid.schemas import SPLIT_NAMES


def utc_hour_bound(value: datetime, label: str) -> datetime:
    if value.tzinfo is None or value.utcoffset() is None:
        raise ParameterError(f"{label}: the time has no zone")
    if value.utcoffset() != timedelta(0):
        raise ParameterError(f"{label}: the zone is not UTC")
    if value.minute or value.second or value.microsecond:
        raise ParameterError(f"{label}: not on the hour")
    return value


@dataclass(frozen=True)
class Split:
    name: str
    start: datetime
    end: datetime


@dataclass(frozen=True)
class Splits:
    """Train, validation and test, half-open and without gaps."""

    train: tuple[datetime, datetime]
    validation: tuple[datetime, datetime]
    test: tuple[datetime, datetime]

    def __post_init__(self) -> None:
        for split in self:
            utc_hour_bound(split.start, f"{split.name} start")
            utc_hour_bound(split.end, f"{split.name} end")
            if split.start >= split.end:
                raise ParameterError(f"{split.name}: no hour between start and end")
        if self.train[1] != self.validation[0] or self.validation[1] != self.test[0]:
            raise ParameterError("a split does not begin where the one before ends")

    def __iter__(self):
        return iter(Split(name, *getattr(self, name)) for name in SPLIT_NAMES)

    @property
    def start(self) -> datetime:
        return self.train[0]

    @property
    def end(self) -> datetime:
        return self.test[1]


def split_of(hour: Column, splits: Splits) -> Column:
    """Split name of an hour, NULL outside all splits; plain CASE, no join."""
    label = F.lit(None).cast("string")
    for split in splits:
        inside = (hour >= instant(split.start)) & (hour < instant(split.end))
        label = F.when(inside, split.name).otherwise(label)
    return label


def assign_splits(grid: DataFrame, splits: Splits) -> DataFrame:
    return grid.withColumn("split", split_of(F.col("target_hour_utc"), splits))


def split_bounds(spark: SparkSession, splits: Splits) -> DataFrame:
    """Inline three-row table of split bounds."""
    rows = [
        F.struct(
            F.lit(s.name).alias("split"),
            instant(s.start).alias("start_utc"),
            instant(s.end).alias("end_utc_exclusive"),
        )
        for s in splits
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def assign_splits_by_range(grid: DataFrame, splits: Splits) -> DataFrame:
    """The same assignment as a range join against the three-row bounds table."""
    bounds = F.broadcast(split_bounds(grid.sparkSession, splits))
    hour = F.col("target_hour_utc")
    inside = (hour >= F.col("start_utc")) & (hour < F.col("end_utc_exclusive"))
    return grid.join(bounds, inside).drop("start_utc", "end_utc_exclusive")


def split_coverage(assigned: DataFrame) -> DataFrame:
    """One row: rows in total, and rows without a split."""
    return assigned.agg(
        F.count("*").alias("grid_rows"),
        count_where(F.col("split").isNull()).alias("unassigned_rows"),
    )


def check_splits(assigned: DataFrame) -> None:
    if split_coverage(assigned).first().unassigned_rows:
        raise ContractError("some grid rows lie outside the splits")
