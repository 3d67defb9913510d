"""NULL-preserving scoring expressions and safe ratios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mark a dimension row as outside the service area.
SPECIAL_BOROUGHS = ("unknown", "n/a")
SPECIAL_ZONES = ("unknown", "n/a", "outside of nyc")
SPECIAL_SERVICE_ZONES = ("unknown", "n/a")


def special_dimension(columns: dict[str, tuple[str, ...]]) -> Column:
    """True when any column, trimmed and lower-cased, is in its list; never NULL."""
    tests = [
        F.lower(F.trim(F.coalesce(F.col(name), F.lit("")))).isin(*values)
        for name, values in columns.items()
    ]
    return reduce(lambda left, right: left | right, tests)


def clip_at_zero(value: Column) -> Column:
    """max(value, 0), but NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def absolute_error(actual: Column, prediction: Column) -> Column:
    """|actual - prediction|, NULL when either side is NULL."""
    return F.abs(actual.cast("double") - prediction)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, NULL at a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded(value: Column, digits: int = 6) -> Column:
    """Round half up; the sum with 0.0 turns a rounded -0.0 into 0.0."""
    return F.round(value.cast("double"), digits) + F.lit(0.0)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def with_key_counts(
    df: DataFrame, by: tuple[str, ...], measures: dict[str, Column], folds: dict[str, Column]
) -> DataFrame:
    """Measures of each group with its zone_count and hour_count, without expanding rows.

    Several distinct counts in one aggregate would make several rows of each input row.
    Instead measures are taken by zone and folded, which counts the zones on the way;
    the hours are counted in a second aggregate that reads the keys alone. Both combine
    before their exchange. folds name how measures are merged over zones; a sum if not.
    """
    by_zone = df.groupBy(*by, "zone_id").agg(*[m.alias(name) for name, m in measures.items()])
    zones = by_zone.groupBy(*by).agg(
        *[folds.get(name, F.sum(name)).alias(name) for name in measures],
        F.count("zone_id").alias("zone_count"),
    )
    hours = df.groupBy(*by, "target_hour_utc").agg(F.lit(1).alias("one")).groupBy(*by)
    hours = hours.agg(F.count("target_hour_utc").alias("hour_count"))
    names = [*measures, "zone_count", "hour_count"]
    both = zones.unionByName(hours, allowMissingColumns=True)
    return both.groupBy(*by).agg(*[F.max(name).alias(name) for name in names])
