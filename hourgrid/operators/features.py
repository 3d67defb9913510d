"""Calendar, lag and rolling features that see strictly earlier hours only.

All window expressions share one partitioning and one order, so the whole
feature table needs a single exchange on zone_id (none when it follows the
grid). Frames are ranges of time, right on frames with missing hours too. Rolling
means come from running sums: each row costs the same whatever the window length,
and integer sums keep the result exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.errors import ContractError
from hourgrid.functions.scoring import count_where, with_key_counts
from hourgrid.schemas import FEATURES, HISTORY_FEATURES, KEY

LAGS = (1, 24, 168)
ROLLING = (24, 168)


def calendar_columns(hour: Column) -> dict[str, Column]:
    """UTC hour, ISO weekday (Monday 1 .. Sunday 7), month and weekend flag."""
    weekday = F.weekday(hour) + 1
    return {
        "utc_hour": F.hour(hour).cast("byte"),
        "utc_day_of_week": weekday.cast("byte"),
        "utc_month": F.month(hour).cast("byte"),
        "is_weekend": weekday.isin(6, 7),
    }


def with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns(F.col("target_hour_utc")))


def _over(aggregate: str, upto: int, since: int | None = None) -> Column:
    """An aggregate of a zone's rows from since (the beginning if not given) to upto hours ago."""
    start = "UNBOUNDED" if since is None else f"INTERVAL {since} HOURS"
    return F.expr(
        f"{aggregate} OVER (PARTITION BY zone_id ORDER BY target_hour_utc "
        f"RANGE BETWEEN {start} PRECEDING AND INTERVAL {upto} HOURS PRECEDING)"
    )


def with_lags(df: DataFrame, lags: tuple[int, ...] = LAGS) -> DataFrame:
    """Value exactly n hours earlier in the zone; NULL where that hour has no row.

    Frames are over the time, so missing hours shift nothing. A zone has one row an hour.
    """
    return df.withColumns({f"lag_{n}h": _over("max(target_trip_count)", n, n) for n in lags})


def with_rolling_means(df: DataFrame, windows: tuple[int, ...] = ROLLING) -> DataFrame:
    """Mean of the n hours before, NULL unless all n are present and known.

    Each is a difference of two running sums, taken where the window begins and ends in
    time, so missing hours shift nothing and the cost does not grow with n.
    """
    running = {}
    for hours in (0, *windows):
        running[f"__sum_{hours}"] = F.coalesce(_over("sum(target_trip_count)", hours + 1), F.lit(0))
        running[f"__known_{hours}"] = _over("count(target_trip_count)", hours + 1)
    means = {
        f"rolling_mean_{n}h": F.when(
            F.col("__known_0") - F.col(f"__known_{n}") == n,
            (F.col("__sum_0") - F.col(f"__sum_{n}")) / F.lit(n),
        )
        for n in windows
    }
    return df.withColumns(running).withColumns(means).drop(*running)


def with_sliding_means(df: DataFrame, windows: tuple[int, ...] = ROLLING) -> DataFrame:
    """The same means from sliding time frames; the general form for non-integers."""
    columns = {
        f"rolling_mean_{n}h": F.when(
            _over("count(target_trip_count)", 1, n) == n, _over("avg(target_trip_count)", 1, n)
        )
        for n in windows
    }
    return df.withColumns(columns)


def all_known(names: tuple[str, ...] = HISTORY_FEATURES) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in names])


def build_features(assigned: DataFrame) -> DataFrame:
    """Feature table of a grid that already carries its split.

    Windows run over all splits, so validation and test rows warm up on the past.
    """
    base = assigned.select(
        *KEY, "split", F.col("trip_count").alias("target_trip_count"), "source_status"
    )
    table = with_rolling_means(with_lags(base))
    table = with_calendar(table).withColumn("features_complete", all_known())
    return table.select(*FEATURES.names)


def training_rows(features: DataFrame, *splits: str) -> DataFrame:
    """Complete rows with a known target, of the named splits."""
    return features.where(
        F.col("split").isin(*splits)
        & F.col("features_complete")
        & F.col("target_trip_count").isNotNull()
    )


def feature_report(features: DataFrame) -> DataFrame:
    """Availability per split: rows, targets, complete and eligible rows, NULLs per feature."""
    known = F.col("target_trip_count").isNotNull()
    complete = F.col("features_complete")
    missing = {f"missing_{name}": count_where(F.col(name).isNull()) for name in HISTORY_FEATURES}
    measures = {
        "total_rows": F.count("*"),
        "target_rows": count_where(known),
        "missing_target_rows": count_where(~known),
        "complete_feature_rows": count_where(complete),
        "training_eligible_rows": count_where(known & complete),
        **missing,
    }
    names = [*measures]
    counted = with_key_counts(features, ("split",), measures, {})
    return counted.select("split", names[0], "zone_count", "hour_count", *names[1:])


def feature_violations(features: DataFrame) -> DataFrame:
    """One row: rows and rows that break the value ranges of the feature table."""
    bad = (
        ~F.col("utc_hour").between(0, 23)
        | ~F.col("utc_day_of_week").between(1, 7)
        | ~F.col("utc_month").between(1, 12)
        | (F.col("features_complete") != all_known())
    )
    for name in HISTORY_FEATURES:
        value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        bad = bad | (value < 0) | F.isnan(value) | (value == F.lit(float("inf")))
    return features.agg(F.count("*").alias("rows"), count_where(bad).alias("violations"))


def check_features(features: DataFrame) -> None:
    violations = feature_violations(features).first().violations
    if violations:
        raise ContractError(f"{violations} feature rows are out of range")
