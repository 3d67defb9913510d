"""Read queries over one served prediction table.

Each query is a filter and a small sort over the table; on the sorted Parquet
layout of the sink the hour filter skips row groups by their statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.errors import ContractError, ParameterError
from hourgrid.functions.calendar import instant
from hourgrid.functions.scoring import count_where, with_key_counts
from hourgrid.operators.compare import ERROR_TOLERANCE, any_null, uncovered_zones
from hourgrid.operators.grid import lookup_audit
from hourgrid.operators.splits import utc_hour_bound
from hourgrid.schemas import KEY

# Bounds of the read queries.
MAX_RANKING = 25
MAX_HISTORY_HOURS = 168

# The served table.
SERVED = T.StructType(
    [
        T.StructField("zone_id", T.IntegerType()),
        T.StructField("target_hour_utc", T.TimestampType()),
        T.StructField("actual_trip_count", T.LongType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("absolute_error", T.DoubleType()),
    ]
)

FORECAST_COLUMNS = (
    "zone_id",
    "borough",
    "zone_name",
    "service_zone",
    "target_hour_utc",
    "prediction",
    "actual_trip_count",
    "absolute_error",
)


def served_predictions(predictions: DataFrame) -> DataFrame:
    """The locked test rows of a prediction table; the error is NULL where the actual is unknown."""
    return predictions.where(
        (F.col("split") == "test") & F.col("prediction").isNotNull()
    ).select(*KEY, "actual_trip_count", "prediction", "absolute_error")


def served_validation(served: DataFrame) -> DataFrame:
    """One row: rows, unique keys, zones, hours, NULL and bad rows, hour range."""
    actual = F.col("actual_trip_count").cast("double")
    gap = F.abs(F.col("absolute_error") - F.abs(actual - F.col("prediction")))
    names = [*KEY, "prediction"]
    unlike = F.col("absolute_error").isNull() != F.col("actual_trip_count").isNull()
    negative = (
        (F.col("actual_trip_count") < 0)
        | (F.col("prediction") < 0)
        | (F.col("absolute_error") < 0)
    )
    keys = served.groupBy(*KEY).agg(
        F.count("*").alias("key_rows"),
        count_where(any_null(names)).alias("null_rows"),
        count_where(negative).alias("negative_rows"),
        count_where(unlike | F.coalesce(gap > ERROR_TOLERANCE, F.lit(False))).alias(
            "inconsistent_rows"
        ),
        F.count("absolute_error").alias("scored_rows"),
    )
    sources = {
        "key_rows": "rows",
        "null_rows": "null_rows",
        "scored_rows": "scored_rows",
        "negative_rows": "negative_rows",
        "inconsistent_rows": "inconsistent_rows",
    }
    measures = {source: F.sum(source) for source in sources} | {
        "unique_keys": F.count("*"),
        "first_hour": F.min("target_hour_utc"),
        "last_hour": F.max("target_hour_utc"),
    }
    folds = {"first_hour": F.min("first_hour"), "last_hour": F.max("last_hour")}
    found = with_key_counts(keys, (), measures, folds)
    zero = F.lit(0).cast("long")
    return found.select(
        *[F.coalesce(source, zero).alias(name) for source, name in sources.items()],
        F.coalesce("unique_keys", zero).alias("unique_keys"),
        "zone_count",
        "hour_count",
        "first_hour",
        "last_hour",
    )


def zones_served(served: DataFrame, lookup: DataFrame) -> DataFrame:
    """Lookup rows of the zones that have predictions, by id."""
    rows = lookup.select("zone_id", "borough", "zone_name", "service_zone")
    return rows.join(served.select("zone_id"), "zone_id", "left_semi").orderBy("zone_id")


@dataclass(frozen=True)
class ForecastStore:
    """A served table with its lookup and its half-open test window.

    strict_zones looks an asked-for zone up first and refuses an unknown one.
    """

    served: DataFrame
    lookup: DataFrame
    start: datetime
    end: datetime
    strict_zones: bool = True

    def check(self) -> dict:
        """Raise unless the served table is whole, unique, consistent and covered."""
        facts = served_validation(self.served).first().asDict()
        hours = int((self.end - self.start).total_seconds() // 3600)
        if facts["rows"] != facts["unique_keys"]:
            raise ContractError("a zone and hour is served more than once")
        if facts["null_rows"] or facts["negative_rows"]:
            raise ContractError("served rows hold NULLs or values below zero")
        if facts["inconsistent_rows"]:
            raise ContractError("stored errors differ from the stored predictions")
        full = facts["zone_count"] * facts["hour_count"] == facts["rows"]
        first, last = self.served.agg(
            (F.min("target_hour_utc") == instant(self.start)).alias("first"),
            (F.max("target_hour_utc") == instant(self.end - timedelta(hours=1))).alias("last"),
        ).first()
        if not (full and facts["hour_count"] == hours and first and last):
            raise ContractError(f"served rows leave holes in the test window: {facts}")
        audit = lookup_audit(self.lookup).first()
        if audit.surplus_keys or audit.null_rows:
            raise ContractError("lookup repeats a zone or leaves an attribute empty")
        if not uncovered_zones(self.served, self.lookup).isEmpty():
            raise ContractError("some served zones have no lookup row")
        return facts

    def _cutoff(self, value: datetime) -> datetime:
        utc_hour_bound(value, "cutoff")
        if not self.start <= value < self.end:
            raise ParameterError(f"cutoff must be inside [{self.start}, {self.end})")
        return value

    def _zone(self, zone_id: int) -> int:
        if zone_id < 1:
            raise ParameterError("zone_id must be at least 1")
        if self.strict_zones and self.served.where(F.col("zone_id") == zone_id).isEmpty():
            raise ParameterError(f"zone {zone_id} is not served")
        return zone_id

    def _described(self, rows: DataFrame) -> DataFrame:
        dimension = self.lookup.select("zone_id", "borough", "zone_name", "service_zone")
        return rows.join(dimension, "zone_id", "left").select(*FORECAST_COLUMNS)

    def summary(self, predictor: str) -> DataFrame:
        """One row: predictor, window, rows and zones."""
        return self.served.agg(
            F.lit(predictor).alias("predictor"),
            instant(self.start).alias("test_start_utc"),
            instant(self.end).alias("test_end_utc_exclusive"),
            F.count("*").alias("prediction_rows"),
            F.count("absolute_error").alias("scored_rows"),
            F.count_distinct("zone_id").alias("zone_count"),
        )

    def zones(self) -> DataFrame:
        return zones_served(self.served, self.lookup)

    def forecast(self, zone_id: int, hour: datetime) -> DataFrame:
        """The prediction of one zone for one hour."""
        hit = (F.col("zone_id") == self._zone(zone_id)) & (
            F.col("target_hour_utc") == instant(self._cutoff(hour))
        )
        return self._described(self.served.where(hit))

    def rankings(self, hour: datetime, limit: int = 10) -> DataFrame:
        """The zones with the highest predictions at one hour; ties by zone id."""
        if not 1 <= limit <= MAX_RANKING:
            raise ParameterError(f"limit must be from 1 to {MAX_RANKING}")
        rows = self.served.where(F.col("target_hour_utc") == instant(self._cutoff(hour)))
        top = rows.orderBy(F.desc("prediction"), "zone_id").limit(limit)
        return self._described(top).orderBy(F.desc("prediction"), "zone_id")

    def rankings_all_hours(self, limit: int = 10) -> DataFrame:
        """The ranking of every hour at once, with each zone's position."""
        if not 1 <= limit <= MAX_RANKING:
            raise ParameterError(f"limit must be from 1 to {MAX_RANKING}")
        order = Window.partitionBy("target_hour_utc").orderBy(F.desc("prediction"), "zone_id")
        ranked = self.served.withColumn("position", F.row_number().over(order)).where(
            F.col("position") <= limit
        )
        return ranked.select("target_hour_utc", "position", "zone_id", "prediction")

    def ranking_share(self, hour: datetime, limit: int = 10) -> DataFrame:
        """One row: zones listed and the sum of their predictions."""
        return self.rankings(hour, limit).agg(
            F.count("*").alias("zones"), F.sum("prediction").alias("predicted_total")
        )

    def zone_rank(self, zone_id: int, hour: datetime) -> DataFrame:
        """One row: the zone's position among all zones of the hour, NULL without a forecast."""
        zone = self._zone(zone_id)
        rows = self.served.where(F.col("target_hour_utc") == instant(self._cutoff(hour)))
        own = rows.where(F.col("zone_id") == zone).agg(F.max("prediction").alias("own"))
        ahead = (F.col("prediction") > F.col("own")) | (
            (F.col("prediction") == F.col("own")) & (F.col("zone_id") < zone)
        )
        # One row is joined to each forecast of the hour, and counted.
        counted = rows.join(F.broadcast(own)).agg(
            F.max("own").alias("own"), count_where(ahead).alias("ahead")
        )
        return counted.select(
            F.lit(zone).alias("zone_id"),
            F.when(F.col("own").isNotNull(), F.col("ahead") + 1).cast("int").alias("position"),
        )

    def _history_rows(self, end: datetime, hours: int) -> DataFrame:
        if not 1 <= hours <= MAX_HISTORY_HOURS:
            raise ParameterError(f"hours must be from 1 to {MAX_HISTORY_HOURS}")
        last = self._cutoff(end)
        first = last - timedelta(hours=hours - 1)
        return self.served.where(
            F.col("target_hour_utc").between(instant(first), instant(last))
        )

    def history(self, zone_id: int, end: datetime, hours: int = 24) -> DataFrame:
        """The last hours of one zone up to and including end, in time order."""
        rows = self._history_rows(end, hours).where(F.col("zone_id") == self._zone(zone_id))
        return self._described(rows).orderBy("target_hour_utc")

    def history_mae(self, zone_id: int, end: datetime, hours: int = 24) -> DataFrame:
        """One row: points found, their range and their MAE."""
        return self.history(zone_id, end, hours).agg(
            F.count("*").alias("points"),
            F.count("absolute_error").alias("scored_points"),
            F.min("target_hour_utc").alias("start_utc"),
            F.max("target_hour_utc").alias("end_utc"),
            F.avg("absolute_error").alias("mae"),
        )

    def history_all_zones(self, end: datetime, hours: int = 24) -> DataFrame:
        """history_mae of every served zone in one aggregation."""
        return (
            self._history_rows(end, hours)
            .groupBy("zone_id")
            .agg(
                F.count("*").alias("points"),
                F.count("absolute_error").alias("scored_points"),
                F.avg("absolute_error").alias("mae"),
            )
        )


def predictions_to_serve(winner: str, model: DataFrame, baseline: DataFrame) -> DataFrame:
    """The prediction table that a serving decision names."""
    tables = {"model": model, "baseline": baseline}
    if winner not in tables:
        raise ParameterError(f"unknown predictor {winner!r}")
    return served_predictions(tables[winner])


def write_predictors(model: DataFrame, baseline: DataFrame, path: str) -> None:
    """Write two prediction tables below one path, each a partition by predictor."""
    for name, table in (("model", model), ("baseline", baseline)):
        table.write.parquet(f"{path}/predictor={name}")


def read_predictor(spark: SparkSession, path: str, predictor: str) -> DataFrame:
    return spark.read.parquet(f"{path}/predictor={predictor}")


def served_by_decision(spark: SparkSession, path: str, verdict: DataFrame) -> DataFrame:
    """Rows to serve of the predictor that the one-row verdict names, with its name.

    The verdict is evaluated first and becomes a partition filter: the files of the
    other predictor are not read.
    """
    fields = [*SERVED.fields, T.StructField("split", T.StringType())]
    schema = T.StructType([*fields, T.StructField("predictor", T.StringType())])
    winner = verdict.select("serving_winner").scalar()
    rows = spark.read.schema(schema).parquet(path).where(F.col("predictor") == winner)
    rows = rows.where((F.col("split") == "test") & F.col("prediction").isNotNull())
    return rows.select(F.col("predictor").alias("serving_winner"), *SERVED.names)
