"""Fixed table schemas and label sets of the hourly demand tables."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "TINYINT": T.ByteType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """Schema from 'name TYPE, ...', without needing a session at import time."""
    fields = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


# Labels, in order of precedence, one per raw row.
TIME_DISPOSITIONS = (
    "null_timestamp",
    "outside_month",
    "dst_nonexistent",
    "dst_ambiguous",
)
ZONE_DISPOSITIONS = (
    "null_zone",
    "not_in_lookup",
    "non_service_zone",
    "retained",
)
DISPOSITIONS = TIME_DISPOSITIONS + ZONE_DISPOSITIONS

STATUSES = ("available", "source_missing", "dst_ambiguous")
SPLIT_NAMES = ("train", "validation", "test")
FALLBACK_SOURCES = ("prior_zone_mean", "train_zone_mean")
FIT_SCOPES = {"validation": "train", "test": "train_validation"}

KEY = ("zone_id", "target_hour_utc")

LOOKUP = _struct("zone_id INT, borough STRING, zone_name STRING, service_zone STRING")
LOOKUP_CSV = _struct("LocationID BIGINT, Borough STRING, Zone STRING, service_zone STRING")

OBSERVED = _struct(
    "zone_id INT, target_hour_utc TIMESTAMP, trip_count BIGINT, source_month STRING"
)
GRID = _struct(
    "zone_id INT, target_hour_utc TIMESTAMP, trip_count BIGINT, "
    "source_month STRING, source_status STRING"
)
BASELINE_PREDICTIONS = _struct(
    "zone_id INT, target_hour_utc TIMESTAMP, split STRING, actual_trip_count BIGINT, "
    "source_status STRING, seasonal_lag_trip_count BIGINT, prediction DOUBLE, "
    "prediction_source STRING, used_fallback BOOLEAN, absolute_error DOUBLE"
)
FEATURES = _struct(
    "zone_id INT, target_hour_utc TIMESTAMP, split STRING, target_trip_count BIGINT, "
    "source_status STRING, utc_hour TINYINT, utc_day_of_week TINYINT, "
    "utc_month TINYINT, is_weekend BOOLEAN, lag_1h BIGINT, lag_24h BIGINT, "
    "lag_168h BIGINT, rolling_mean_24h DOUBLE, rolling_mean_168h DOUBLE, "
    "features_complete BOOLEAN"
)
MODEL_PREDICTIONS = _struct(
    "zone_id INT, target_hour_utc TIMESTAMP, split STRING, actual_trip_count BIGINT, "
    "prediction_raw DOUBLE, prediction DOUBLE, absolute_error DOUBLE, "
    "candidate_name STRING, fit_scope STRING"
)
SERVED_FIELDS = _struct(
    "zone_id INT, target_hour_utc TIMESTAMP, split STRING, actual_trip_count BIGINT, "
    "prediction DOUBLE, absolute_error DOUBLE"
)

NUMERIC_FEATURES = (
    "utc_hour",
    "utc_day_of_week",
    "utc_month",
    "is_weekend",
    "lag_1h",
    "lag_24h",
    "lag_168h",
    "rolling_mean_24h",
    "rolling_mean_168h",
)
HISTORY_FEATURES = NUMERIC_FEATURES[4:]
