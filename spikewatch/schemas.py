"""Fixed record schemas and status values."""

from __future__ import annotations

from pyspark.sql import types as T

INITIALIZING = "INITIALIZING"
NORMAL = "NORMAL"
SURGE_ALERT = "SURGE_ALERT"

RIDE_REQUEST = T.StructType(
    [
        T.StructField("ride_id", T.StringType()),
        T.StructField("zone_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("event_time_millis", T.LongType()),
        T.StructField("is_simulated_late", T.BooleanType()),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("zone", T.StringType()),
        T.StructField("request_count", T.LongType()),
        T.StructField("ema_baseline", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)

# What a late request's line shows.
LATE_REQUEST = T.StructType([f for f in RIDE_REQUEST.fields if f.name != "event_time_millis"])

SCHEDULE = T.StructType(
    [
        T.StructField("zone", T.StringType()),
        T.StructField("start_s", T.LongType()),
        T.StructField("end_s", T.LongType()),
        T.StructField("extra", T.LongType()),
    ]
)
