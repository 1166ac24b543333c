"""Canonical StructTypes of the engine's tables and intermediate frames."""

from __future__ import annotations

from pyspark.sql import types as T

READING = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("heart_rate", T.IntegerType()),
        T.StructField("bp_systolic", T.IntegerType()),
        T.StructField("bp_diastolic", T.IntegerType()),
        T.StructField("blood_sugar", T.IntegerType()),
        T.StructField("valid", T.IntegerType()),
    ]
)

# Per-metric validity keeps floats and uses NULL for a dropped field.
READING_METRIC = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("heart_rate", T.DoubleType()),
        T.StructField("bp_systolic", T.DoubleType()),
        T.StructField("bp_diastolic", T.DoubleType()),
        T.StructField("blood_sugar", T.DoubleType()),
    ]
)

METRIC = T.StructType(
    [
        T.StructField("time", T.TimestampType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("metric_type", T.StringType(), False),
        T.StructField("window_start", T.TimestampType(), False),
        T.StructField("window_end", T.TimestampType(), False),
        T.StructField("avg_value", T.DoubleType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("reading_count", T.LongType()),
    ]
)
METRIC_KEY = ("window_start", "user_id", "metric_type")

ALERT = T.StructType(
    [
        T.StructField("time", T.TimestampType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("alert_type", T.StringType(), False),
        T.StructField("severity", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("threshold_value", T.DoubleType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
    ]
)
# The source tables have no key on alerts; this one makes replays idempotent.
ALERT_KEY = ("window_start", "user_id", "alert_type")

# A user's sessions; a session is named by its first reading.
SESSION = T.StructType(
    [
        T.StructField("time", T.TimestampType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("session_start", T.TimestampType(), False),
        T.StructField("session_end", T.TimestampType(), False),
        T.StructField("reading_count", T.LongType()),
        T.StructField("avg_heart_rate", T.DoubleType()),
        T.StructField("min_heart_rate", T.DoubleType()),
        T.StructField("max_heart_rate", T.DoubleType()),
    ]
)
SESSION_KEY = ("session_start", "user_id")

# Alerts of two metrics of a user close in time.
CORRELATED = T.StructType(
    [
        T.StructField("time", T.TimestampType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("severity", T.StringType()),
        T.StructField("hr_window_start", T.TimestampType(), False),
        T.StructField("bp_window_start", T.TimestampType(), False),
        T.StructField("hr_value", T.DoubleType()),
        T.StructField("bp_value", T.DoubleType()),
        T.StructField("bp_after_hr_minutes", T.IntegerType()),
    ]
)
CORRELATED_KEY = ("hr_window_start", "bp_window_start", "user_id")

ALERT_STRUCT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("systolic", T.DoubleType()),
        T.StructField("diastolic", T.DoubleType()),
        T.StructField("threshold", T.StringType()),
        T.StructField("severity", T.StringType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("ingestion_protocol", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("raw_data", T.StringType()),
    ]
)

RAW_TABLE = T.StructType([T.StructField("device_id", T.StringType(), False)] + ENVELOPE.fields)

# Raw message as read from a stream or file: JSON text plus optional record time.
MESSAGE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.StringType()),
    ]
)
