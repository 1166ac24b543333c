"""Job options: one frozen dataclass handed to every operator.

Values that must equal the source system's for identical results are
collected here, in natural order, as fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values (must match the original system's behaviour exactly)
# ---------------------------------------------------------------------------
# Window widths in minutes: heart rate, blood pressure, blood sugar.
HR_WINDOW_MINUTES = 1
BP_WINDOW_MINUTES = 1
SUGAR_WINDOW_MINUTES = 10
# Alert thresholds: heart rate (strict >), systolic, diastolic, sugar (>=).
HR_THRESHOLD = 100
BP_SYSTOLIC_THRESHOLD = 140
BP_DIASTOLIC_THRESHOLD = 90
SUGAR_THRESHOLD = 180
# Severity cut-offs: below is "warning", at or above is "critical".
HR_CRITICAL = 120
BP_SYSTOLIC_CRITICAL = 160
SUGAR_CRITICAL = 250
# Alert type names.
ALERT_HR = "elevated_heart_rate"
ALERT_BP = "elevated_blood_pressure"
ALERT_SUGAR = "elevated_blood_sugar"
# Metric type names as stored in the metric tables.
METRIC_HR = "heart_rate"
METRIC_BP = "blood_pressure"
METRIC_SUGAR = "blood_sugar"
# Window-result type tags.
RESULT_HR = "heart_rate_1min"
RESULT_BP = "blood_pressure_1min"
RESULT_SUGAR = "blood_sugar_10min"
# Kafka topics per device class and the fallback pattern for unknown classes.
TOPIC_WEARABLES = "virtual-wearables"
TOPIC_RESTAURANTS = "virtual-restaurants"
TOPIC_GPS = "virtual-gps"
TOPIC_FALLBACK_PREFIX = "virtual-"
# Device types, always all reported even when empty.
DEVICE_TYPES = ("wearable", "restaurant", "gps")
# Ingestion protocol tag written on every enriched message.
INGESTION_PROTOCOL = "kafka"
# Raw topic tables that may be browsed.
RAW_TABLES = ("virtual_wearables", "virtual_restaurants", "virtual_gps")
# Browse limits: default page size, maximum page size; ad-hoc query default limit.
BROWSE_DEFAULT_LIMIT = 50
BROWSE_MAX_LIMIT = 1000
QUERY_DEFAULT_LIMIT = 100
# Keywords the ad-hoc SELECT guard refuses (substring match in compat mode).
FORBIDDEN_KEYWORDS = ("DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "TRUNCATE", "CREATE")
# Consumer groups of the health and the ingestion job.
HEALTH_GROUP = "flink-health-processor"
INGEST_GROUP = "data-pipeline"
# Flush interval of the ingestion writer.
FLUSH_INTERVAL_SECONDS = 5
# Order life cycle: statuses and allowed transitions (CANCELLED is declared but
# never produced by a valid flow).
ORDER_STATUSES = (
    "ORDER_PLACED",
    "ORDER_UPDATED",
    "ORDER_COMPLETED",
    "PAYMENT_PENDING",
    "PAYMENT_COMPLETED",
    "CANCELLED",
)
ORDER_TRANSITIONS = (
    ("ORDER_PLACED", "ORDER_UPDATED"),
    ("ORDER_PLACED", "ORDER_COMPLETED"),
    ("ORDER_UPDATED", "ORDER_COMPLETED"),
    ("ORDER_COMPLETED", "PAYMENT_PENDING"),
    ("PAYMENT_PENDING", "PAYMENT_COMPLETED"),
)
# Valid dish codes: D101 .. D150.
DISH_CODE_FIRST = 101
DISH_CODE_LAST = 150
# Wearable "extreme" cut-offs (lower ends of the generator's extreme ranges).
EXTREME_SYSTOLIC = 300
EXTREME_DIASTOLIC = 200
EXTREME_SUGAR = 500
EXTREME_HEART_RATE = 250
# GPS "extreme speed" cut-off in km/h and heading upper bound in degrees.
EXTREME_SPEED_KMH = 500
MAX_HEADING = 360
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Options:
    """Every tunable of the engine; pass a modified copy with ``with_``."""

    hr_window_minutes: int = HR_WINDOW_MINUTES
    bp_window_minutes: int = BP_WINDOW_MINUTES
    sugar_window_minutes: int = SUGAR_WINDOW_MINUTES
    hr_threshold: int = HR_THRESHOLD
    bp_systolic_threshold: int = BP_SYSTOLIC_THRESHOLD
    bp_diastolic_threshold: int = BP_DIASTOLIC_THRESHOLD
    sugar_threshold: int = SUGAR_THRESHOLD
    hr_critical: int = HR_CRITICAL
    bp_systolic_critical: int = BP_SYSTOLIC_CRITICAL
    sugar_critical: int = SUGAR_CRITICAL
    # "record": one bad field invalidates the whole reading (stream job);
    # "metric": only the bad field is dropped (standalone processor).
    validity: str = "record"
    # "stream": BP alert threshold_value stored as 0; "standalone": systolic threshold.
    bp_threshold_mode: str = "stream"
    # "event": window on the payload timestamp; "processing": stamp arrival time.
    time_mode: str = "event"
    watermark_delay: str = "1 minute"
    # Shuffle/state partitions of a streaming query. Streaming stateful
    # operators do not use AQE, and the number is fixed in the checkpoint at
    # the first run; None keeps the session's spark.sql.shuffle.partitions.
    state_partitions: int | None = None
    topics: tuple = (TOPIC_WEARABLES, TOPIC_RESTAURANTS, TOPIC_GPS)
    kafka_bootstrap_servers: str = "localhost:9092"
    health_topic: str = TOPIC_WEARABLES
    # Prefixes of the consumer groups, one per job.
    health_group: str = HEALTH_GROUP
    ingest_group: str = INGEST_GROUP
    # Kafka offsets a micro-batch takes at most; None: all that have arrived.
    max_offsets_per_trigger: int | None = None
    flush_interval_seconds: int = FLUSH_INTERVAL_SECONDS
    # Session windows: the longest gap between two readings of a session.
    session_gap_minutes: int = 30
    # Sliding windows start this often.
    slide_minutes: int = 1
    # Multi-metric alerts: how far apart the windows of two alerts may start.
    correlation_minutes: int = 1
    # Anomalies: width and number of the baseline's buckets, the readings it needs, the limit.
    baseline_bucket_minutes: int = 60
    baseline_buckets: int = 24
    baseline_readings: int = 10
    anomaly_z: float = 3.0

    def with_(self, **kw) -> "Options":
        return replace(self, **kw)


DEFAULT = Options()
