"""Device activity metrics: per device, per device type, overall, counts.

Every roll-up is computed from the per-device partial aggregate, so the
second level works on one row per device, never on raw messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import options as O
from ..functions.rounding import round_half_even


def rate(bad: Column, total: Column) -> Column:
    """``round(bad / max(total, 1) * 100, 2)`` with half-even rounding on the
    binary value (as Python's ``round``)."""
    r = bad.cast("double") / F.greatest(total, F.lit(1)).cast("double") * 100
    return round_half_even(r, 2)


def device_metrics(msgs: DataFrame) -> DataFrame:
    """``(device_id, device_type, is_anomaly, sent_at)`` → one row per device."""
    return msgs.groupBy("device_id", "device_type").agg(
        F.count(F.lit(1)).alias("data_points_sent"),
        F.count_if(F.col("is_anomaly")).alias("bad_data_points"),
        F.max("sent_at").alias("last_sent_at"),
        F.min("sent_at").alias("started_at"),
    )


def _types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in O.DEVICE_TYPES], "device_type string")


def type_metrics(spark: SparkSession, per_device: DataFrame) -> DataFrame:
    """Per device type (all known types, zero-filled): active devices, data
    points, bad data points, bad-data rate in percent."""
    agg = per_device.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("active_devices"),
        F.sum("data_points_sent").alias("total_data_points"),
        F.sum("bad_data_points").alias("total_bad_data_points"),
    )
    j = _types(spark).join(agg, "device_type", "full")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return j.select(
        "device_type",
        n("active_devices").alias("active_devices"),
        n("total_data_points").alias("total_data_points"),
        n("total_bad_data_points").alias("total_bad_data_points"),
        rate(n("total_bad_data_points"), n("total_data_points")).alias("bad_data_rate"),
    )


def overall_summary(spark: SparkSession, per_device: DataFrame) -> DataFrame:
    """Per-type rows plus a total row (``device_type = 'all'``) via ROLLUP."""
    t = type_metrics(spark, per_device)
    r = t.rollup("device_type").agg(
        F.sum("active_devices").cast("long").alias("active_devices"),
        F.sum("total_data_points").cast("long").alias("total_data_points"),
        F.sum("total_bad_data_points").cast("long").alias("total_bad_data_points"),
    )
    return r.select(
        F.coalesce("device_type", F.lit("all")).alias("device_type"),
        "active_devices",
        "total_data_points",
        "total_bad_data_points",
        rate(F.col("total_bad_data_points"), F.col("total_data_points")).alias("bad_data_rate"),
    )


def device_counts(per_device: DataFrame) -> DataFrame:
    """Devices per type (types seen only) and a total row."""
    r = per_device.rollup("device_type").agg(F.count(F.lit(1)).alias("devices"))
    return r.select(F.coalesce("device_type", F.lit("all")).alias("device_type"), "devices")
