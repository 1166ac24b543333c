"""Queries: device activity metrics and data-quality classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import devices as D
from ..operators import quality as Q
from . import fixtures as X
from .common import ntz, prepare


def _per_device(spark, sf_dir):
    return D.device_metrics(X.device_messages(prepare(spark), sf_dir))


def device_metrics(spark, sf_dir):
    return ntz(_per_device(spark, sf_dir))


def type_metrics(spark, sf_dir):
    return D.type_metrics(spark, _per_device(spark, sf_dir))


def overall_summary(spark, sf_dir):
    return D.overall_summary(spark, _per_device(spark, sf_dir))


def device_counts(spark, sf_dir):
    return D.device_counts(_per_device(spark, sf_dir))


def _wearables(spark, sf_dir):
    return Q.classify_wearables(X.health_messages(prepare(spark), sf_dir)).select("event_id", "anomaly_class")


def _gps(spark, sf_dir):
    return X.gps_fixes(prepare(spark), sf_dir).select("event_id", "vehicle_id", Q.gps_class().alias("anomaly_class"))


def _orders(spark, sf_dir):
    prepare(spark)
    return Q.classify_orders(X.order_headers(spark, sf_dir), X.order_item_rows(spark, sf_dir)).select("order_key", "anomaly_class")


def wearable_classes(spark, sf_dir):
    return _wearables(spark, sf_dir)


def gps_classes(spark, sf_dir):
    return _gps(spark, sf_dir)


def order_classes(spark, sf_dir):
    return _orders(spark, sf_dir)


def quality_report(spark, sf_dir):
    u = (
        _wearables(spark, sf_dir).select(F.lit("wearable").alias("device_type"), "anomaly_class")
        .unionByName(_gps(spark, sf_dir).select(F.lit("gps").alias("device_type"), "anomaly_class"))
        .unionByName(_orders(spark, sf_dir).select(F.lit("restaurant").alias("device_type"), "anomaly_class"))
    )
    return Q.quality_report(u)


QUERIES = {
    "device_metrics": device_metrics,
    "type_metrics": type_metrics,
    "overall_summary": overall_summary,
    "device_counts": device_counts,
    "wearable_classes": wearable_classes,
    "gps_classes": gps_classes,
    "order_classes": order_classes,
    "quality_report": quality_report,
}
