"""Queries over the health stream: parsing, windows, alerts, metric rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import options as O
from ..operators import alerts as A
from ..operators.anchored import anchored_windows
from ..operators import windows as W
from ..operators.parse import parse_health
from . import fixtures as X
from .common import TABLE_OPTS, TABLE_OPTS_METRIC, ntz, prepare


def readings(spark: SparkSession, sf_dir: str, opts=TABLE_OPTS) -> DataFrame:
    msgs = X.health_messages(prepare(spark), sf_dir)
    return parse_health(msgs, opts, keep=("event_id",))


def parse_readings_record(spark, sf_dir):
    return ntz(readings(spark, sf_dir, TABLE_OPTS))


def parse_readings_metric(spark, sf_dir):
    return ntz(readings(spark, sf_dir, TABLE_OPTS_METRIC))


def _flat(df: DataFrame) -> DataFrame:
    return ntz(df.drop("alert", "type"))


def hr_window_metrics(spark, sf_dir):
    return _flat(W.heart_rate_windows(readings(spark, sf_dir), TABLE_OPTS))


def bp_window_metrics(spark, sf_dir):
    return _flat(W.blood_pressure_windows(readings(spark, sf_dir), TABLE_OPTS))


def sugar_window_metrics(spark, sf_dir):
    return _flat(W.blood_sugar_windows(readings(spark, sf_dir), TABLE_OPTS))


def window_results(spark, sf_dir):
    """The window results of the three metrics with their alert's type, value,
    threshold label and severity (null where a window has no alert)."""
    res = W.all_windows(readings(spark, sf_dir), TABLE_OPTS)
    label = {"hr": F.col("alert.threshold").cast("string"), "bp": F.col("alert.thresholds"), "sugar": F.col("alert.threshold").cast("string")}
    value = {"hr": "alert.value", "bp": "alert.systolic", "sugar": "alert.value"}
    shape = lambda m: res[m].select(
        "type", "window_start", "window_end", "user_id", "reading_count", F.col("alert.type").alias("alert_type"),
        F.col(value[m]).alias("alert_value"), label[m].alias("threshold"), F.col("alert.severity").alias("severity"))
    return ntz(A.union_all([shape(m) for m in ("hr", "bp", "sugar")]))


def hr_window_metrics_metric_mode(spark, sf_dir):
    """Per-metric validity: floats kept, only the bad field dropped."""
    return _flat(W.heart_rate_windows(readings(spark, sf_dir, TABLE_OPTS_METRIC), TABLE_OPTS_METRIC))


def hr_alerts(spark, sf_dir):
    return ntz(A.hr_alert_rows(W.heart_rate_windows(readings(spark, sf_dir), TABLE_OPTS)))


def bp_alerts_stream(spark, sf_dir):
    o = TABLE_OPTS.with_(bp_threshold_mode="stream")
    return ntz(A.bp_alert_rows(W.blood_pressure_windows(readings(spark, sf_dir), o), o))


def bp_alerts_standalone(spark, sf_dir):
    o = TABLE_OPTS.with_(bp_threshold_mode="standalone")
    return ntz(A.bp_alert_rows(W.blood_pressure_windows(readings(spark, sf_dir), o), o))


def sugar_alerts(spark, sf_dir):
    return ntz(A.sugar_alert_rows(W.blood_sugar_windows(readings(spark, sf_dir), TABLE_OPTS)))


def metrics_1min(spark, sf_dir):
    """Short-window METRIC table rows (HR + BP from ONE shared groupBy)."""
    return ntz(A.metric_rows(readings(spark, sf_dir), TABLE_OPTS, ("1min",))["1min"])


def metrics_10min(spark, sf_dir):
    return ntz(A.metric_rows(readings(spark, sf_dir), TABLE_OPTS, ("10min",))["10min"])


def all_alerts(spark, sf_dir):
    return ntz(A.alert_rows(readings(spark, sf_dir), TABLE_OPTS))


def health_counters(spark, sf_dir):
    r = readings(spark, sf_dir)
    return A.counters(r, A.alert_rows(r, TABLE_OPTS))


def _anchored(spark, sf_dir, key, metric):
    r = readings(spark, sf_dir, TABLE_OPTS_METRIC)
    return _flat(anchored_windows(r, TABLE_OPTS_METRIC, (metric,))[key])


def anchored_hr(spark, sf_dir):
    return _anchored(spark, sf_dir, "hr", O.METRIC_HR)


def anchored_bp(spark, sf_dir):
    return _anchored(spark, sf_dir, "bp", O.METRIC_BP)


def anchored_sugar(spark, sf_dir):
    return _anchored(spark, sf_dir, "sugar", O.METRIC_SUGAR)


def anchored_alerts(spark, sf_dir):
    """Standalone processor's alerts: anchored windows under per-metric
    validity; BP alerts store the systolic threshold."""
    o = TABLE_OPTS_METRIC.with_(bp_threshold_mode="standalone")
    res = anchored_windows(readings(spark, sf_dir, o), o)
    return ntz(A.union_all([A.hr_alert_rows(res["hr"]), A.bp_alert_rows(res["bp"], o), A.sugar_alert_rows(res["sugar"])]))


QUERIES = {
    "window_results": window_results,
    "anchored_hr": anchored_hr,
    "anchored_alerts": anchored_alerts,
    "anchored_bp": anchored_bp,
    "anchored_sugar": anchored_sugar,
    "parse_readings_record": parse_readings_record,
    "parse_readings_metric": parse_readings_metric,
    "hr_window_metrics": hr_window_metrics,
    "bp_window_metrics": bp_window_metrics,
    "sugar_window_metrics": sugar_window_metrics,
    "hr_window_metrics_metric_mode": hr_window_metrics_metric_mode,
    "hr_alerts": hr_alerts,
    "bp_alerts_stream": bp_alerts_stream,
    "bp_alerts_standalone": bp_alerts_standalone,
    "sugar_alerts": sugar_alerts,
    "metrics_1min": metrics_1min,
    "metrics_10min": metrics_10min,
    "all_alerts": all_alerts,
    "health_counters": health_counters,
}
