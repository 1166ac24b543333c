"""Queries over time: sessions, sliding windows, multi-metric alerts, rolling
baselines, and the joins in time."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from .. import options as O
from ..operators import alerts as A
from ..operators import anomalies as AN
from ..operators import correlate as C
from ..operators import drift as D
from ..operators import sessions as SE
from ..operators import sketches as SK
from ..operators import timejoin as TJ
from ..operators import windows as W
from ..session import checkpoint_dir
from . import fixtures as X
from .common import TABLE_OPTS, ntz, prepare
from .health import readings


def user_sessions(spark, sf_dir):
    """Each user's sessions: readings at most six hours apart."""
    return ntz(SE.user_sessions(readings(spark, sf_dir), TABLE_OPTS))


def sliding_hr_windows(spark, sf_dir):
    """Heart-rate windows of a day that start every ten hours."""
    p = W.sliding_partials(readings(spark, sf_dir), TABLE_OPTS.hr_window_minutes, TABLE_OPTS.slide_minutes, ("hr",))
    return ntz(W.hr_result(p, TABLE_OPTS).drop("alert", "type"))


def multi_metric_alerts(spark, sf_dir):
    """Heart-rate and blood-pressure alerts of a user whose days are at most one
    apart."""
    p = W.window_partials(readings(spark, sf_dir), TABLE_OPTS.hr_window_minutes, ("hr", "bp"))
    hr, bp = A.hr_alert_rows(W.hr_result(p, TABLE_OPTS)), A.bp_alert_rows(W.bp_result(p, TABLE_OPTS), TABLE_OPTS)
    return ntz(C.multi_metric_alerts(hr, bp, TABLE_OPTS))


def heart_rate_anomalies(spark, sf_dir):
    """Heart rates three standard deviations from the user's seven days before."""
    return ntz(AN.anomalies(readings(spark, sf_dir), "heart_rate", TABLE_OPTS, keep=("event_id",)))


def _fixes(spark, sf_dir):
    fixes = X.gps_fixes(prepare(spark), sf_dir)
    return fixes.select("event_id", "vehicle_id", F.regexp_replace("vehicle_id", "^VH-", "user_").alias("user_id"), "ts")


def fix_last_elevated_reading(spark, sf_dir):
    """Each GPS fix with its user's last elevated heart rate of two days before
    (-1 where there is none)."""
    high = readings(spark, sf_dir).where(F.col("heart_rate") > O.HR_THRESHOLD)
    high = high.select("user_id", F.col("ts").alias("reading_ts"), F.col("event_id").alias("reading_id"), "heart_rate")
    found = TJ.as_of_join(_fixes(spark, sf_dir), high, "user_id", "ts", "reading_ts", "reading_id", timedelta(days=2))
    age = F.floor((F.unix_micros("ts") - F.unix_micros("reading_ts")) / 1_000_000)
    none = lambda c: F.coalesce(c, F.lit(-1))
    return ntz(found.select("event_id", "vehicle_id", "ts", none(F.col("reading_id")).alias("reading_id"), none(F.col("heart_rate")).alias("heart_rate"), none(age).alias("age_seconds")))


def fixes_in_alerts(spark, sf_dir):
    """GPS fixes inside the windows (of one and of ten days) of their user's alerts."""
    alerts = A.alert_rows(readings(spark, sf_dir), TABLE_OPTS).select("user_id", "alert_type", "severity", "window_start", "window_end")
    found = TJ.range_join(_fixes(spark, sf_dir), alerts, "user_id", "ts", "window_start", "window_end")
    return ntz(found.select("event_id", "vehicle_id", "ts", "alert_type", "severity", "window_start"))


SPAN = ("2024-01-05", "2024-01-25")


def _cohort():
    """Users by the last digits of their names, in four cohorts and one for the rest."""
    return F.coalesce(F.expr("try_cast(regexp_extract(user_id, '([0-9]+)$', 1) AS INT)") % 4, F.lit(4))


def _stored_sketches(spark, sf_dir):
    """The readings' daily sketches, written by day and read back."""
    values = SK.long_values(readings(spark, sf_dir), _cohort())
    path = checkpoint_dir(spark, f"sketches-{uuid.uuid4().hex}")
    SK.daily_sketches(values).write.partitionBy("day").parquet(path)
    return values, spark.read.parquet(path)


def metric_trends(spark, sf_dir):
    """Quantiles, users and the three heaviest users per metric, cohort and week,
    with totals, merged from stored daily sketches."""
    _, stored = _stored_sketches(spark, sf_dir)
    found = SK.trends(stored, *SPAN)
    estimates = [SK.quantile(q).alias(f"p{int(q * 100)}") for q in (0.05, 0.5, 0.95)]
    return found.select("metric", "cohort", "week", "readings", *estimates, SK.distinct_users().alias("users"), SK.heavy_users(3).alias("heavy_users"))


def metric_trends_check(spark, sf_dir):
    """The same trends held against exact figures of the readings: whether each
    quantile's rank and each number of users is within the sketches' error."""
    values, stored = _stored_sketches(spark, sf_dir)
    found = SK.trends(stored, *SPAN).select("metric", "cohort", "week", "readings", SK.quantile(0.5).alias("p50"), SK.quantile(0.95).alias("p95"), SK.distinct_users().alias("users"))
    day = (F.col("day") >= F.lit(SPAN[0]).cast("date")) & (F.col("day") < F.lit(SPAN[1]).cast("date"))
    week = F.to_date(F.date_trunc("week", F.col("day"))).alias("week")
    exact = values.where(day).select("metric", "cohort", week, "value", "user_id")
    key = [F.col("metric"), F.coalesce("cohort", F.lit(-1)).alias("cohort"), F.coalesce(F.col("week").cast("string"), F.lit("all")).alias("week")]
    # exact histograms of the values add up, so no group's readings meet in one task
    counts = exact.groupBy("metric", "cohort", "week", "value").count().cube("metric", "cohort", "week", "value").agg(F.sum("count").alias("n"))
    counts = counts.where("metric IS NOT NULL AND value IS NOT NULL").select(*key, "value", "n")
    own = exact.groupBy("metric", "cohort", "week", "user_id").count().cube("metric", "cohort", "week").agg(F.count_distinct("user_id").alias("exact_users"))
    found = found.select(*key, "readings", "p50", "p95", "users").join(own.where("metric IS NOT NULL").select(*key, "exact_users"), ["metric", "cohort", "week"])
    share = lambda p, at: F.sum(F.when(F.col("value") < F.col(p) if at == "<" else F.col("value") <= F.col(p), F.col("n")).otherwise(0)) / F.first("readings")
    within = lambda p, q: ((share(p, "<") <= q + SK.RANK_ERROR) & (share(p, "<=") >= q - SK.RANK_ERROR)).alias(f"{p}_within")
    near = F.abs(F.first("users") - F.first("exact_users")) <= F.greatest(F.lit(1.0), F.first("exact_users") * 0.05)
    joined = found.join(counts, ["metric", "cohort", "week"])
    return joined.groupBy("metric", "cohort", "week").agg(F.first("readings").alias("readings"), within("p50", 0.5), within("p95", 0.95), near.alias("users_within"))


def distribution_drift(spark, sf_dir):
    """How the metrics of wearables and GPS devices differ between two spans."""
    wearables = D.metric_rows(readings(spark, sf_dir), "wearable", "ts", ("heart_rate", "bp_systolic", "blood_sugar"))
    gps = D.metric_rows(X.gps_fixes(prepare(spark), sf_dir), "gps", "ts", ("speed_kmh", "heading", "altitude"))
    histograms = D.daily_histograms(wearables.unionByName(gps))
    return D.drift(histograms, ("2024-01-01", "2024-01-15"), ("2024-01-15", "2024-01-31"))


QUERIES = {
    "distribution_drift": distribution_drift,
    "metric_trends": metric_trends,
    "metric_trends_check": metric_trends_check,
    "user_sessions": user_sessions,
    "sliding_hr_windows": sliding_hr_windows,
    "multi_metric_alerts": multi_metric_alerts,
    "heart_rate_anomalies": heart_rate_anomalies,
    "fix_last_elevated_reading": fix_last_elevated_reading,
    "fixes_in_alerts": fixes_in_alerts,
}
