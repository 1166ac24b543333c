"""Alerts of two metrics of one user within a span of time (multi-metric alerts).

Window alerts are few (one per user, metric and window at most), so a user with a
third of all readings is small by the time alerts meet: batch alerts are joined on
(user, time bin), streamed ones by an interval join whose state the two watermarks
bound.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import DEFAULT, Options
from .timejoin import interval_join

CRITICAL, WARNING = "critical", "warning"


def side(alerts: DataFrame, prefix: str, *more: str) -> DataFrame:
    """ALERT rows of one metric under names of their own."""
    renamed = {"window_start": "window_start", "window_end": "window_end", "metric_value": "value", "severity": "severity"}
    return alerts.select("user_id", *[F.col(c).alias(f"{prefix}_{n}") for c, n in renamed.items()], *more)


def _minutes(a: str, b: str) -> Column:
    return F.floor((F.unix_seconds(F.col(b)) - F.unix_seconds(F.col(a))) / 60).cast("int")


def correlated_rows(pairs: DataFrame) -> DataFrame:
    """Joined sides → rows: critical only if both alerts are."""
    both = (F.col("hr_severity") == CRITICAL) & (F.col("bp_severity") == CRITICAL)
    return pairs.select(
        F.greatest("hr_window_end", "bp_window_end").alias("time"),
        "user_id",
        F.when(both, F.lit(CRITICAL)).otherwise(F.lit(WARNING)).alias("severity"),
        F.col("hr_window_start"),
        F.col("bp_window_start"),
        F.col("hr_value"),
        F.col("bp_value"),
        _minutes("hr_window_start", "bp_window_start").alias("bp_after_hr_minutes"),
    )


def multi_metric_alerts(hr_alerts: DataFrame, bp_alerts: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    """Pairs of a heart-rate and a blood-pressure alert of one user whose windows
    start at most ``opts.correlation_minutes`` apart."""
    lag = timedelta(minutes=opts.correlation_minutes)
    pairs = interval_join(side(hr_alerts, "hr"), side(bp_alerts, "bp"), "user_id", "hr_window_start", "bp_window_start", lag, lag)
    return correlated_rows(pairs)
