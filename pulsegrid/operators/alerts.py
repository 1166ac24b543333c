"""Window results → unified METRIC and ALERT rows, and their routing.

METRIC rows: ``time`` is the window end. Blood pressure stores the mean
systolic as ``avg_value`` and ``max_value`` and the mean diastolic as
``min_value``. ALERT rows: blood pressure stores the systolic mean as
``metric_value``; its ``threshold_value`` is 0 in ``stream`` mode and the
systolic threshold in ``standalone`` mode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import options as O
from ..options import DEFAULT, Options
from . import windows as W


def _metric(df: DataFrame, metric_type: str, avg: str, mn: str, mx: str) -> DataFrame:
    return df.select(
        F.col("window_end").alias("time"),
        "user_id",
        F.lit(metric_type).alias("metric_type"),
        "window_start",
        "window_end",
        F.col(avg).cast("double").alias("avg_value"),
        F.col(mn).cast("double").alias("min_value"),
        F.col(mx).cast("double").alias("max_value"),
        F.col("reading_count").cast("long").alias("reading_count"),
    )


def hr_metric_rows(hr: DataFrame) -> DataFrame:
    return _metric(hr, O.METRIC_HR, "avg_heart_rate", "min_heart_rate", "max_heart_rate")


def bp_metric_rows(bp: DataFrame) -> DataFrame:
    return _metric(bp, O.METRIC_BP, "avg_bp_systolic", "avg_bp_diastolic", "avg_bp_systolic")


def sugar_metric_rows(su: DataFrame) -> DataFrame:
    return _metric(su, O.METRIC_SUGAR, "avg_blood_sugar", "min_blood_sugar", "max_blood_sugar")


def _alert(df: DataFrame, value, threshold, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.filter(F.col("alert").isNotNull()).select(
        F.col("window_end").alias("time"),
        "user_id",
        F.col("alert.type").alias("alert_type"),
        F.col("alert.severity").alias("severity"),
        value.cast("double").alias("metric_value"),
        threshold.cast("double").alias("threshold_value"),
        "window_start",
        "window_end",
        *keep,
    )


def hr_alert_rows(hr: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _alert(hr, F.col("alert.value"), F.col("alert.threshold"), keep)


def bp_alert_rows(bp: DataFrame, opts: Options = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    thr = F.lit(opts.bp_systolic_threshold) if opts.bp_threshold_mode == "standalone" else F.lit(0)
    return _alert(bp, F.col("alert.systolic"), thr, keep)


def sugar_alert_rows(su: DataFrame) -> DataFrame:
    return _alert(su, F.col("alert.value"), F.col("alert.threshold"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Fan-in of several result streams (UNION ALL by name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def metric_rows(readings: DataFrame, opts: Options = DEFAULT, tables: tuple[str, ...] = ("1min", "10min")) -> dict[str, DataFrame]:
    """METRIC rows per target table: ``1min`` (HR + BP) and ``10min`` (sugar).

    Routing follows the window width of each metric's table: HR and BP go
    to the short table, sugar to the long one. When one table is asked for,
    only its metrics are aggregated (one pass, one exchange); both tables
    come from one pass with the long windows rolled up.
    """
    if tuple(tables) == ("1min",) and opts.hr_window_minutes == opts.bp_window_minutes:
        p = W.window_partials(readings, opts.hr_window_minutes, ("hr", "bp"))
        res = {"hr": W.hr_result(p, opts), "bp": W.bp_result(p, opts)}
    elif tuple(tables) == ("10min",):
        res = {"sugar": W.blood_sugar_windows(readings, opts)}
    else:
        res = W.all_windows(readings, opts)
    out = {}
    if "1min" in tables:
        out["1min"] = hr_metric_rows(res["hr"]).unionByName(bp_metric_rows(res["bp"]))
    if "10min" in tables:
        out["10min"] = sugar_metric_rows(res["sugar"])
    return out


def alert_rows(readings: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    res = W.all_windows(readings, opts)
    return union_all([hr_alert_rows(res["hr"]), bp_alert_rows(res["bp"], opts), sugar_alert_rows(res["sugar"])])


def route_results(results: DataFrame) -> dict[str, DataFrame]:
    """Route unified METRIC rows by ``metric_type``; unknown types are counted, not stored."""
    short = results.filter(F.col("metric_type").isin(O.METRIC_HR, O.METRIC_BP))
    long_ = results.filter(F.col("metric_type") == O.METRIC_SUGAR)
    known = F.col("metric_type").isin(O.METRIC_HR, O.METRIC_BP, O.METRIC_SUGAR)
    unknown = results.filter(~F.coalesce(known, F.lit(False)))
    return {"1min": short, "10min": long_, "unknown": unknown}


def counters(readings: DataFrame, alerts: DataFrame) -> DataFrame:
    """Messages processed and alerts generated, as one row from one aggregate."""
    tagged = readings.select(F.lit(1).alias("_m"), F.lit(0).alias("_a")).unionByName(
        alerts.select(F.lit(0).alias("_m"), F.lit(1).alias("_a"))
    )
    return tagged.agg(
        F.sum("_m").cast("long").alias("messages_processed"),
        F.sum("_a").cast("long").alias("alerts_generated"),
    )
