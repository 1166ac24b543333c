"""Epoch-aligned tumbling windows per user with threshold alerts.

All aggregates are algebraic (count, exact decimal sum, min, max) so Spark plans a
partial aggregate before the exchange: a hot user is reduced map-side to one
row per (map task, window) before anything is shuffled. Averages and the
alert decision use the unrounded mean; the stored value is rounded last with
half-even rounding on the binary value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import options as O
from ..functions.fence import fence
from ..functions.rounding import round_half_even
from ..options import DEFAULT, Options


def _minutes(n: int) -> str:
    return f"{int(n)} minutes"


def _severity(avg: Column, critical: int) -> Column:
    return F.when(avg < F.lit(critical), F.lit("warning")).otherwise(F.lit("critical"))


NEAR = 1e18  # readings below are summed as DECIMAL, readings from here on as DOUBLE


def near_sum(x: Column) -> Column:
    """Sum of the readings below ``NEAR`` as DECIMAL(38, 9). Decimal sums do
    not depend on the order rows meet in partial aggregates, so results do
    not change with partitioning (a float sum can, in its last bit)."""
    d = x.cast("double")
    return F.sum(F.when(F.abs(d) < NEAR, d).cast("decimal(28,9)"))


def far_sum(x: Column) -> Column:
    """Sum of the readings from ``NEAR`` on, which no sum can overflow (it
    may become infinite)."""
    d = x.cast("double")
    return F.sum(F.when(F.abs(d) >= NEAR, d))


def mean(near: Column, far: Column, n: Column) -> Column:
    """Mean from the two sums, in double arithmetic (null of no readings)."""
    zero = F.lit(0.0)
    return F.when(n > 0, (F.coalesce(near.cast("double"), zero) + F.coalesce(far, zero)) / n.cast("double"))


def _r2(c: Column) -> Column:
    """Round half-even to 2 dp on the binary value (as Python's ``round``)."""
    return round_half_even(c, 2)


# ---------------------------------------------------------------------------
# aggregate specs: conditional aggregates so that several metrics with the
# same window width share ONE groupBy (one exchange)
# ---------------------------------------------------------------------------


def _hr_aggs() -> list[Column]:
    ok = F.col("heart_rate") > 0
    hr = F.when(ok, F.col("heart_rate"))
    return [
        F.count(hr).alias("_hr_n"),
        near_sum(hr).alias("_hr_sum"),
        far_sum(hr).alias("_hr_far"),
        F.min(hr).alias("_hr_min"),
        F.max(hr).alias("_hr_max"),
    ]


def _bp_aggs() -> list[Column]:
    ok = (F.col("bp_systolic") > 0) & (F.col("bp_diastolic") > 0)
    sys_, dia = F.when(ok, F.col("bp_systolic")), F.when(ok, F.col("bp_diastolic"))
    return [
        F.count(F.when(ok, F.lit(1))).alias("_bp_n"),
        near_sum(sys_).alias("_bp_sys_sum"),
        far_sum(sys_).alias("_bp_sys_far"),
        near_sum(dia).alias("_bp_dia_sum"),
        far_sum(dia).alias("_bp_dia_far"),
    ]


def _sugar_aggs() -> list[Column]:
    ok = F.col("blood_sugar") > 0
    s = F.when(ok, F.col("blood_sugar"))
    return [
        F.count(s).alias("_su_n"),
        near_sum(s).alias("_su_sum"),
        far_sum(s).alias("_su_far"),
        F.min(s).alias("_su_min"),
        F.max(s).alias("_su_max"),
    ]


_AGGS = {"hr": _hr_aggs, "bp": _bp_aggs, "sugar": _sugar_aggs}
_FILTERS = {
    "hr": lambda: F.col("heart_rate") > 0,
    "bp": lambda: (F.col("bp_systolic") > 0) & (F.col("bp_diastolic") > 0),
    "sugar": lambda: F.col("blood_sugar") > 0,
}


def window_partials(readings: DataFrame, minutes: int, metrics: tuple[str, ...], event_time: str | None = None) -> DataFrame:
    """One groupBy(user_id, window) computing every metric in ``metrics``.

    Rows that cannot feed any of the metrics are filtered before the
    exchange (an empty window emits nothing). ``event_time`` names a column
    that carries a stream's watermark on to a next stateful operator.
    """
    times = [F.window_time("w").alias(event_time)] if event_time else []
    keep = None
    for m in metrics:
        f = _FILTERS[m]()
        keep = f if keep is None else (keep | f)
    aggs = [a for m in metrics for a in _AGGS[m]()]
    w = F.window("ts", _minutes(minutes))
    return (
        readings.filter(keep & F.col("user_id").isNotNull())
        .groupBy("user_id", w.alias("w"))
        .agg(*aggs)
        .select("user_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *times, *_agg_names(metrics))
        .select("*", *[e.alias(n) for n, e in _means(metrics)])
    )


def _means(metrics):
    out = []
    if "hr" in metrics:
        out.append(("_hr_avg", mean(F.col("_hr_sum"), F.col("_hr_far"), F.col("_hr_n"))))
    if "bp" in metrics:
        out.append(("_bp_sys", mean(F.col("_bp_sys_sum"), F.col("_bp_sys_far"), F.col("_bp_n"))))
        out.append(("_bp_dia", mean(F.col("_bp_dia_sum"), F.col("_bp_dia_far"), F.col("_bp_n"))))
    if "sugar" in metrics:
        out.append(("_su_avg", mean(F.col("_su_sum"), F.col("_su_far"), F.col("_su_n"))))
    return out


def _agg_names(metrics):
    names = {
        "hr": ["_hr_n", "_hr_sum", "_hr_far", "_hr_min", "_hr_max"],
        "bp": ["_bp_n", "_bp_sys_sum", "_bp_sys_far", "_bp_dia_sum", "_bp_dia_far"],
        "sugar": ["_su_n", "_su_sum", "_su_far", "_su_min", "_su_max"],
    }
    return [n for m in metrics for n in names[m]]


# ---------------------------------------------------------------------------
# per-metric window results (the "window result" shape of the source job)
# ---------------------------------------------------------------------------


def _hr_alert(avg: Column, opts: Options) -> Column:
    return F.when(
        avg > F.lit(opts.hr_threshold),
        F.struct(
            F.lit(O.ALERT_HR).alias("type"),
            _r2(avg).alias("value"),
            F.lit(opts.hr_threshold).alias("threshold"),
            _severity(avg, opts.hr_critical).alias("severity"),
        ),
    )


def _bp_alert(sys_: Column, dia: Column, opts: Options) -> Column:
    return F.when(
        (sys_ >= F.lit(opts.bp_systolic_threshold)) | (dia >= F.lit(opts.bp_diastolic_threshold)),
        F.struct(
            F.lit(O.ALERT_BP).alias("type"),
            _r2(sys_).alias("systolic"),
            _r2(dia).alias("diastolic"),
            F.lit(f"{opts.bp_systolic_threshold}/{opts.bp_diastolic_threshold}").alias("thresholds"),
            # severity looks at systolic only
            _severity(sys_, opts.bp_systolic_critical).alias("severity"),
        ),
    )


def _sugar_alert(avg: Column, opts: Options) -> Column:
    return F.when(
        avg >= F.lit(opts.sugar_threshold),
        F.struct(
            F.lit(O.ALERT_SUGAR).alias("type"),
            _r2(avg).alias("value"),
            F.lit(opts.sugar_threshold).alias("threshold"),
            _severity(avg, opts.sugar_critical).alias("severity"),
        ),
    )


def hr_result(partials: DataFrame, opts: Options = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """Window partials → heart-rate window result (one row per non-empty window);
    ``keep`` lists columns carried through."""
    return partials.filter(F.col("_hr_n") > 0).select(
        F.lit(O.RESULT_HR).alias("type"),
        "window_start",
        "window_end",
        "user_id",
        _r2(F.col("_hr_avg")).alias("avg_heart_rate"),
        F.col("_hr_min").alias("min_heart_rate"),
        F.col("_hr_max").alias("max_heart_rate"),
        F.col("_hr_n").alias("reading_count"),
        _hr_alert(F.col("_hr_avg"), opts).alias("alert"),
        *keep,
    )


def bp_result(partials: DataFrame, opts: Options = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    return partials.filter(F.col("_bp_n") > 0).select(
        F.lit(O.RESULT_BP).alias("type"),
        "window_start",
        "window_end",
        "user_id",
        _r2(F.col("_bp_sys")).alias("avg_bp_systolic"),
        _r2(F.col("_bp_dia")).alias("avg_bp_diastolic"),
        F.col("_bp_n").alias("reading_count"),
        _bp_alert(F.col("_bp_sys"), F.col("_bp_dia"), opts).alias("alert"),
        *keep,
    )


def sugar_result(partials: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    return partials.filter(F.col("_su_n") > 0).select(
        F.lit(O.RESULT_SUGAR).alias("type"),
        "window_start",
        "window_end",
        "user_id",
        _r2(F.col("_su_avg")).alias("avg_blood_sugar"),
        F.col("_su_min").alias("min_blood_sugar"),
        F.col("_su_max").alias("max_blood_sugar"),
        F.col("_su_n").alias("reading_count"),
        _sugar_alert(F.col("_su_avg"), opts).alias("alert"),
    )


def heart_rate_windows(readings: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    return hr_result(window_partials(readings, opts.hr_window_minutes, ("hr",)), opts)


def blood_pressure_windows(readings: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    return bp_result(window_partials(readings, opts.bp_window_minutes, ("bp",)), opts)


def blood_sugar_windows(readings: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    return sugar_result(window_partials(readings, opts.sugar_window_minutes, ("sugar",)), opts)


def rollup_partials(partials: DataFrame, minutes: int, metrics: tuple[str, ...]) -> DataFrame:
    """Merge finer window partials into ``minutes``-wide epoch-aligned windows.

    Exact when ``minutes`` is a multiple of the finer width: every fine
    window lies inside one coarse window, and count / sum / min / max merge.
    """
    w = F.window("window_start", _minutes(minutes))
    return (
        partials.groupBy("user_id", w.alias("w"))
        .agg(*_merge_aggs(metrics))
        .select("user_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *_agg_names(metrics))
        .select("*", *[e.alias(n) for n, e in _means(metrics)])
    )


def _merge_aggs(metrics: tuple[str, ...]) -> list[Column]:
    """Aggregates that merge window partials."""
    aggs = []
    for n in _agg_names(metrics):
        if n.endswith("_min"):
            aggs.append(F.min(n).alias(n))
        elif n.endswith("_max"):
            aggs.append(F.max(n).alias(n))
        else:
            total = F.sum(n)
            aggs.append((total.cast("decimal(38,9)") if n.endswith("_sum") else total).alias(n))
    return aggs


def sliding_partials(readings: DataFrame, minutes: int, slide: int, metrics: tuple[str, ...]) -> DataFrame:
    """Partials of ``minutes``-wide windows that start every ``slide`` minutes.

    A reading lies in up to width / slide windows. Readings are not copied to
    them: they are first reduced to panes of the greatest width that divides
    both, and only the panes are (a row per user and pane, whatever the number
    of readings). A slide above the width leaves gaps between windows."""
    pane = math.gcd(minutes, slide)
    at = F.unix_seconds("window_start")  # panes and windows start at whole minutes
    first, last = F.floor((at - minutes * 60) / (slide * 60)) + 1, F.floor(at / (slide * 60))
    panes = window_partials(readings, pane, metrics).withColumn("w", F.explode(F.when(first <= last, F.sequence(first, last))))
    rows = panes.groupBy("user_id", "w").agg(*_merge_aggs(metrics))
    start = F.col("w") * (slide * 60)
    bounds = [F.timestamp_seconds(start).alias("window_start"), F.timestamp_seconds(start + minutes * 60).alias("window_end")]
    return rows.select("user_id", *bounds, *_agg_names(metrics)).select("*", *[e.alias(n) for n, e in _means(metrics)])


def all_windows(readings: DataFrame, opts: Options = DEFAULT) -> dict[str, DataFrame]:
    """Window results of the three metrics from ONE pass over the readings.

    Metrics of the finest width share one ``groupBy``; a coarser width that
    is a multiple of it is rolled up from those partials (a second, small
    exchange over pre-aggregated rows) instead of re-reading and re-parsing
    the input. Other widths get their own pass.
    """
    widths = {"hr": opts.hr_window_minutes, "bp": opts.bp_window_minutes, "sugar": opts.sugar_window_minutes}
    base_w = min(widths.values())
    builders = {"hr": hr_result, "bp": bp_result, "sugar": sugar_result}
    derivable = tuple(m for m, w in widths.items() if w % base_w == 0)
    # Fenced: per-branch column pruning would otherwise trim the shared
    # aggregate differently in each consumer, defeating exchange reuse and
    # re-reading the input once per consumer.
    base = fence(window_partials(readings, base_w, derivable))
    out = {}
    for m, w in widths.items():
        if w == base_w:
            p = base
        elif m in derivable:
            p = rollup_partials(base, w, (m,))
        else:
            p = window_partials(readings, w, (m,))
        out[m] = builders[m](p, opts)
    return out
