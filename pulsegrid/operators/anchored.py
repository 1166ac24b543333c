"""First-reading-anchored tumbling windows (the standalone processor's windows).

Per (user, metric) the first valid reading opens a window that starts at
the minute of that reading and lasts a fixed number of minutes; readings
before its end join it; the first reading at or after the end opens the next
window at its own minute. This fold is order dependent, so it cannot be a
plain ``groupBy``. Plan:

1. unpivot readings into ``(user_id, metric, v1, v2)`` rows;
2. ``groupBy(user_id, metric, minute)`` — algebraic partials, combined
   map-side, so even a hot user is at most one row per minute after the
   first exchange;
3. ``groupBy(user_id, metric).applyInArrow`` folds the sorted minute
   partials. Window starts and lengths are whole minutes, so a minute never
   straddles two windows and the fold over minute partials is exact. Its
   input per group is bounded by the number of distinct minutes in the time
   span, not by the number of readings.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import options as O
from ..options import DEFAULT, Options
from .windows import _bp_alert, _hr_alert, _r2, _sugar_alert, far_sum, mean, near_sum

MINUTE_US = 60_000_000

PARTIAL_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("window_start_us", T.LongType()),
        T.StructField("window_end_us", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("s1", T.DecimalType(38, 9)),
        T.StructField("f1", T.DoubleType()),
        T.StructField("s2", T.DecimalType(38, 9)),
        T.StructField("f2", T.DoubleType()),
        T.StructField("mn", T.DoubleType()),
        T.StructField("mx", T.DoubleType()),
    ]
)


def unpivot(readings: DataFrame) -> DataFrame:
    """Readings (metric-mode: NULL = dropped) → one row per (reading, metric)."""
    hr = F.struct(F.lit(O.METRIC_HR).alias("metric"), F.col("heart_rate").cast("double").alias("v1"), F.lit(None).cast("double").alias("v2"))
    bp = F.struct(
        F.lit(O.METRIC_BP).alias("metric"),
        F.when(F.col("bp_diastolic") > 0, F.col("bp_systolic")).cast("double").alias("v1"),
        F.when(F.col("bp_systolic") > 0, F.col("bp_diastolic")).cast("double").alias("v2"),
    )
    su = F.struct(F.lit(O.METRIC_SUGAR).alias("metric"), F.col("blood_sugar").cast("double").alias("v1"), F.lit(None).cast("double").alias("v2"))
    x = readings.select("user_id", "ts", F.inline(F.array(hr, bp, su)))
    return x.filter((F.col("v1") > 0) & F.col("user_id").isNotNull())


def minute_aggregates() -> list:
    """Count, sums (near and far, of both values), least and largest value."""
    zero = F.lit(0).cast("decimal(38,9)")
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(near_sum(F.col("v1")), zero).alias("s1"),
        F.coalesce(far_sum(F.col("v1")), F.lit(0.0)).alias("f1"),
        F.coalesce(near_sum(F.col("v2")), zero).alias("s2"),
        F.coalesce(far_sum(F.col("v2")), F.lit(0.0)).alias("f2"),
        F.min("v1").alias("mn"),
        F.max("v1").alias("mx"),
    ]


def minute_partials(long_readings: DataFrame) -> DataFrame:
    minute = F.unix_micros(F.date_trunc("minute", F.col("ts")))
    return long_readings.groupBy("user_id", "metric", minute.alias("minute_us")).agg(*minute_aggregates())


def _fold(lengths_us: dict[str, int]):
    """Build the per-group fold (closure over the per-metric window lengths).

    Works on the group's Arrow table directly (``applyInArrow``): columns go
    to numpy without a pandas round trip."""
    import pyarrow as pa

    def fold(tbl: "pa.Table") -> "pa.Table":
        tbl = tbl.sort_by("minute_us")
        m = tbl.column("minute_us").to_numpy()
        length = lengths_us[tbl.column("metric")[0].as_py()]
        # Window starts: jump from one start to the first minute >= start + L.
        starts = []
        i = 0
        while i < len(m):
            starts.append(i)
            i = int(np.searchsorted(m, m[i] + length, side="left"))
        b = np.asarray(starts, dtype=np.int64)
        window = np.repeat(m[b], np.diff(np.append(b, len(m))))
        sums = [("n", "sum"), ("s1", "sum"), ("f1", "sum"), ("s2", "sum"), ("f2", "sum"), ("mn", "min"), ("mx", "max")]
        got = tbl.append_column("w", pa.array(window)).group_by("w", use_threads=False).aggregate(sums)
        w = got.column("w").to_numpy()
        k = len(w)
        columns = [
            pa.array([tbl.column("user_id")[0].as_py()] * k, pa.string()),
            pa.array([tbl.column("metric")[0].as_py()] * k, pa.string()),
            pa.array(w, pa.int64()),
            pa.array(w + length, pa.int64()),
        ] + [got.column(f"{name}_{how}") for name, how in sums]
        out = pa.table(columns, names=["user_id", "metric", "window_start_us", "window_end_us"] + [name for name, _ in sums])
        exact = pa.decimal128(38, 9)
        return out.set_column(5, "s1", out["s1"].cast(exact)).set_column(7, "s2", out["s2"].cast(exact))

    return fold


def anchored_partials(readings: DataFrame, opts: Options = DEFAULT, metrics: tuple[str, ...] | None = None) -> DataFrame:
    """Per (user, metric, anchored window): count, sums, min, max.

    ``metrics`` restricts the work to some metrics (filtered before any
    exchange; a filter after the Python fold would not be pushed into it).
    """
    long_ = unpivot(readings)
    if metrics is not None:
        long_ = long_.filter(F.col("metric").isin(*metrics))
    return fold_readings(long_, opts)


def lengths_us(opts: Options) -> dict[str, int]:
    return {
        O.METRIC_HR: opts.hr_window_minutes * MINUTE_US,
        O.METRIC_BP: opts.bp_window_minutes * MINUTE_US,
        O.METRIC_SUGAR: opts.sugar_window_minutes * MINUTE_US,
    }


def fold_readings(long_readings: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    """Unpivoted readings → anchored partials."""
    parts = minute_partials(long_readings)
    out = parts.groupBy("user_id", "metric").applyInArrow(_fold(lengths_us(opts)), PARTIAL_SCHEMA)
    return with_timestamps(out)


def with_timestamps(out: DataFrame) -> DataFrame:
    """``PARTIAL_SCHEMA`` rows (micros) → window bounds as timestamps."""
    return out.select(
        "user_id",
        "metric",
        F.timestamp_micros("window_start_us").alias("window_start"),
        F.timestamp_micros("window_end_us").alias("window_end"),
        "n",
        "s1",
        "f1",
        "s2",
        "f2",
        "mn",
        "mx",
    )


def anchored_windows(readings: DataFrame, opts: Options = DEFAULT, metrics: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Window results per metric, same shapes as the epoch-aligned ones."""
    return results(anchored_partials(readings, opts, metrics), opts)


def results(p: DataFrame, opts: Options = DEFAULT) -> dict[str, DataFrame]:
    """Anchored partials → per-metric window results (with alert structs)."""
    avg = mean(F.col("s1"), F.col("f1"), F.col("n"))
    avg2 = mean(F.col("s2"), F.col("f2"), F.col("n"))
    hr = p.filter(F.col("metric") == O.METRIC_HR).select(
        F.lit(O.RESULT_HR).alias("type"),
        "window_start",
        "window_end",
        "user_id",
        _r2(avg).alias("avg_heart_rate"),
        F.col("mn").alias("min_heart_rate"),
        F.col("mx").alias("max_heart_rate"),
        F.col("n").alias("reading_count"),
        _hr_alert(avg, opts).alias("alert"),
    )
    bp = p.filter(F.col("metric") == O.METRIC_BP).select(
        F.lit(O.RESULT_BP).alias("type"),
        "window_start",
        "window_end",
        "user_id",
        _r2(avg).alias("avg_bp_systolic"),
        _r2(avg2).alias("avg_bp_diastolic"),
        F.col("n").alias("reading_count"),
        _bp_alert(avg, avg2, opts).alias("alert"),
    )
    su = p.filter(F.col("metric") == O.METRIC_SUGAR).select(
        F.lit(O.RESULT_SUGAR).alias("type"),
        "window_start",
        "window_end",
        "user_id",
        _r2(avg).alias("avg_blood_sugar"),
        F.col("mn").alias("min_blood_sugar"),
        F.col("mx").alias("max_blood_sugar"),
        F.col("n").alias("reading_count"),
        _sugar_alert(avg, opts).alias("alert"),
    )
    return {"hr": hr, "bp": bp, "sugar": su}
