"""Distribution reports: histograms per device type and metric, and how far two
spans of time differ.

Histograms are kept per day as counts per bin, which add up exactly over any days,
so a report over a span reads one small row per day, metric and bin. Drift is the
population stability index, the sum over bins of (p - q) ln(p / q) for the shares p
and q of the two spans; half a reading is added to every bin that either span has,
so a bin that one of them lacks has a finite weight. Under 0.1 is commonly read as
stable, from 0.25 on as a shift. Values that are null, NaN or infinite are counted
in a bin of their own (null), so a rise of missing values is drift too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round_half_even

#: Widths of the bins: fixed values per metric.
WIDTHS = {
    "heart_rate": 10.0,
    "bp_systolic": 10.0,
    "blood_sugar": 20.0,
    "speed_kmh": 10.0,
    "heading": 30.0,
    "altitude": 100.0,
    "total_amount": 25000.0,
}


def metric_rows(df: DataFrame, device_type: str, time: str, metrics: tuple[str, ...]) -> DataFrame:
    """device_type, day, metric, bin of each of the named columns; rows without a
    time are left out."""
    own = [F.struct(F.lit(m).alias("metric"), _bin(m).alias("bin")) for m in metrics]
    rows = df.where(F.col(time).isNotNull())
    return rows.select(F.lit(device_type).alias("device_type"), F.to_date(time).alias("day"), F.inline(F.array(*own)))


def _bin(metric: str) -> Column:
    x = F.col(metric).cast("double")
    real = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e15)
    return F.when(real, F.floor(x / F.lit(WIDTHS[metric])).cast("long"))


def daily_histograms(rows: DataFrame) -> DataFrame:
    """Counts per (device_type, metric, day, bin)."""
    return rows.groupBy("device_type", "metric", "day", "bin").agg(F.count(F.lit(1)).alias("n"))


def drift(histograms: DataFrame, before: tuple[str, str], after: tuple[str, str]) -> DataFrame:
    """Per device type and metric: readings of both spans (days from the first to
    before the second date), bins that occur, and the stability index."""
    within = lambda s: (F.col("day") >= F.lit(s[0]).cast("date")) & (F.col("day") < F.lit(s[1]).cast("date"))
    count = lambda s: F.sum(F.when(within(s), F.col("n")).otherwise(0))
    bins = histograms.where(within(before) | within(after)).groupBy("device_type", "metric", "bin").agg(count(before).alias("a"), count(after).alias("b"))
    totals = bins.groupBy("device_type", "metric").agg(F.sum("a").alias("n_before"), F.sum("b").alias("n_after"), F.count(F.lit(1)).alias("bins"))
    p = (F.col("a") + 0.5) / (F.col("n_before") + 0.5 * F.col("bins"))
    q = (F.col("b") + 0.5) / (F.col("n_after") + 0.5 * F.col("bins"))
    each = bins.join(totals, ["device_type", "metric"]).withColumn("part", (p - q) * F.ln(p / q))
    found = each.groupBy("device_type", "metric", "n_before", "n_after", "bins").agg(F.sum("part").alias("psi"))
    return found.withColumn("psi", round_half_even(F.col("psi"), 6))
