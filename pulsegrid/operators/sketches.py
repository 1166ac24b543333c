"""Trends across users from stored sketches.

Per day, metric and cohort one small row is kept: the number of readings, a KLL
sketch of their values (quantiles), a HyperLogLog sketch of the users (distinct
counts) and a frequent-items sketch of the users (heavy hitters). Rows of any span
of days and any cohorts merge into the sketches of the whole, so a report over a
year reads a few rows a day and no reading again. Sketches are partial aggregates:
a hot user or day is one sketch per task before anything is shuffled.

Errors: a KLL quantile's rank is off by at most about 1.33 % (k = 200, at 99 %
confidence), a distinct count by 1.6 % a standard deviation (lg k = 12); a heavy
hitter's count is exact while a sketch has met fewer different users than it tracks.
Readings without a user, a time or a value above zero are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import options as O

KLL_K = 200
LG_K = 12
TRACKED = 1000
RANK_ERROR = 0.0133
METRICS = {O.METRIC_HR: "heart_rate", O.METRIC_BP: "bp_systolic", O.METRIC_SUGAR: "blood_sugar"}


def long_values(readings: DataFrame, cohort: Column) -> DataFrame:
    """day, metric, cohort, user_id, value of every usable reading."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in METRICS.items()])
    rows = readings.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    rows = rows.select(F.to_date("ts").alias("day"), cohort.alias("cohort"), "user_id", F.inline(values))
    return rows.where("value > 0")


def daily_sketches(values: DataFrame) -> DataFrame:
    """One row per (day, metric, cohort); store it partitioned by day."""
    return values.groupBy("day", "metric", "cohort").agg(
        F.count(F.lit(1)).alias("readings"),
        F.kll_sketch_agg_double("value", F.lit(KLL_K)).alias("quantiles"),
        F.hll_sketch_agg("user_id", F.lit(LG_K)).alias("users"),
        F.expr(f"approx_top_k_accumulate(user_id, {TRACKED})").alias("frequent"),
    )


def merged(sketches: DataFrame, *by: Column | str, cube: bool = False) -> DataFrame:
    """Sketches merged per group, or per combination of groups with totals."""
    grouped = sketches.cube(*by) if cube else sketches.groupBy(*by)
    return grouped.agg(
        F.sum("readings").alias("readings"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("users").alias("users"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"),
    )


def quantile(rank: float) -> Column:
    return F.kll_sketch_get_quantile_double("quantiles", F.lit(rank))


def distinct_users() -> Column:
    return F.hll_sketch_estimate("users")


def heavy_users(k: int) -> Column:
    """The k most frequent users as an array of (item, count)."""
    return F.expr(f"approx_top_k_estimate(frequent, {int(k)})")


def trends(sketches: DataFrame, start: str, end: str) -> DataFrame:
    """cohort x week of each metric with all totals (null: all), for days from
    ``start`` to before ``end``; only those days' rows are read. Cohorts are not null."""
    span = sketches.where((F.col("day") >= F.lit(start).cast("date")) & (F.col("day") < F.lit(end).cast("date")))
    week = F.to_date(F.date_trunc("week", F.col("day"))).alias("week")
    return merged(span, "metric", "cohort", week, cube=True).where("metric IS NOT NULL")
