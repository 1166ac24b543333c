"""Readings far from their user's rolling baseline (z-scores).

A baseline is the count, mean and squared deviations (M2) of the readings in the
``buckets`` whole buckets of time before a reading's own. Per (user, bucket) the
moments are partial aggregates; the moments of several buckets are merged pairwise,
by the distance of their means, which loses no digits where a sum of squares would.
So a user's readings are never sorted or gathered: a baseline merges a few rows,
and readings meet it by (user, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rounding import round_half_even
from ..options import DEFAULT, Options

MOMENTS = "struct<n:bigint,mean:double,m2:double>"


def moments(x: Column) -> Column:
    """Count, mean and sum of squared deviations as one struct of aggregates."""
    n = F.count(x)
    return F.struct(n.alias("n"), F.avg(x.cast("double")).alias("mean"), (F.var_pop(x.cast("double")) * n).alias("m2")).cast(MOMENTS)


def merge_moments(a: Column, b: Column) -> Column:
    """Moments of two disjoint sets together; empty ones count for nothing."""
    n = a["n"] + b["n"]
    off = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        (a["mean"] + off * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + off * off * a["n"] * b["n"] / n).alias("m2"),
    ).cast(MOMENTS)
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def baselines(readings: DataFrame, metric: str, opts: Options = DEFAULT) -> DataFrame:
    """(user_id, bucket, base): merged moments of the buckets before."""
    per = readings.where(F.col(metric) > 0).groupBy("user_id", "bucket").agg(moments(F.col(metric)).alias("own"))
    before = Window.partitionBy("user_id").orderBy("bucket").rangeBetween(-opts.baseline_buckets, -1)
    empty = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")).cast(MOMENTS)
    return per.select("user_id", "bucket", F.aggregate(F.collect_list("own").over(before), empty, merge_moments).alias("base"))


def anomalies(readings: DataFrame, metric: str, opts: Options = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """Readings at least ``opts.anomaly_z`` standard deviations from a baseline of
    at least ``opts.baseline_readings`` readings that are not all equal."""
    width = opts.baseline_bucket_minutes * 60_000_000
    rows = readings.where((F.col(metric) > 0) & F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    rows = rows.select(*keep, "ts", "user_id", metric, F.floor(F.unix_micros("ts") / F.lit(width)).cast("long").alias("bucket"))
    base = baselines(rows, metric, opts).where((F.col("base.n") >= opts.baseline_readings) & (F.col("base.m2") > 0))
    z = (F.col(metric).cast("double") - F.col("base.mean")) / F.sqrt(F.col("base.m2") / F.col("base.n"))
    return (
        rows.join(base, ["user_id", "bucket"])
        .withColumn("z", z)
        .where(F.abs("z") >= opts.anomaly_z)
        .select(
            *keep,
            "ts",
            "user_id",
            F.col(metric).cast("double").alias("value"),
            F.col("base.n").alias("baseline_readings"),
            round_half_even(F.col("base.mean"), 4).alias("baseline_mean"),
            round_half_even(F.col("z"), 4).alias("z_score"),
        )
    )
