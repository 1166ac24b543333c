"""Stored sketches: errors against exact figures, spans that add up, hot users."""

import datetime as dt
import os

import numpy as np
from pyspark.sql import functions as F

from pulsegrid.operators import sketches as SK

T0 = dt.datetime(2024, 1, 1)
N = 40_000


def readings(spark):
    """40,000 readings over 40 days; user 0 has a third of them."""
    r = spark.range(N).select(
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 57_600).cast("int"))).alias("ts"),
        F.concat(F.lit("u"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)))).alias("user_id"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_003)) / 7.0 + 1).alias("heart_rate"),
        F.lit(-1).alias("bp_systolic"),
        F.when(F.col("id") % 2 == 0, F.lit(90)).alias("blood_sugar"),
    )
    return r.unionByName(r.limit(3).withColumn("user_id", F.lit(None).cast("string"))).repartition(8)


def test_sketches_of_spans_against_exact_figures(spark, scratch):
    values = SK.long_values(readings(spark), F.pmod(F.crc32(F.col("user_id").cast("binary")), F.lit(3))).persist()
    path = os.path.join(scratch, "sketches")
    SK.daily_sketches(values).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    whole = values.where("metric = 'heart_rate'").toPandas()
    for first, last in ((0, 40), (3, 17), (5, 6)):
        a, b = (T0 + dt.timedelta(days=first)).date(), (T0 + dt.timedelta(days=last)).date()
        one = SK.trends(stored, str(a), str(b)).where("metric = 'heart_rate' AND cohort IS NULL AND week IS NULL")
        got = one.select("readings", *[SK.quantile(q).alias(f"q{int(q * 100)}") for q in (0.05, 0.5, 0.95)], SK.distinct_users().alias("users"), SK.heavy_users(1).alias("top")).first()
        exact = whole[(whole.day >= a) & (whole.day < b)]
        assert got.readings == len(exact)
        for q in (5, 50, 95):
            x = got[f"q{q}"]
            assert (exact.value < x).mean() - SK.RANK_ERROR <= q / 100 <= (exact.value <= x).mean() + SK.RANK_ERROR
        assert abs(got.users - exact.user_id.nunique()) <= max(1, 0.05 * exact.user_id.nunique())
        hot = (exact.user_id == "u0").sum()
        assert got.top[0]["item"] == "u0" and abs(got.top[0]["count"] - hot) <= len(exact) / SK.TRACKED * 4
    assert set(values.select("metric").distinct().toPandas().metric) == {"heart_rate", "blood_sugar"}  # nothing of a metric without values
    values.unpersist()


def test_totals_are_the_sums_of_their_parts(spark):
    values = SK.long_values(readings(spark), F.lit(1))
    t = SK.trends(SK.daily_sketches(values), "2024-01-01", "2024-03-01").select("metric", "cohort", "week", "readings").toPandas()
    hr = t[t.metric == "heart_rate"]
    assert hr[hr.cohort.notna() & hr.week.notna()].readings.sum() == N == hr[hr.cohort.isna() & hr.week.isna()].readings.iloc[0]
    assert len(t[t.metric == "blood_sugar"]) == len(hr) and np.all(t.readings > 0)


def test_only_the_span_is_read_and_no_readings_are_shuffled(spark, scratch):
    path = os.path.join(scratch, "sketches")
    SK.daily_sketches(SK.long_values(readings(spark), F.lit(1))).write.partitionBy("day").parquet(path)
    plan = SK.trends(spark.read.parquet(path), "2024-01-05", "2024-01-07")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    made = SK.daily_sketches(SK.long_values(readings(spark), F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in made.lower() and "partial_approx_top_k" in made.lower() or made.lower().count("objecthashaggregate") >= 2
