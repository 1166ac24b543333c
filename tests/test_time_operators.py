"""Sessions, sliding windows, baselines and the joins in time against brute force,
with nulls, ties and a key that holds a third of all rows."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import anomalies as AN
from pulsegrid.operators import correlate as C
from pulsegrid.operators import sessions as SE
from pulsegrid.operators import timejoin as TJ
from pulsegrid.operators import windows as W
from pulsegrid.options import Options
from pulsegrid.plans.catalog import QUERIES

T0 = dt.datetime(2024, 1, 1)
SF = "/root/testdata/sf0.001"


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def keyed(rng, n, span, keys=5):
    """(key, second) rows; the first key has a third of them, times repeat, some are null."""
    out = []
    for _ in range(n):
        key = "hot" if rng.random() < 0.34 else rng.choice([*(f"k{i}" for i in range(keys)), None])
        out.append((key, None if rng.random() < 0.03 else rng.randrange(span)))
    return out


def readings(spark, rows):
    """rows: (user, second, heart rate)."""
    schema = "ts timestamp, user_id string, heart_rate int, bp_systolic int, bp_diastolic int, blood_sugar int, valid int"
    return spark.createDataFrame([(at(s), u, h, -1, -1, -1, 1) for u, s, h in rows], schema).repartition(6)


# --- joins in time ----------------------------------------------------------


@pytest.mark.parametrize("before, after", [(60, 60), (0, 25), (300, 0), (0, 0)])
def test_interval_join(spark, before, after):
    rng = random.Random(before + after)
    a, b = keyed(rng, 400, 3000), keyed(rng, 400, 3000)
    left = spark.createDataFrame([(i, k, at(s)) for i, (k, s) in enumerate(a)], "a int, k string, ta timestamp")
    right = spark.createDataFrame([(i, k, at(s)) for i, (k, s) in enumerate(b)], "b int, k string, tb timestamp")
    got = TJ.interval_join(left, right, "k", "ta", "tb", dt.timedelta(seconds=before), dt.timedelta(seconds=after)).select("a", "b").collect()
    want = [
        (i, j) for i, (k, s) in enumerate(a) for j, (m, t) in enumerate(b)
        if k is not None and k == m and s is not None and t is not None and -before <= t - s <= after
    ]
    assert sorted(map(tuple, got)) == want != []


def test_range_join_of_long_and_short_intervals(spark):
    rng = random.Random(1)
    points = keyed(rng, 400, 100_000)
    spans = [(k, s, s + rng.choice([0, -5, 1, 2, 60, 4000, 90_000])) for k, s in keyed(rng, 300, 100_000) if s is not None]
    p = spark.createDataFrame([(i, k, at(s)) for i, (k, s) in enumerate(points)], "p int, k string, t timestamp")
    v = spark.createDataFrame([(i, k, at(a), at(b)) for i, (k, a, b) in enumerate(spans)], "v int, k string, a timestamp, b timestamp")
    got = TJ.range_join(p, v.union(v.limit(1).selectExpr("-1", "k", "null", "b")), "k", "t", "a", "b").select("p", "v").collect()
    want = [(i, j) for i, (k, s) in enumerate(points) for j, (m, a, b) in enumerate(spans) if k is not None and k == m and s is not None and a <= s < b]
    assert sorted(map(tuple, got)) == want != []
    assert TJ.range_join(p, v.limit(0), "k", "t", "a", "b").count() == 0


def test_long_intervals_take_two_bins(spark):
    v = spark.createDataFrame([("k", at(7), at(7 + 3_000_000))], "k string, a timestamp, b timestamp")
    p = spark.createDataFrame([("k", at(9))], "k string, t timestamp")
    exploded = TJ.range_join(p, v, "k", "t", "a", "b")
    assert exploded.count() == 1
    bins = v.withColumn("us", F.unix_micros("b") - F.unix_micros("a")).select(F.ceil(F.log2("us"))).first()[0]
    assert 3_000_000e6 <= 2**bins  # a bin of its level covers its length


@pytest.mark.parametrize("tolerance, bucket", [(None, 3600), (40, 60), (500, 7)])
def test_as_of_join(spark, tolerance, bucket):
    rng = random.Random(bucket)
    a, b = keyed(rng, 500, 4000), keyed(rng, 200, 4000)
    left = spark.createDataFrame([(i, k, at(s), "x") for i, (k, s) in enumerate(a)], "a int, k string, ta timestamp, extra string")
    right = spark.createDataFrame([(i, k, at(s), i * 2) for i, (k, s) in enumerate(b)], "b int, k string, tb timestamp, v int")
    tol = None if tolerance is None else dt.timedelta(seconds=tolerance)
    got = TJ.as_of_join(left, right, "k", "ta", "tb", "b", tol, dt.timedelta(seconds=bucket))
    assert got.columns == ["a", "k", "ta", "extra", "b", "tb", "v"]
    want = {}
    for i, (k, s) in enumerate(a):
        some = [(t, j) for j, (m, t) in enumerate(b) if k is not None and k == m and s is not None and t is not None and t <= s]
        best = max(some, default=None)
        want[i] = best[1] if best and (tolerance is None or s - best[0] <= tolerance) else None
    rows = got.collect()
    assert len(rows) == len(a) and {r.a: r.b for r in rows} == want and any(v is not None for v in want.values())
    assert all((r.v, r.extra) == (None if r.b is None else 2 * r.b, "x") for r in rows)
    assert TJ.as_of_join(left, right.limit(0), "k", "ta", "tb", "b").where("b IS NOT NULL").count() == 0
    assert TJ.as_of_join(left.limit(0), right, "k", "ta", "tb", "b").count() == 0


# --- sessions ---------------------------------------------------------------


def brute_sessions(rows, gap):
    out = []
    for user in {u for u, s, _ in rows if u is not None}:
        own = sorted((s, h) for u, s, h in rows if u == user and s is not None)
        while own:
            n = 1
            while n < len(own) and own[n][0] - own[n - 1][0] <= gap:
                n += 1
            hr = [h for _, h in own[:n] if h > 0]
            out.append((user, at(own[0][0]), at(own[n - 1][0] + gap), n, round(sum(hr) / len(hr), 2) if hr else None))
            own = own[n:]
    return sorted(out)


@pytest.mark.parametrize("panes", [256, 3, 1])
def test_sessions_equal_brute_force(spark, monkeypatch, panes):
    """However few panes a bucket has, sessions over bucket edges are whole."""
    monkeypatch.setattr(SE, "PANES", panes)
    rng = random.Random(panes)
    rows = [(k, s, rng.choice([-1, 60, 71, 90])) for k, s in keyed(rng, 900, 400_000, keys=20)]
    rows += [("edge", s, 70) for s in (0, 600, 1200, 1801, 2401, 6000)]  # gaps of exactly ten minutes, and one second more
    rows += [("long", s, 80) for s in range(0, 60_000, 300)] + [("back", -s, 66) for s in range(0, 5000, 400)]  # before 1970 is no matter
    got = SE.user_sessions(readings(spark, rows), Options(session_gap_minutes=10)).collect()
    assert sorted((r.user_id, r.session_start, r.session_end, r.reading_count, r.avg_heart_rate) for r in got) == brute_sessions(rows, 600)
    assert SE.user_sessions(readings(spark, rows).limit(0)).count() == 0


def test_sessions_equal_session_window(spark):
    rng = random.Random(9)
    rows = [(k, s, 70) for k, s in keyed(rng, 500, 100_000) if s is not None]
    r = readings(spark, rows)
    opts = Options(session_gap_minutes=7)
    columns = ["user_id", "session_start", "session_end", "reading_count"]
    batch = SE.user_sessions(r, opts).select(*columns).collect()
    assert sorted(batch) == sorted(SE.session_rows(SE.session_stream(r, opts)).select(*columns).collect())


# --- sliding windows --------------------------------------------------------


@pytest.mark.parametrize("width, slide", [(10, 4), (9, 3), (6, 6), (5, 8)])
def test_sliding_windows_equal_spark_windows(spark, width, slide):
    rng = random.Random(width)
    r = readings(spark, [(k, s, rng.randint(50, 150)) for k, s in keyed(rng, 400, 20_000) if k and s is not None])
    got = W.hr_result(W.sliding_partials(r, width, slide, ("hr",))).drop("alert", "type")
    if slide <= width:
        starts = F.window("ts", f"{width} minutes", f"{slide} minutes")
    else:  # Spark knows no windows with gaps between them
        starts = F.window("ts", f"{slide} minutes")
        r = r.where(F.pmod(F.unix_seconds("ts"), F.lit(slide * 60)) < width * 60)
    want = r.groupBy("user_id", starts.alias("w")).agg(F.min("heart_rate").alias("mn"), F.max("heart_rate").alias("mx"), F.count("*").alias("n"), F.avg("heart_rate").alias("a"))
    want = {(x.user_id, x.w.start, x.w.start + dt.timedelta(minutes=width)): (x.mn, x.mx, x.n, round(x.a, 2)) for x in want.collect()}
    rows = got.collect()
    assert len(rows) == len(want)
    assert {(x.user_id, x.window_start, x.window_end): (x.min_heart_rate, x.max_heart_rate, x.reading_count, x.avg_heart_rate) for x in rows} == want


def test_sliding_windows_copy_panes_not_readings(spark):
    """The readings' exchange carries panes, reduced in the tasks before it."""
    r = readings(spark, [("u", s, 70) for s in range(0, 3600)])
    plan = W.sliding_partials(r, 60, 5, ("hr",))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Generate explode") :]
    assert "partial_count" in below and "Expand" not in plan and plan.count("Generate explode") == 1


# --- baselines --------------------------------------------------------------


def test_merged_moments_keep_their_digits(spark):
    """Values with a large common part, whose squares would lose the spread."""
    rng = np.random.default_rng(4)
    x = 1e9 + rng.normal(0, 1e-3, 300)
    parts = [(i % 7, float(v)) for i, v in enumerate(x)]
    per = spark.createDataFrame(parts, "b int, x double").groupBy("b").agg(AN.moments(F.col("x")).alias("m"))
    empty = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")).cast(AN.MOMENTS)
    m = per.agg(F.aggregate(F.collect_list("m"), empty, AN.merge_moments).alias("m")).first()["m"]
    want = ((x - x.mean()) ** 2).sum()
    assert m["n"] == 300 and abs(m["mean"] - x.mean()) < 1e-6 and abs(m["m2"] / want - 1) < 1e-3
    assert abs((np.sum(x * x) - 300 * x.mean() ** 2) / want - 1) > 1  # what sums of squares would give


def test_anomalies_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(k, s, int(rng.gauss(80, 6)) + rng.choice([0] * 30 + [70])) for k, s in keyed(rng, 1500, 40 * 3600, keys=2)]
    rows += [("flat", 60 * i, 70) for i in range(300)] + [("flat", 18_100, 200)]  # no spread: no score
    opts = Options(baseline_bucket_minutes=60, baseline_buckets=5, baseline_readings=10, anomaly_z=3.0)
    want = []
    for u, s, h in rows:
        if u is None or s is None or h <= 0:
            continue
        b = [x for w, t, x in rows if w == u and t is not None and x > 0 and s // 3600 - 5 <= t // 3600 < s // 3600]
        if len(b) >= 10 and np.std(b) > 0 and abs(h - np.mean(b)) / np.std(b) >= 3:
            want.append((u, at(s), float(h), len(b), round(float((h - np.mean(b)) / np.std(b)), 4)))
    got = AN.anomalies(readings(spark, rows), "heart_rate", opts).collect()
    assert sorted((r.user_id, r.ts, r.value, r.baseline_readings, r.z_score) for r in got) == sorted(want) != []


# --- multi-metric alerts ----------------------------------------------------


def test_multi_metric_alerts(spark):
    schema = "time timestamp, user_id string, alert_type string, severity string, metric_value double, threshold_value double, window_start timestamp, window_end timestamp"
    row = lambda u, s, sev, v: (at(s + 60), u, "x", sev, v, 0.0, at(s), at(s + 60))
    hr = spark.createDataFrame([row("a", 0, "critical", 130.0), row("a", 600, "warning", 105.0), row("b", 0, "critical", 125.0), row(None, 0, "critical", 1.0)], schema)
    bp = spark.createDataFrame([row("a", 120, "critical", 170.0), row("a", -180, "warning", 141.0), row("a", 360, "critical", 165.0), row("c", 0, "critical", 180.0), row(None, 0, "critical", 1.0)], schema)
    got = C.multi_metric_alerts(hr, bp, Options(correlation_minutes=3)).collect()
    assert sorted((r.user_id, r.time, r.severity, r.hr_value, r.bp_value, r.bp_after_hr_minutes) for r in got) == [
        ("a", at(60), "warning", 130.0, 141.0, -3),
        ("a", at(180), "critical", 130.0, 170.0, 2),
    ]
    got = C.multi_metric_alerts(hr, bp, Options(correlation_minutes=4)).collect()
    assert len(got) == 3 and ("a", at(660), -4) in {(r.user_id, r.time, r.bp_after_hr_minutes) for r in got}


@pytest.mark.parametrize("name", ["user_sessions", "sliding_hr_windows", "multi_metric_alerts", "heart_rate_anomalies", "fix_last_elevated_reading", "fixes_in_alerts"])
def test_time_queries_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
