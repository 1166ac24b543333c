"""Property tests against brute force: exact rounding vs Python's round,
and the anchored-window fold vs a direct Python fold."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from pulsegrid.functions.rounding import round_half_even
from pulsegrid.operators.anchored import anchored_partials
from pulsegrid.options import DEFAULT


def test_round_half_even_matches_python(spark):
    rnd = random.Random(7)
    xs = [rnd.uniform(-1e4, 1e4) for _ in range(3000)]
    # tie-prone values: k/8, k/40, k/200 and sums of .x5 decimals
    xs += [k / 8 for k in range(-400, 400)] + [k / 40 for k in range(-400, 400)] + [k / 200 for k in range(0, 2000)]
    xs += [round(rnd.uniform(0, 500), 3) for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for d in (1, 2):
        got = [r[0] for r in df.select(round_half_even(F.col("x"), d)).collect()]
        want = [round(x, d) for x in xs]
        bad = [(x, g, w) for x, g, w in zip(xs, got, want) if g != w]
        assert not bad, bad[:5]


def _brute(readings, minutes):
    """Direct fold: per (user, metric) in time order, window opens at the
    minute of the first reading, a reading at/after the end opens the next."""
    out = {}
    by_key = {}
    for u, ts, v in sorted(readings, key=lambda r: (r[0], r[1])):
        by_key.setdefault(u, []).append((ts, v))
    for u, rows in by_key.items():
        start = end = None
        for ts, v in rows:
            if start is None or ts >= end:
                start = ts.replace(second=0, microsecond=0)
                end = start + timedelta(minutes=minutes)
            n, s = out.get((u, start), (0, 0))
            out[(u, start)] = (n + 1, s + v)
    return out


def test_anchored_fold_matches_brute_force(spark):
    rnd = random.Random(11)
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = []
    for u in range(12):
        t = t0 + timedelta(seconds=rnd.randint(0, 3000))
        for _ in range(rnd.randint(1, 60)):
            t += timedelta(seconds=rnd.choice([5, 30, 59, 61, 119, 400, 1800]))
            rows.append((f"u{u}", t, rnd.randint(60, 180)))
    df = spark.createDataFrame(
        [(u, ts, float(v), None, None, None) for u, ts, v in rows],
        "user_id string, ts timestamp, heart_rate double, bp_systolic double, bp_diastolic double, blood_sugar double",
    )
    opts = DEFAULT.with_(hr_window_minutes=7)
    got = {
        (r.user_id, r.window_start.astimezone(timezone.utc)): (r.n, int(r.s1))
        for r in anchored_partials(df, opts, ("heart_rate",)).collect()
    }
    assert got == _brute(rows, 7)


def test_with_next_equals_lead_over_whole_key(spark):
    from pyspark.sql import Window

    from pulsegrid.operators.sequence import with_next

    rnd = random.Random(5)
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows, i = [], 0
    for k in ("a", "b", "hot"):
        n = 400 if k == "hot" else rnd.randint(1, 40)
        t = t0
        for _ in range(n):
            t += timedelta(minutes=rnd.choice([0, 1, 7, 59, 61, 180, 1500]))  # ties, gaps, empty hours
            rows.append((k, t, i, rnd.random()))
            i += 1
    df = spark.createDataFrame(rows, "k string, ts timestamp, id long, v double")
    got = {r.id: (r.next_id, r.next_v) for r in with_next(df, "k", "ts", "id", ("v",)).collect()}
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = {r.id: (r.n_id, r.n_v) for r in df.select("id", F.lead("id").over(w).alias("n_id"), F.lead("v").over(w).alias("n_v")).collect()}
    assert got == want
