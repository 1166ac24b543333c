"""The replay source: whole, in event-time order, by its clock, over restarts."""

import os
import time
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pulsegrid.session import checkpoint_dir
from pulsegrid.sources import replay as R

SCHEMA = "id long, at timestamp, note string"
HOUR = 3600


def history(spark, scratch, rows, **kw):
    path = os.path.join(scratch, "history")
    df = spark.createDataFrame(rows, SCHEMA)
    R.store_history(df, path, "at", HOUR, **kw)
    return path, df


def run(spark, path, schema, started, speed, name, seen, until):
    """Runs a query on the history to the time ``until``, or, if that is None, for
    two batches with rows; ``seen`` gets its batches by number (a batch that a stop
    cut off comes again) and when they came."""

    def keep(batch, number):
        rows = batch.collect()
        if rows:
            seen[number] = (time.time(), rows)

    stream = R.history_stream(spark, path, schema, started, speed)
    q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint_dir(spark, name)).trigger(processingTime="200 milliseconds").start()
    if until is None:
        while len(seen) < 2 and q.isActive:
            time.sleep(0.05)
    else:
        time.sleep(max(until - time.time(), 1))
        q.processAllAvailable()
    assert q.exception() is None
    q.stop()


def test_told_once_in_order_by_the_clock_and_on_after_a_restart(spark, scratch):
    begin = datetime(2024, 5, 1)
    rows = [(k, begin + timedelta(minutes=7 * (k * 37 % 200)), f"n{k}") for k in range(200)]
    rows += [(k, begin + timedelta(hours=3), None) for k in range(200, 260)]  # ties in one slice
    rows += [(300, None, "no time"), (301, begin - timedelta(hours=2), "first"), (301, begin - timedelta(hours=2), "first")]
    path, df = history(spark, scratch, rows, rows_per_file=40)
    stored = R.slices(path)
    assert stored[0] == R.NO_TIME and stored == sorted(stored)
    speed, seen, name = 0.66 * HOUR, {}, f"replay-{uuid.uuid4().hex[:8]}"  # the 26 hours take 40 seconds
    started = time.time()
    run(spark, path, df.schema, started, speed, name, seen, None)
    before = max(seen)
    told = {r["id"] for _, part in seen.values() for r in part}
    assert 300 in told and len(told) < 262
    run(spark, path, df.schema, started, speed, name, seen, started + 41)
    assert max(seen) > before
    got = sorted((str(r["at"]), r["id"], r["note"]) for _, part in seen.values() for r in part)
    assert got == sorted((str(r["at"]), r["id"], r["note"]) for r in df.collect())
    last = None
    epoch = datetime(1970, 1, 1)
    for _, (came, part) in sorted(seen.items()):
        slots = {R.NO_TIME if r["at"] is None else (r["at"] - epoch) // timedelta(hours=1) for r in part}
        assert last is None or min(slots) > last  # slices are whole, and later batches hold later ones
        last = max(slots)
        due = max(slots)
        if due != R.NO_TIME:
            assert (due * HOUR - stored[1] / 1e6) / speed <= came - started  # nothing before its time


def test_large_slices_are_split_and_columns_pruned(spark, scratch):
    begin = datetime(2024, 5, 1)
    path, df = history(spark, scratch, [(k, begin, "x") for k in range(1000)], rows_per_file=100)
    reader = R.ReplayReader(df.select("id").schema, path, 1.0, time.time())
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    batches = [b for p in parts for b in reader.read(p)]
    assert len(parts) >= 10 and batches[0].schema.names == ["id"]
    assert sorted(x for b in batches for x in b.column(0).to_pylist()) == list(range(1000))


def test_no_rows_and_two_queries_on_one_history(spark, scratch):
    path, df = history(spark, scratch, [])
    seen = {}
    run(spark, path, df.schema, time.time(), 1.0, f"replay-{uuid.uuid4().hex[:8]}", seen, 0)
    assert R.slices(path) == [] and not seen
    other = os.path.join(scratch, "other")
    R.store_history(spark.range(50).select("id", F.timestamp_seconds(F.col("id") * 600).alias("at"), F.lit("y").alias("note")), other, "at", HOUR)
    for _ in range(2):
        seen = {}
        run(spark, other, df.schema, time.time() - 60, HOUR, f"replay-{uuid.uuid4().hex[:8]}", seen, 0)
        assert sorted(r["id"] for _, part in seen.values() for r in part) == list(range(50))
