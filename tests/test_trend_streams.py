"""What the session and multi-metric streams write themselves, before any drain:
exactly the results that their watermark has closed."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators.parse import parse_health
from pulsegrid.plans import fixtures as X
from pulsegrid.plans.catalog import QUERIES
from pulsegrid.plans.common import TABLE_OPTS
from pulsegrid.operators import sessions as SE
from pulsegrid.sinks import tables as TB
from pulsegrid.sources.streams import file_stream, time_slices
from pulsegrid.streaming import health_stream as HS
from pulsegrid.streaming import trend_streams as TS

SF = "/root/testdata/sf0.001"
OPTS = TABLE_OPTS.with_(watermark_delay="1 hour", state_partitions=2)
ONCE = {"availableNow": True}


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def replay(msgs, src, start, slices=3):
    """Runs the job after each slice of time, from its checkpoint; returns the last query and watermark."""
    mark, q = None, None
    for part in time_slices(msgs, "timestamp", slices):
        part.write.mode("append").parquet(src)
        q = start()
        q.awaitTermination(300)
        assert q.exception() is None
        mark = max(filter(None, (mark, HS.watermark_of(q))))
    return q, mark


def test_session_stream_writes_closed_sessions(spark, scratch):
    msgs = X.health_messages(spark, SF)
    src, root, name = os.path.join(scratch, "m"), os.path.join(scratch, "t"), f"se-{uuid.uuid4().hex[:8]}"
    read = lambda: file_stream(spark, src, S.MESSAGE)
    _, mark = replay(msgs, src, lambda: TS.start_sessions(spark, read(), root, OPTS, name, ONCE))
    cols = ["user_id", "session_start", "session_end", "reading_count", "avg_heart_rate", "min_heart_rate", "max_heart_rate"]
    batch = SE.user_sessions(parse_health(msgs, OPTS), OPTS)
    end = F.lit(mark).cast("timestamp")
    wrote = rows(TB.read_table(spark, root, TB.SESSIONS), cols)
    assert wrote == rows(batch.where(F.col("session_end") <= end), cols) != []
    assert len(wrote) < batch.count()  # some were open
    for _ in range(2):  # a repeated drain adds nothing
        TS.drain_sessions(spark, spark.read.schema(S.MESSAGE).parquet(src), root, mark, OPTS)
        assert rows(TB.read_table(spark, root, TB.SESSIONS), cols) == rows(batch, cols)


def test_correlation_stream_writes_closed_pairs_and_forgets_them(spark, scratch):
    msgs = X.health_messages(spark, SF)
    src, root, name = os.path.join(scratch, "m"), os.path.join(scratch, "t"), f"co-{uuid.uuid4().hex[:8]}"
    read = lambda: file_stream(spark, src, S.MESSAGE)
    start = lambda: TS.start_correlation(spark, read(), read(), root, OPTS, name, ONCE)
    _, mark = replay(msgs, src, start)
    batch = QUERIES["multi_metric_alerts"](spark, SF)
    cols = [f.name for f in S.CORRELATED.fields]
    table = lambda: TB.read_table(spark, root, TB.CORRELATED).select(*[F.col(f.name).cast("timestamp_ntz") if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in S.CORRELATED.fields])
    closed = batch.where(F.col("time") <= F.lit(mark).cast("timestamp").cast("timestamp_ntz"))
    assert rows(table(), cols) == rows(closed, cols) != []
    TS.drain_correlation(spark, spark.read.schema(S.MESSAGE).parquet(src), root, mark, OPTS)
    assert rows(table(), cols) == rows(batch, cols)
    # a message far ahead closes all windows: no window and no alert stays in the state
    text = '{"user_id": "last", "heart_rate": {"value": 80}, "blood_pressure": {"systolic": 100, "diastolic": 60}, "timestamp": "2030-01-%02dT00:00:00+00:00"}'
    for day in (1, 9):
        spark.createDataFrame([(-day, None, text % day)], msgs.schema).coalesce(1).write.mode("append").parquet(src)
        q = start()
        q.awaitTermination(300)
    held = [op["numRowsTotal"] for op in q.recentProgress[-1]["stateOperators"]]
    assert rows(table(), cols) == rows(batch, cols) and sum(held) <= 4, held


def test_widths_must_agree(spark):
    with pytest.raises(ValueError):
        TS.correlated_stream(None, None, OPTS.with_(hr_window_minutes=5))


def test_drains_read_the_messages_once(spark, scratch):
    acc = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b

    msgs = X.health_messages(spark, SF)
    n, seen = msgs.count(), msgs.mapInArrow(run, msgs.schema)
    for drain in (lambda root: TS.drain_correlation(spark, seen, root, "2024-01-20T00:00:00Z", OPTS), lambda root: HS.drain(spark, seen, root, OPTS, since="2024-01-20T00:00:00Z")):
        before = acc.value
        drain(os.path.join(scratch, uuid.uuid4().hex))
        assert acc.value - before == n
