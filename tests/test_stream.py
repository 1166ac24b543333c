"""Stream twin: the file-replayed stream plus the shutdown drain equals the
batch result; replays are idempotent; the stateful anchored stream emits
exactly the batch windows that are closed."""

import os
import uuid

from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators import alerts as A
from pulsegrid.operators.anchored import anchored_partials
from pulsegrid.operators.parse import parse_health
from pulsegrid.plans import fixtures as X
from pulsegrid.plans.common import TABLE_OPTS, TABLE_OPTS_METRIC
from pulsegrid.sinks import tables as TB
from pulsegrid.sources.streams import file_stream
from pulsegrid.streaming import health_stream as HS
from pulsegrid.streaming.anchored_state import anchored_stream

SF = "/root/testdata/sf0.001"
OPTS = TABLE_OPTS.with_(watermark_delay="1 hour")


def write_replay_files(df, path, ts_col, files):
    """Time-ordered files, the oldest with the oldest modification time."""
    df.repartitionByRange(files, ts_col).sortWithinPartitions(ts_col).write.parquet(path)
    for i, n in enumerate(sorted(n for n in os.listdir(path) if n.startswith("part-"))):
        os.utime(os.path.join(path, n), (1_000_000 + i, 1_000_000 + i))


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


import pytest  # noqa: E402


@pytest.mark.parametrize("files", [4, 7])
def test_stream_twin_and_idempotent_replay(spark, scratch, files):
    """Stream + drain equals batch however the replay is cut into batches."""
    msgs = X.health_messages(spark, SF)
    src = os.path.join(scratch, "msgs")
    write_replay_files(msgs, src, "timestamp", files)
    root = os.path.join(scratch, "tables")
    stream = file_stream(spark, src, S.MESSAGE, max_files_per_trigger=1)
    qs = HS.start(spark, stream, root, OPTS, name=f"twin-{uuid.uuid4().hex[:8]}", trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination(300)
        assert q.exception() is None
    batch = A.metric_rows(parse_health(msgs, OPTS), OPTS)
    cols = ["window_start", "user_id", "metric_type", "avg_value", "min_value", "max_value", "reading_count"]
    # what the stream itself wrote: exactly the windows that its watermark closed
    mark = max(HS.watermark_of(q) for q in qs)
    closed = batch["1min"].filter(F.col("window_end") <= F.lit(mark).cast("timestamp"))
    assert _rows(TB.read_table(spark, root, TB.METRICS_1MIN), cols) == _rows(closed, cols) != []
    assert sum(op.get("numRowsDroppedByWatermark", 0) for q in qs for p in q.recentProgress for op in p["stateOperators"]) == 0
    HS.drain(spark, spark.read.parquet(src), root, OPTS, since=mark)
    got = TB.read_table(spark, root, TB.METRICS_1MIN)
    assert _rows(got, cols) == _rows(batch["1min"], cols)
    got10 = TB.read_table(spark, root, TB.METRICS_10MIN)
    assert _rows(got10, cols) == _rows(batch["10min"], cols)
    acols = ["window_start", "user_id", "alert_type", "severity", "metric_value", "threshold_value"]
    assert _rows(TB.read_table(spark, root, TB.ALERTS), acols) == _rows(A.alert_rows(parse_health(msgs, OPTS), OPTS), acols)

    # replaying the whole history changes nothing
    before = {t: TB.read_table(spark, root, t).count() for t in (TB.METRICS_1MIN, TB.METRICS_10MIN, TB.ALERTS)}
    HS.drain(spark, spark.read.parquet(src), root, OPTS)
    after = {t: TB.read_table(spark, root, t).count() for t in before}
    assert before == after


def test_drain_leaves_closed_windows_to_the_stream(spark, scratch):
    """A stream that wrote nothing is not covered up by the shutdown drain."""
    msgs = X.health_messages(spark, SF)
    last = msgs.agg(F.max("timestamp")).first()[0]
    HS.drain(spark, msgs, scratch, OPTS, since=str(last))
    batch = A.metric_rows(parse_health(msgs, OPTS), OPTS)["1min"]
    assert TB.read_table(spark, scratch, TB.METRICS_1MIN).count() < batch.count() / 2


@pytest.mark.parametrize("shuffled", [False, True])
def test_anchored_stream_matches_batch(spark, scratch, shuffled):
    """In time order, and with readings spread over all batches (out of order
    within the watermark)."""
    msgs = X.health_messages(spark, SF)
    src = os.path.join(scratch, "msgs")
    if shuffled:
        msgs.repartition(3, F.xxhash64("event_id")).write.parquet(src)
        text = '{"user_id": "last", "heart_rate": {"value": 80}, "timestamp": "2030-01-01T00:00:00+00:00"}'
        last = spark.createDataFrame([(-1, None, text)], msgs.schema)  # closes all windows
        last.coalesce(1).write.mode("append").parquet(src)
    else:
        write_replay_files(msgs, src, "timestamp", 3)
    opts = TABLE_OPTS_METRIC.with_(watermark_delay="100 days" if shuffled else "1 hour", hr_window_minutes=600, bp_window_minutes=700)
    stream = file_stream(spark, src, S.MESSAGE, max_files_per_trigger=1)
    readings = parse_health(stream, opts)
    name = f"anch_{uuid.uuid4().hex[:8]}"
    q = (
        anchored_stream(readings, opts)
        .writeStream.format("memory")
        .queryName(name)
        .outputMode("append")
        .option("checkpointLocation", os.path.join(scratch, "ck"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    assert q.exception() is None
    emitted = spark.table(name)
    batch = anchored_partials(parse_health(msgs, opts), opts).select(
        "user_id", "metric", F.unix_micros("window_start").alias("window_start_us"), F.unix_micros("window_end").alias("window_end_us"), "n", "s1", "s2"
    )
    cols = ["user_id", "metric", "window_start_us", "n", "s1", "s2"]
    closed = batch.filter(F.timestamp_micros("window_end_us") <= F.lit(HS.watermark_of(q)).cast("timestamp"))
    assert _rows(emitted, cols) == _rows(closed, cols) != []


def test_ingest_stream_routes_by_topic(spark, scratch):
    from pulsegrid.streaming import ingest_stream as IS
    from pyspark.sql import types as T

    recs = X.kafka_records(spark, SF)
    src = os.path.join(scratch, "kafka")
    write_replay_files(recs, src, "timestamp", 2)
    schema = T.StructType(
        [
            T.StructField("topic", T.StringType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
            T.StructField("value", T.StringType()),
            T.StructField("timestamp", T.TimestampType()),
        ]
    )
    out = os.path.join(scratch, "raw")
    q = IS.start(spark, file_stream(spark, src, schema, 1), out, OPTS, name=f"ing-{uuid.uuid4().hex[:8]}", trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(out)
    assert got.count() == recs.count()
    tables = {r.table for r in got.select("table").distinct().collect()}
    assert tables == {"virtual_wearables", "virtual_restaurants", "virtual_gps"}
    assert q.lastProgress["observedMetrics"]["ingest_counters"]["messages"] >= 0


def test_browse_stored_raw_tables(spark, scratch):
    import pytest
    from pulsegrid.operators import browse as B
    from pulsegrid.operators import ingest as I

    raw = I.raw_rows(I.enrich(X.kafka_records(spark, SF), now=F.col("timestamp")))
    out = os.path.join(scratch, "raw")
    raw.write.partitionBy("table", "ingest_date").parquet(out)
    page, total = B.browse_raw(spark, out, "virtual_gps", limit=5, offset=0)
    rows = page.withColumn("total", total).collect()
    assert len(rows) == 5 and rows[0].total == raw.filter(F.col("table") == "virtual_gps").count()
    with pytest.raises(B.BrowseError):
        B.browse_raw(spark, out, "pg_catalog")


def test_standalone_job_writes_metric_and_alert_tables(spark, scratch):
    from pulsegrid.operators import sqlgate as G
    from pulsegrid.streaming import jobs as J

    msgs = X.health_messages(spark, SF)
    src = os.path.join(scratch, "msgs")
    write_replay_files(msgs, src, "timestamp", 2)
    root = os.path.join(scratch, "tables")
    opts = TABLE_OPTS.with_(watermark_delay="1 hour")
    q = J.anchored_job(spark, root, opts, source=src, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    m = TB.read_table(spark, root, TB.METRICS_1MIN)
    assert m.count() > 0 and set(r.metric_type for r in m.select("metric_type").distinct().collect()) <= {"heart_rate", "blood_pressure"}
    a = TB.read_table(spark, root, TB.ALERTS).filter(F.col("alert_type") == "elevated_blood_pressure")
    assert {r.threshold_value for r in a.select("threshold_value").distinct().collect()} <= {140.0}
    TB.register_views(spark, root)
    res = G.run_query(spark, "SELECT metric_type, count(*) AS n FROM health_metrics_1min GROUP BY metric_type")
    assert res["row_count"] >= 1


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, scratch):
    import json

    opts = TABLE_OPTS.with_(watermark_delay="1 hour")
    src = os.path.join(scratch, "late")
    os.makedirs(src)

    def put(name, ts_list, mtime):
        rows = [(i, None, json.dumps({"user_id": "u", "heart_rate": {"value": 80}, "timestamp": t})) for i, t in enumerate(ts_list)]
        spark.createDataFrame(rows, "event_id long, timestamp timestamp, value string").coalesce(1).write.parquet(os.path.join(src, name))
        for f in os.listdir(os.path.join(src, name)):
            os.utime(os.path.join(src, name, f), (mtime, mtime))

    put("a", ["2024-01-10T00:00:00+00:00"], 1_000_000)
    put("b", ["2024-01-11T00:00:00+00:00"], 1_000_100)
    # Spark filters late input against the previous batch's watermark, so a
    # late row is dropped from the second batch after the watermark advances
    put("c", ["2024-01-01T00:00:00+00:00"], 1_000_200)
    stream = file_stream(spark, src + "/*", S.MESSAGE, max_files_per_trigger=1)
    r = HS.watermarked_readings(stream, opts)
    parts = HS.window_stream(r, opts.hr_window_minutes, ("hr",))
    name = f"late_{uuid.uuid4().hex[:8]}"
    q = (
        parts.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    dropped = sum(
        int(op.get("numRowsDroppedByWatermark", 0)) for p in q.recentProgress for op in p.get("stateOperators", [])
    )
    assert spark.table(name).filter(F.col("window_start") < F.lit("2024-01-05").cast("timestamp")).count() == 0
    assert dropped >= 1
    assert HS.late_rows(q) >= 0


def test_time_slices_keep_rows_without_a_time(spark):
    from pulsegrid.sources.streams import time_slices

    df = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-01 00:00:00'), (2, NULL), (3, timestamp'2024-01-02 00:00:00') AS t(id, at)")
    got = [sorted(r.id for r in part.collect()) for part in time_slices(df, "at", 2)]
    assert got == [[1, 2], [3]]


def test_anchored_state_empties_and_drain_reads_a_bounded_span(spark, scratch):
    """The state holds the last window's minutes and no more, and the shutdown
    flush doesn't look at messages more than a window older than the watermark."""
    from pulsegrid.sources.streams import time_slices
    from pulsegrid.streaming import jobs as J

    msgs = X.health_messages(spark, SF)
    opts = TABLE_OPTS_METRIC.with_(watermark_delay="1 hour", state_partitions=2)
    src, root, name = os.path.join(scratch, "m"), os.path.join(scratch, "t"), f"anch-{uuid.uuid4().hex[:8]}"
    mark, held = None, []
    text = '{"user_id": "last", "heart_rate": {"value": 80}, "timestamp": "2030-0%d-01T00:00:00+00:00"}'
    far = [spark.createDataFrame([(-m, None, text % m)], msgs.schema).coalesce(1) for m in (1, 3)]

    def run(part):
        part.write.mode("append").parquet(src)
        q = J.anchored_job(spark, root, opts, source=src, trigger={"availableNow": True}, name=name)
        q.awaitTermination(300)
        assert q.exception() is None
        held.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        return HS.watermark_of(q)

    for part in time_slices(msgs, "timestamp", 2):
        mark = run(part) or mark
    o = opts.with_(bp_threshold_mode="standalone")
    cols = ["window_start", "user_id", "metric_type", "avg_value", "reading_count"]
    end = F.lit(mark).cast("timestamp")
    from pulsegrid.operators import anchored as AN

    res = AN.anchored_windows(parse_health(msgs, o), o)
    short = A.hr_metric_rows(res["hr"]).unionByName(A.bp_metric_rows(res["bp"]))
    long_ = A.sugar_metric_rows(res["sugar"])
    wrote = {t: _rows(TB.read_table(spark, root, t), cols) for t in (TB.METRICS_1MIN, TB.METRICS_10MIN)}
    assert wrote[TB.METRICS_1MIN] == _rows(short.filter(F.col("window_end") <= end), cols) != []
    assert wrote[TB.METRICS_10MIN] == _rows(long_.filter(F.col("window_end") <= end), cols) != []
    # all that is older than a window before the watermark is of no matter to the flush
    span = msgs.filter(F.col("timestamp") >= end - F.make_dt_interval(days=F.lit(10)))
    wrong = msgs.filter(F.col("timestamp") < end - F.make_dt_interval(days=F.lit(10))).withColumn("value", F.regexp_replace("value", '"value": ', '"value": 9'))
    drained = os.path.join(scratch, "drained")
    for t in (TB.METRICS_1MIN, TB.METRICS_10MIN):
        TB.read_table(spark, root, t).write.partitionBy(TB.WRITER_COL, TB.PARTITION_COL).parquet(TB.table_path(drained, t))
    J.drain_anchored(spark, span.union(wrong), drained, opts, since=mark)
    assert _rows(TB.read_table(spark, drained, TB.METRICS_1MIN), cols) == _rows(short, cols)
    assert _rows(TB.read_table(spark, drained, TB.METRICS_10MIN), cols) == _rows(long_, cols)
    # readings far ahead close every window: what is left is the last reading's minute and timer
    run(far[0])
    assert run(far[1]) is not None
    assert held[1] > 100 and held[-1] <= 3, held
    left = spark.read.format("statestore").option("stateVarName", "minutes").load(HS.checkpoint_dir(spark, name))
    assert left.count() == 1
    assert _rows(TB.read_table(spark, root, TB.METRICS_1MIN).filter("user_id <> 'last'"), cols) == _rows(short, cols)
