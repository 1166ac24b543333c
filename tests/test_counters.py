"""Counters of running jobs: equal to the batch counts over batches and restarts,
each batch counted once, unknown result types counted and not stored."""

import os
import uuid

from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators import alerts as A
from pulsegrid.operators.parse import parse_health
from pulsegrid.plans import fixtures as X
from pulsegrid.plans.common import TABLE_OPTS
from pulsegrid.sinks import tables as TB
from pulsegrid.sources.streams import file_stream, time_slices
from pulsegrid.streaming import counters as CO
from pulsegrid.streaming import health_stream as HS

SF = "/root/testdata/sf0.001"
OPTS = TABLE_OPTS.with_(watermark_delay="1 hour", state_partitions=2)
ONCE = {"availableNow": True}


def test_health_counters_over_restarts(spark, scratch):
    msgs = X.health_messages(spark, SF)
    src, root, name = os.path.join(scratch, "m"), os.path.join(scratch, "t"), f"cnt-{uuid.uuid4().hex[:8]}"
    mark = None
    for part in time_slices(msgs, "timestamp", 3):
        part.write.mode("append").parquet(src)
        with CO.counting(spark, root) as counters:  # a new listener, as after a restart
            for q in HS.start(spark, file_stream(spark, src, S.MESSAGE, max_files_per_trigger=2), root, OPTS, name=name, trigger=ONCE):
                q.awaitTermination(300)
                assert q.exception() is None
                counters.wait(q)
                mark = max(filter(None, (mark, HS.watermark_of(q))))
    readings = parse_health(msgs, OPTS)
    alerts = A.alert_rows(readings, OPTS)
    got = CO.read_counters(spark, root).first()
    closed = alerts.filter(F.col("window_end") <= F.lit(mark).cast("timestamp")).count()
    assert (got[CO.MESSAGES], got[CO.ALERTS], got[CO.UNKNOWN]) == (msgs.count(), closed, 0) and 0 < closed < alerts.count()
    for _ in range(2):  # a flush, or any batch, that runs again counts once
        HS.drain(spark, spark.read.schema(S.MESSAGE).parquet(src), root, OPTS, since=mark, counted=True)
    want = A.counters(readings, alerts).first()
    got = CO.read_counters(spark, root).first()
    assert (got[CO.MESSAGES], got[CO.ALERTS]) == (want[CO.MESSAGES], want[CO.ALERTS])


def test_unknown_types_are_counted_and_not_stored(spark, scratch):
    rows = A.metric_rows(parse_health(X.health_messages(spark, SF), TABLE_OPTS), TABLE_OPTS)
    rows = rows["1min"].unionByName(rows["10min"])
    kind = F.when(F.col("reading_count") == 2, F.lit("skin_temperature")).when(F.col("reading_count") == 3, F.lit(None)).otherwise(F.col("metric_type"))
    rows = rows.withColumn("metric_type", kind)
    src, root, name = os.path.join(scratch, "r"), os.path.join(scratch, "t"), f"res-{uuid.uuid4().hex[:8]}"
    with CO.counting(spark, root) as counters:
        for part in time_slices(rows, "time", 2):
            part.write.mode("append").parquet(src)
            q = HS.start_results(spark, file_stream(spark, src, rows.schema), root, TABLE_OPTS, name, ONCE)
            q.awaitTermination(300)
            assert q.exception() is None
            counters.wait(q)
    routed = A.route_results(rows)
    assert CO.read_counters(spark, root).first()[CO.UNKNOWN] == routed["unknown"].count() > 0
    for part, table in (("1min", TB.METRICS_1MIN), ("10min", TB.METRICS_10MIN)):
        assert TB.read_table(spark, root, table).count() == routed[part].count() > 0
