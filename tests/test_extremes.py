"""Extreme readings stop no job: batch windows, anchored windows, the stream."""

import json
import os

from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators import windows as W
from pulsegrid.operators.anchored import anchored_windows
from pulsegrid.operators.parse import parse_health
from pulsegrid.options import DEFAULT
from pulsegrid.sources.streams import file_stream
from pulsegrid.streaming.anchored_state import anchored_stream

METRIC = DEFAULT.with_(validity="metric")


def messages(spark, values):
    text = lambda v: '{"user_id": "%s", "heart_rate": {"value": %s}, "timestamp": "2024-01-01T00:00:10+00:00"}' % v
    rows = [(i, None, text(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "event_id long, timestamp timestamp, value string")


EXTREME = [("a", "1e13"), ("a", "1"), ("b", "1e300"), ("b", "1e300"), ("c", "1e400"), ("d", "100.0000004"), ("e", "90")]


def test_batch_windows(spark):
    df = messages(spark, EXTREME)
    for o in (METRIC, DEFAULT):
        got = {r.user_id: r for r in W.heart_rate_windows(parse_health(df, o), o).collect()}
        assert got["e"].avg_heart_rate == 90.0
    got = {r.user_id: r for r in W.heart_rate_windows(parse_health(df, METRIC), METRIC).collect()}
    assert got["a"].avg_heart_rate == 5e12 + 0.5 and got["b"].avg_heart_rate in (1e300, float("inf"))
    assert got["d"].alert is not None and got["d"].avg_heart_rate == 100.0
    anchored = {r.user_id: r for r in anchored_windows(parse_health(df, METRIC), METRIC)["hr"].collect()}
    assert {u: r.avg_heart_rate for u, r in anchored.items()} == {u: r.avg_heart_rate for u, r in got.items()}


def test_many_largest_integers(spark):
    df = messages(spark, [("u", "2147483647")] * 5000)
    (r,) = W.heart_rate_windows(parse_health(df, DEFAULT), DEFAULT).collect()
    assert r.avg_heart_rate == 2147483647.0 and r.reading_count == 5000


def test_stream(spark, scratch):
    df = messages(spark, EXTREME + [("u", "2147483647")] * 50)
    late = spark.createDataFrame([(99, None, json.dumps({"user_id": "z", "heart_rate": {"value": 80}, "timestamp": "2024-02-01T00:00:00+00:00"}))], df.schema)
    src = os.path.join(scratch, "in")
    for part in (df, late):
        part.coalesce(1).write.mode("append").parquet(src)
    readings = parse_health(file_stream(spark, src, S.MESSAGE), METRIC)
    q = anchored_stream(readings, METRIC).writeStream.format("memory").queryName("extreme").option("checkpointLocation", scratch + "/ck")
    q = q.outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.user_id: (r.n, float(r.s1) + r.f1) for r in spark.table("extreme").collect()}
    assert got["a"] == (2, 1e13 + 1) and got["u"] == (50, 50 * 2147483647.0) and got["b"][1] == 2e300
    assert spark.table("extreme").filter(F.col("n") < 1).count() == 0
