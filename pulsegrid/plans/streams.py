"""Queries that run the streaming job end to end and return what it wrote.

The health messages are replayed in time slices through the streaming job
(watermark, append-mode windows, ``foreachBatch`` keyed sinks), which restarts
from its checkpoint for every slice. At the end the windows past the last
watermark are drained, and no others: a window that the stream should have
written itself is missing from the result if it didn't. The tables must equal
the batch results, so they share the batch queries' oracle SQL. Output folders
live under the session's checkpoint folder (shared storage on a cluster).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..session import checkpoint_dir
from ..sinks import tables as TB
from ..sources.replay import NO_TIME, history_stream, slices, store_history
from ..sources.streams import file_stream, time_slices
from ..streaming import counters as CO
from ..streaming import health_stream as HS
from ..streaming import ingest_stream as IS
from ..streaming import jobs as J
from ..streaming import trend_streams as TS
from . import fixtures as X
from .common import TABLE_OPTS, ntz, prepare

_RUNS: dict[tuple, str] = {}
SLICES = 4  # restarts of the replayed job, each on the next span of time


def _app(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return spark.conf.get("spark.app.id", str(id(spark)))


def _opts(spark: SparkSession):
    # state partitions sized to the cluster's cores, not the default 200
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect
        cores = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    return TABLE_OPTS.with_(watermark_delay="1 hour", state_partitions=max(2, cores))


def _replay(df, src: str, start, counters: CO.CounterListener | None = None) -> str | None:
    """Write ``df`` in time slices, running the job that ``start`` starts to
    its end after each (from its checkpoint); returns the last watermark."""
    mark = None  # no progress names a watermark: nothing may be drained in the stream's place
    for part in time_slices(df, "timestamp", SLICES):
        part.write.mode("append").parquet(src)
        queries = start()
        for q in queries if isinstance(queries, list) else [queries]:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
            mark = max(filter(None, (mark, HS.watermark_of(q))), default=None)
            if counters is not None:
                counters.wait(q)
    return mark


def _marked(mark: str | None) -> str:
    """A drain without the stream's watermark would write all in its place."""
    if mark is None:
        raise RuntimeError("the stream named no watermark")
    return mark


def run_stream_twin(spark: SparkSession, sf_dir: str) -> str:
    """Replay, stream, drain; return the output root (once per session)."""
    key = (_app(spark), sf_dir)
    if key in _RUNS:
        return _RUNS[key]
    prepare(spark)
    base = checkpoint_dir(spark, f"stream-twin-{uuid.uuid4().hex[:12]}")
    src, root = f"{base}/messages", f"{base}/tables"
    opts, name = _opts(spark), f"twin-{uuid.uuid4().hex[:8]}"
    start = lambda: HS.start(spark, file_stream(spark, src, S.MESSAGE), root, opts, name=name, trigger={"availableNow": True})
    with CO.counting(spark, root) as counters:
        mark = _replay(X.health_messages(spark, sf_dir), src, start, counters)
    HS.drain(spark, spark.read.schema(S.MESSAGE).parquet(src), root, opts, since=_marked(mark), counted=True)
    _RUNS[key] = root
    return root


def run_anchored_twin(spark: SparkSession, sf_dir: str) -> str:
    """The standalone job (stateful anchored windows) over the same replay,
    drained at shutdown; returns the output root (once per session)."""
    key = (_app(spark), sf_dir, "anchored")
    if key in _RUNS:
        return _RUNS[key]
    prepare(spark)
    base = checkpoint_dir(spark, f"anchored-twin-{uuid.uuid4().hex[:12]}")
    src, root = f"{base}/messages", f"{base}/tables"
    opts, name = _opts(spark), f"anchored-{uuid.uuid4().hex[:8]}"
    start = lambda: J.anchored_job(spark, root, opts, source=src, trigger={"availableNow": True}, name=name)
    mark = _replay(X.health_messages(spark, sf_dir), src, start)
    J.drain_anchored(spark, spark.read.schema(S.MESSAGE).parquet(src), root, opts, since=_marked(mark))
    _RUNS[key] = root
    return root


def stream_anchored_alerts(spark, sf_dir):
    root = run_anchored_twin(spark, sf_dir)
    return ntz(TB.read_table(spark, root, TB.ALERTS).drop(TB.WRITER_COL, TB.PARTITION_COL))


def run_trends_twin(spark: SparkSession, sf_dir: str) -> str:
    """The session and the multi-metric job over one replay, drained at the end;
    returns the output root (once per session)."""
    key = (_app(spark), sf_dir, "trends")
    if key in _RUNS:
        return _RUNS[key]
    prepare(spark)
    base = checkpoint_dir(spark, f"trends-twin-{uuid.uuid4().hex[:12]}")
    src, root = f"{base}/messages", f"{base}/tables"
    opts, run = _opts(spark), uuid.uuid4().hex[:8]
    read = lambda: file_stream(spark, src, S.MESSAGE)
    once = {"availableNow": True}
    marks = {}

    def start():
        made = {
            "sessions": TS.start_sessions(spark, read(), root, opts, name=f"sessions-{run}", trigger=once),
            "pairs": TS.start_correlation(spark, read(), read(), root, opts, name=f"pairs-{run}", trigger=once),
        }
        for q in made.values():
            q.awaitTermination()
        marks.update({n: HS.watermark_of(q) or marks.get(n) for n, q in made.items()})
        return list(made.values())

    _replay(X.health_messages(spark, sf_dir), src, start)
    messages = spark.read.schema(S.MESSAGE).parquet(src)
    TS.drain_sessions(spark, messages, root, _marked(marks["sessions"]), opts)
    TS.drain_correlation(spark, messages, root, _marked(marks["pairs"]), opts)
    _RUNS[key] = root
    return root


def stream_user_sessions(spark, sf_dir):
    return ntz(TB.read_table(spark, run_trends_twin(spark, sf_dir), TB.SESSIONS).drop(TB.WRITER_COL, TB.PARTITION_COL))


def stream_multi_metric_alerts(spark, sf_dir):
    return ntz(TB.read_table(spark, run_trends_twin(spark, sf_dir), TB.CORRELATED).drop(TB.WRITER_COL, TB.PARTITION_COL))


DAY = 86_400
REPLAY_SECONDS = 24  # how long the replay's clock takes for the whole history


def run_history_twin(spark: SparkSession, sf_dir: str) -> str:
    """The health job on a history told by the replay source, stopped half way and
    started again from its checkpoints; windows past the last watermark are
    drained. Returns the output root (once per session)."""
    key = (_app(spark), sf_dir, "history")
    if key in _RUNS:
        return _RUNS[key]
    prepare(spark)
    base = checkpoint_dir(spark, f"history-twin-{uuid.uuid4().hex[:12]}")
    path, root = f"{base}/history", f"{base}/tables"
    opts, name = _opts(spark), f"history-{uuid.uuid4().hex[:8]}"
    store_history(X.health_messages(spark, sf_dir), path, "timestamp", DAY)
    timed = [s for s in slices(path) if s != NO_TIME]
    speed = max((timed[-1] - timed[0]) / 1e6 / REPLAY_SECONDS, 1.0) if timed else 1.0
    began, mark = time.time(), None
    for share in (0.5, 1.0):
        messages = history_stream(spark, path, S.MESSAGE, began, speed)
        queries = HS.start(spark, messages, root, opts, name=name, trigger={"processingTime": "1 second"})
        time.sleep(max(began + REPLAY_SECONDS * share + 1 - time.time(), 0))
        for q in queries:
            if share == 1.0:
                q.processAllAvailable()
                if q.exception() is not None:
                    raise RuntimeError(str(q.exception()))
            q.stop()  # half way, whatever batch it is in
            mark = max(filter(None, (mark, HS.watermark_of(q))), default=None)
    HS.drain(spark, spark.read.schema(S.MESSAGE).parquet(path), root, opts, since=_marked(mark))
    _RUNS[key] = root
    return root


def stream_history_replay(spark, sf_dir):
    """The short-window METRIC rows that the job made of the replayed history."""
    root = run_history_twin(spark, sf_dir)
    return ntz(TB.read_table(spark, root, TB.METRICS_1MIN).drop(TB.WRITER_COL, TB.PARTITION_COL))


KAFKA_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def run_ingest_twin(spark: SparkSession, sf_dir: str) -> str:
    """Kafka-shaped records replayed through the ingestion stream into the
    per-topic raw tables (exactly-once file sink); returns the table root."""
    key = (_app(spark), sf_dir, "ingest")
    if key in _RUNS:
        return _RUNS[key]
    prepare(spark)
    base = checkpoint_dir(spark, f"ingest-twin-{uuid.uuid4().hex[:12]}")
    src, root = f"{base}/records", f"{base}/raw"
    opts, name = _opts(spark), f"ingest-{uuid.uuid4().hex[:8]}"
    start = lambda: IS.start(spark, file_stream(spark, src, KAFKA_RECORD), root, opts, name=name, trigger={"availableNow": True}, replay=True)
    _replay(X.kafka_records(spark, sf_dir), src, start)
    _RUNS[key] = root
    return root


def stream_topic_routing(spark, sf_dir):
    """Rows per raw table and ingestion date, as written by the stream."""
    root = run_ingest_twin(spark, sf_dir)
    return spark.read.parquet(root).groupBy("table", "ingest_date").agg(F.count(F.lit(1)).alias("rows"))


def stream_metrics_1min(spark, sf_dir):
    root = run_stream_twin(spark, sf_dir)
    return ntz(TB.read_table(spark, root, TB.METRICS_1MIN).drop(TB.WRITER_COL, TB.PARTITION_COL))


def stream_health_counters(spark, sf_dir):
    """The counters that the health job kept over its restarts, and its flush."""
    return CO.read_counters(spark, run_stream_twin(spark, sf_dir)).drop(CO.UNKNOWN)


def stream_metrics_10min(spark, sf_dir):
    root = run_stream_twin(spark, sf_dir)
    return ntz(TB.read_table(spark, root, TB.METRICS_10MIN).drop(TB.WRITER_COL, TB.PARTITION_COL))


def stream_alerts(spark, sf_dir):
    root = run_stream_twin(spark, sf_dir)
    return ntz(TB.read_table(spark, root, TB.ALERTS).drop(TB.WRITER_COL, TB.PARTITION_COL))


QUERIES = {
    "stream_metrics_1min": stream_metrics_1min,
    "stream_metrics_10min": stream_metrics_10min,
    "stream_alerts": stream_alerts,
    "stream_health_counters": stream_health_counters,
    "stream_anchored_alerts": stream_anchored_alerts,
    "stream_user_sessions": stream_user_sessions,
    "stream_multi_metric_alerts": stream_multi_metric_alerts,
    "stream_topic_routing": stream_topic_routing,
    "stream_history_replay": stream_history_replay,
}
