"""Job entry points: what the source system runs as services, as Spark
streaming jobs over a shared output folder.

* ``health_job``    — Kafka (or replayed files) → windows → metric and alert tables
* ``anchored_job``  — first-reading-anchored windows (standalone processor)
* ``ingest_job``    — Kafka topics → per-topic raw tables
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import alerts as A
from ..operators import anchored as AN
from ..sinks import tables as TB
from ..operators.parse import parse_health
from ..options import DEFAULT, Options
from ..session import checkpoint_dir, pin, stream_conf
from ..sources.streams import file_stream, kafka_records_stream, kafka_value_stream
from . import health_stream, ingest_stream
from .anchored_state import anchored_stream


def _messages(spark: SparkSession, opts: Options, source: str | None) -> DataFrame:
    """Kafka value stream, or a replay of stored message files at ``source``."""
    if source is None:
        return kafka_value_stream(spark, opts)
    return file_stream(spark, source, S.MESSAGE)


def health_job(spark: SparkSession, root: str, opts: Options = DEFAULT, source: str | None = None, trigger: dict | None = None) -> list[StreamingQuery]:
    return health_stream.start(spark, _messages(spark, opts, source), root, opts, trigger=trigger)


def anchored_sink(spark: SparkSession, root: str, opts: Options):
    """``foreachBatch`` body of the standalone job: closed anchored windows →
    METRIC rows (short / long table by metric) and ALERT rows (BP threshold
    stored as the systolic threshold), each written insert-if-absent."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        held = batch.persist()  # all tables are written from one evaluation
        try:
            _write(held)
        finally:
            held.unpersist()

    def _write(batch: DataFrame) -> None:
        res = AN.results(AN.with_timestamps(batch), opts)
        short = A.hr_metric_rows(res["hr"]).unionByName(A.bp_metric_rows(res["bp"]))
        TB.append_if_absent(spark, short, root, TB.METRICS_1MIN, writer="anchored", assume_unique=True, held=True)
        TB.append_if_absent(spark, A.sugar_metric_rows(res["sugar"]), root, TB.METRICS_10MIN, writer="anchored", assume_unique=True, held=True)
        alerts = A.union_all([A.hr_alert_rows(res["hr"]), A.bp_alert_rows(res["bp"], opts), A.sugar_alert_rows(res["sugar"])])
        TB.append_if_absent(spark, alerts, root, TB.ALERTS, writer="anchored", assume_unique=True, held=True)

    return write


def anchored_job(
    spark: SparkSession, root: str, opts: Options = DEFAULT, source: str | None = None, trigger: dict | None = None, name: str = "anchored"
) -> StreamingQuery:
    """The standalone processor: per-metric validity, first-reading-anchored
    windows, metric and alert rows written idempotently."""
    pin(spark)
    o = opts.with_(validity="metric", bp_threshold_mode="standalone")
    readings = parse_health(_messages(spark, o, source), o)
    w = (
        anchored_stream(readings, o)
        .writeStream.foreachBatch(anchored_sink(spark, root, o))
        .option("checkpointLocation", checkpoint_dir(spark, name))
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": f"{o.flush_interval_seconds} seconds"}))
    )
    with stream_conf(spark, o.state_partitions):
        return w.start()


def _length_seconds(opts: Options) -> Column:
    """The window length of a row's metric."""
    lengths = [F.when(F.col("metric") == m, F.lit(us / 1e6)) for m, us in AN.lengths_us(opts).items()]
    return F.coalesce(*lengths)


def drain_anchored(spark: SparkSession, messages_batch: DataFrame, root: str, opts: Options = DEFAULT, since=None) -> None:
    """Shutdown flush of the standalone job: windows still open in the state
    store are written from a batch fold over the messages. With ``since``, the
    stream's last watermark, only windows that end after it are written, and only
    their readings are folded: a window that is open at the watermark started less
    than its length before it, and its readings are those from the end of the
    user's last written window on."""
    o = opts.with_(validity="metric", bp_threshold_mode="standalone")
    readings = parse_health(messages_batch, o)
    if since is None:
        long_ = AN.unpivot(readings)
    else:
        mark = F.lit(since).cast("timestamp")
        reach = mark - F.make_dt_interval(mins=F.lit(max(o.hr_window_minutes, o.bp_window_minutes, o.sugar_window_minutes)))
        done = TB.read_table(spark, root, TB.METRICS_1MIN).unionByName(TB.read_table(spark, root, TB.METRICS_10MIN))
        done = done.filter((F.col(TB.PARTITION_COL) >= F.to_date(reach)) & (F.col("window_end") <= mark))
        done = done.groupBy("user_id", F.col("metric_type").alias("metric")).agg(F.max("window_end").alias("closed"))
        long_ = AN.unpivot(readings.filter(F.col("ts") >= reach)).join(done, ["user_id", "metric"], "left")
        starts = F.col("ts") >= mark - F.make_dt_interval(secs=_length_seconds(o))
        long_ = long_.filter(F.when(F.col("closed").isNull(), starts).otherwise(F.col("ts") >= F.col("closed")))
    p = AN.fold_readings(long_, o).select(
        "user_id",
        "metric",
        F.unix_micros("window_start").alias("window_start_us"),
        F.unix_micros("window_end").alias("window_end_us"),
        "n",
        "s1",
        "f1",
        "s2",
        "f2",
        "mn",
        "mx",
    )
    if since is not None:
        p = p.filter(F.timestamp_micros("window_end_us") > F.lit(since).cast("timestamp"))
    anchored_sink(spark, root, o)(p, -1)


def ingest_job(spark: SparkSession, root: str, opts: Options = DEFAULT, trigger: dict | None = None) -> StreamingQuery:
    return ingest_stream.start(spark, kafka_records_stream(spark, opts), root, opts, trigger=trigger)
