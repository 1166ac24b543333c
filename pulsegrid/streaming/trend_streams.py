"""Sessions and multi-metric alerts on Structured Streaming.

* Sessions: ``session_window`` per user; a session is written once the watermark
  has passed its end, and its state goes then.
* Multi-metric alerts: heart-rate and blood-pressure windows, each from its own
  watermarked read of the messages, close into alerts that meet in an interval
  join. Both watermarks bound its state: an alert is kept until no partner can come.

Each micro-batch is written insert-if-absent on the table's key, so a batch that is
replayed after a failure adds nothing. ``drain_*`` write what is still open when the
job stops, and nothing that the stream should have written itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import alerts as A
from ..operators import correlate as C
from ..operators import sessions as SE
from ..operators import windows as W
from ..operators.parse import parse_health
from ..options import DEFAULT, Options
from ..session import checkpoint_dir, pin, stream_conf
from ..sinks import tables as TB
from .health_stream import watermarked_readings

EVENT_TIME = "event_time"


def _start(spark: SparkSession, rows: DataFrame, root: str, table: str, opts: Options, name: str, trigger: dict | None) -> StreamingQuery:
    def write(batch: DataFrame, epoch_id: int) -> None:
        TB.append_if_absent(batch.sparkSession, batch, root, table, writer=name, assume_unique=True)

    stream = rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint_dir(spark, name))
    stream = stream.trigger(**(trigger or {"processingTime": f"{opts.flush_interval_seconds} seconds"})).queryName(name)
    with stream_conf(spark, opts.state_partitions):
        return stream.start()


# --- sessions ---------------------------------------------------------------


def start_sessions(spark: SparkSession, messages: DataFrame, root: str, opts: Options = DEFAULT, name: str = "sessions", trigger: dict | None = None) -> StreamingQuery:
    pin(spark)
    rows = SE.session_rows(SE.session_stream(watermarked_readings(messages, opts), opts))
    return _start(spark, rows, root, TB.SESSIONS, opts, name, trigger)


def drain_sessions(spark: SparkSession, messages: DataFrame, root: str, since: str, opts: Options = DEFAULT, name: str = "sessions") -> None:
    """Sessions that end after ``since``, the stream's last watermark. Only
    readings from the end of a user's last written session on are folded."""
    done = TB.read_table(spark, root, TB.SESSIONS).where(F.col("session_end") <= F.lit(since).cast("timestamp"))
    done = done.groupBy("user_id").agg(F.max("session_end").alias("closed"))
    tail = parse_health(messages, opts).join(done, "user_id", "left").where(F.col("closed").isNull() | (F.col("ts") >= F.col("closed"))).drop("closed")
    rows = SE.user_sessions(tail, opts).where(F.col("session_end") > F.lit(since).cast("timestamp"))
    TB.append_if_absent(spark, rows, root, TB.SESSIONS, writer=f"{name}-drain", assume_unique=True)


# --- multi-metric alerts ----------------------------------------------------


def alert_stream(messages: DataFrame, metric: str, opts: Options) -> DataFrame:
    """Alert rows of one metric's closed windows, with their event time."""
    readings = watermarked_readings(messages, opts)
    width = opts.hr_window_minutes if metric == "hr" else opts.bp_window_minutes
    parts = W.window_partials(readings, width, (metric,), event_time=EVENT_TIME)
    if metric == "hr":
        return A.hr_alert_rows(W.hr_result(parts, opts, keep=(EVENT_TIME,)), keep=(EVENT_TIME,))
    return A.bp_alert_rows(W.bp_result(parts, opts, keep=(EVENT_TIME,)), opts, keep=(EVENT_TIME,))


def correlated_stream(hr_messages: DataFrame, bp_messages: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    """Interval join of the two alert streams; the windows must have one width.

    The event time of an alert is its window's end (less a microsecond)."""
    if opts.hr_window_minutes != opts.bp_window_minutes:
        raise ValueError("alerts of windows of one width are correlated")
    hr = C.side(alert_stream(hr_messages, "hr", opts), "hr", F.col(EVENT_TIME).alias("hr_time"))
    bp = C.side(alert_stream(bp_messages, "bp", opts), "bp", F.col(EVENT_TIME).alias("bp_time")).withColumnRenamed("user_id", "bp_user")
    lag = F.expr(f"INTERVAL {int(opts.correlation_minutes)} MINUTES")
    near = (F.col("bp_time") >= F.col("hr_time") - lag) & (F.col("bp_time") <= F.col("hr_time") + lag)
    return C.correlated_rows(hr.join(bp, (F.col("user_id") == F.col("bp_user")) & near, "inner"))


def start_correlation(
    spark: SparkSession, hr_messages: DataFrame, bp_messages: DataFrame, root: str, opts: Options = DEFAULT, name: str = "correlation", trigger: dict | None = None
) -> StreamingQuery:
    pin(spark)
    return _start(spark, correlated_stream(hr_messages, bp_messages, opts), root, TB.CORRELATED, opts, name, trigger)


def drain_correlation(spark: SparkSession, messages: DataFrame, root: str, since: str, opts: Options = DEFAULT, name: str = "correlation") -> None:
    """Pairs of which a window ends after ``since``, the stream's last watermark;
    only messages that such a pair can need are read into windows."""
    mark = F.lit(since).cast("timestamp")
    reach = F.make_dt_interval(mins=F.lit(opts.hr_window_minutes + opts.correlation_minutes))
    readings = parse_health(messages, opts).where(F.col("ts") >= mark - reach)
    # the earliest window of the span may be cut; no pair of this drain has it
    p = W.window_partials(readings, opts.hr_window_minutes, ("hr", "bp")).where(F.col("window_start") >= mark - reach)
    p = p.persist()  # the messages are parsed once for both metrics
    try:
        rows = C.multi_metric_alerts(A.hr_alert_rows(W.hr_result(p, opts)), A.bp_alert_rows(W.bp_result(p, opts), opts), opts).where(F.col("time") > mark)
        TB.append_if_absent(spark, rows, root, TB.CORRELATED, writer=f"{name}-drain", assume_unique=True)
    finally:
        p.unpersist()
