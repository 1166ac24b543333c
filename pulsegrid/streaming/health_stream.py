"""The health stream job on Structured Streaming.

``source → parse → withWatermark → groupBy(window, user) → foreachBatch``.
One query per window width (HR + BP share the short width, sugar uses the
long one). Each micro-batch writes METRIC rows insert-if-absent and ALERT
rows keyed by (window_start, user_id, alert_type), so a replayed batch after
a failure changes nothing (exactly-once effect on top of the checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import alerts as A
from ..operators import windows as W
from ..operators.parse import parse_health
from ..options import DEFAULT, Options
from ..session import checkpoint_dir, pin, stream_conf
from ..sinks import tables as TB
from . import counters as CO


def watermarked_readings(messages: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    """Parse and attach the event-time watermark (rows later than the
    watermark are dropped and counted by Spark as late rows)."""
    r = parse_health(messages, opts)
    if opts.time_mode == "processing":
        r = r.withColumn("ts", F.current_timestamp())
    return r.withWatermark("ts", opts.watermark_delay)


def _width_groups(opts: Options) -> dict[int, tuple[str, ...]]:
    g: dict[int, list[str]] = {}
    for m, w in (("hr", opts.hr_window_minutes), ("bp", opts.bp_window_minutes), ("sugar", opts.sugar_window_minutes)):
        g.setdefault(w, []).append(m)
    return {w: tuple(ms) for w, ms in g.items()}


def window_stream(readings: DataFrame, minutes: int, metrics: tuple[str, ...]) -> DataFrame:
    """Streaming window partials; in append mode a window is emitted once,
    when the watermark passes its end."""
    return W.window_partials(readings, minutes, metrics)


_BUILD = {"hr": (W.hr_result, A.hr_metric_rows, A.hr_alert_rows), "bp": (W.bp_result, A.bp_metric_rows, None), "sugar": (W.sugar_result, A.sugar_metric_rows, A.sugar_alert_rows)}


def results_from_partials(partials: DataFrame, metrics: tuple[str, ...], opts: Options) -> tuple[DataFrame, DataFrame]:
    """Window partials → (METRIC rows, ALERT rows) for the given metrics."""
    mets, alerts = [], []
    for m in metrics:
        res, mrows, arows = _BUILD[m]
        r = res(partials, opts)
        mets.append(mrows(r))
        alerts.append(A.bp_alert_rows(r, opts) if m == "bp" else arows(r))
    return A.union_all(mets), A.union_all(alerts)


def table_for(metrics: tuple[str, ...]) -> str:
    return TB.METRICS_10MIN if metrics == ("sugar",) else TB.METRICS_1MIN


def sink_batch(spark: SparkSession, root: str, metrics: tuple[str, ...], width: int, opts: Options):
    """``foreachBatch`` body: idempotent writes of metrics then alerts. A
    crash between the two heals on replay: each write is keyed."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        held = batch.persist()  # both tables are written from one evaluation
        try:
            write_partials(spark, held, root, metrics, f"w{width}", opts)
        finally:
            held.unpersist()

    return write


def write_partials(spark: SparkSession, partials: DataFrame, root: str, metrics: tuple[str, ...], writer: str, opts: Options) -> None:
    """Both tables' rows; ``partials`` are held by the caller."""
    mets, alerts = results_from_partials(partials, metrics, opts)
    TB.append_if_absent(spark, mets, root, table_for(metrics), writer=writer, assume_unique=True, held=True)
    TB.append_if_absent(spark, alerts, root, TB.ALERTS, writer=writer, assume_unique=True, held=True)


def start(
    spark: SparkSession,
    messages: DataFrame,
    root: str,
    opts: Options = DEFAULT,
    name: str = "health",
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Start one streaming query per window width; returns the queries. They
    observe the messages read and the alerts raised (``streaming.counters``)."""
    pin(spark)
    readings = watermarked_readings(messages, opts)
    queries = []
    for width, metrics in _width_groups(opts).items():
        own = readings if queries else CO.with_message_count(readings, name)  # messages count once
        parts = CO.with_alert_count(window_stream(own, width, metrics), metrics, f"{name}_{width}min", opts)
        ck = checkpoint_dir(spark, f"{name}-{width}min")
        w = parts.writeStream.outputMode("append").option("checkpointLocation", ck).foreachBatch(sink_batch(spark, root, metrics, width, opts))
        w = w.trigger(**(trigger or {"processingTime": f"{opts.flush_interval_seconds} seconds"}))
        with stream_conf(spark, opts.state_partitions):
            queries.append(w.queryName(f"{name}_{width}min").start())
    return queries


def start_results(spark: SparkSession, results: DataFrame, root: str, opts: Options = DEFAULT, name: str = "results", trigger: dict | None = None) -> StreamingQuery:
    """Route a stream of METRIC rows to the tables by ``metric_type``; rows of
    unknown types are counted (``streaming.counters``) and not stored."""
    pin(spark)

    def write(batch: DataFrame, epoch_id: int) -> None:
        held = batch.persist()  # both tables are written from one evaluation
        try:
            routed = A.route_results(held)
            for part, table in (("1min", TB.METRICS_1MIN), ("10min", TB.METRICS_10MIN)):
                TB.append_if_absent(batch.sparkSession, routed[part], root, table, order_col="time", writer=name, held=True)
        finally:
            held.unpersist()

    stream = CO.with_unknown_count(results, name).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir(spark, name))
    stream = stream.trigger(**(trigger or {"processingTime": f"{opts.flush_interval_seconds} seconds"})).queryName(name)
    with stream_conf(spark, opts.state_partitions):
        return stream.start()


def drain(spark: SparkSession, messages_batch: DataFrame, root: str, opts: Options = DEFAULT, since=None, counted: bool = False) -> None:
    """Flush the windows still open when a stream stops (shutdown flush).

    Append mode keeps the newest windows open (their end is past the
    watermark). With ``since``, the stream's last watermark (``watermark_of``),
    a batch pass over the messages from one window before it writes the
    windows that end after it and no others: what the stream should have
    written itself is left to it. Without ``since`` every window is written
    insert-if-absent (a rebuild from stored messages). Only the table
    partitions of the batch's dates are read back. ``counted`` adds the alerts
    of the windows written to the job's counters.
    """
    readings, held, widths = parse_health(messages_batch, opts), None, _width_groups(opts)
    if since is not None:  # what any width needs is parsed once
        mark = F.lit(since).cast("timestamp")
        held = readings = readings.filter(F.col("ts") >= mark - F.make_dt_interval(mins=F.lit(max(widths)))).persist()
    try:
        for width, metrics in widths.items():
            own = readings
            if since is not None:
                own = own.filter(F.col("ts") >= mark - F.make_dt_interval(mins=F.lit(width)))
            parts = W.window_partials(own, width, metrics)
            if since is not None:
                parts = parts.filter(F.col("window_end") > mark)
            parts = parts.persist()  # folded once a width, whatever is written of them
            try:
                if counted:
                    found = parts.agg(F.coalesce(F.sum(CO.alerts_in(metrics, opts)), F.lit(0)).alias("n")).first()["n"]
                    CO.add_counts(spark, root, f"drain_{width}min", CO.DRAIN, {CO.ALERTS: found})
                write_partials(spark, parts, root, metrics, f"w{width}", opts)
            finally:
                parts.unpersist()
    finally:
        if held is not None:
            held.unpersist()


def watermark_of(query: StreamingQuery) -> str | None:
    """The last watermark of a query that has stopped (ISO text, UTC)."""
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p.get("eventTime", {})]
    return max(marks, default=None)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as later than the watermark, summed over the stateful
    operators, in the most recent micro-batch progress."""
    prog = query.lastProgress or {}
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in prog.get("stateOperators", []))


def console(df: DataFrame, name: str = "debug") -> StreamingQuery:
    """Debug print of a stream (the source job's print sinks)."""
    return df.writeStream.format("console").option("truncate", "false").queryName(name).start()
