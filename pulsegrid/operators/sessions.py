"""Session windows: a user's readings with gaps of at most ``gap`` between them.

Batch form, exact and without a sort of raw readings: readings are first reduced
to panes as wide as the gap (readings of one pane can't be in two sessions), so a
hot user is one row per pane and task before anything is shuffled. Gaps between
panes are found within (user, bucket of panes); sessions that do not touch an
edge of their bucket are complete, and the others (two a bucket at most) are
stitched in time order per user. ``session_stream`` is the streaming form, on
Spark's session windows, whose states merge as readings fill a gap.

A session ends ``gap`` after its last reading; a reading at that very moment still
belongs to it. Readings without a user or a time, and invalid ones, are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..options import DEFAULT, Options
from .windows import _r2, far_sum, mean, near_sum

PANES = 256  # panes of a bucket
SUMS = ("n", "hr_n", "hr_sum", "hr_far")


def _aggregates() -> list:
    hr = F.when(F.col("heart_rate") > 0, F.col("heart_rate"))
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(hr).alias("hr_n"),
        near_sum(hr).alias("hr_sum"),
        far_sum(hr).alias("hr_far"),
        F.min(hr).alias("hr_min"),
        F.max(hr).alias("hr_max"),
    ]


def _merged() -> list:
    sums = [F.sum(c).cast("decimal(38,9)").alias(c) if c == "hr_sum" else F.sum(c).alias(c) for c in SUMS]
    return [F.min("first").alias("first"), F.max("last").alias("last"), *sums, F.min("hr_min").alias("hr_min"), F.max("hr_max").alias("hr_max")]


def _usable(readings: DataFrame) -> DataFrame:
    valid = F.col("valid") == 1 if "valid" in readings.columns else F.lit(True)
    return readings.where(valid & F.col("user_id").isNotNull() & F.col("ts").isNotNull())


def _islands(rows: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """``island``: a new one after each gap, in time order within ``keys``."""
    w = Window.partitionBy(*keys).orderBy("first")
    opens = F.coalesce(F.col("first") - F.lag("last").over(w) > gap, F.lit(True))
    return rows.withColumn("opens", opens.cast("int")).withColumn("island", F.sum("opens").over(w))


def session_partials(readings: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    """One row per session: user_id, first and last reading (microseconds), sums."""
    gap = opts.session_gap_minutes * 60_000_000
    us = F.unix_micros("ts")
    pane = F.floor(us / F.lit(gap)).cast("long")
    panes = _usable(readings).withColumn("us", us).groupBy("user_id", pane.alias("pane"))
    panes = panes.agg(F.min("us").alias("first"), F.max("us").alias("last"), *_aggregates())
    panes = panes.withColumn("bucket", F.floor(F.col("pane") / PANES).cast("long"))
    pieces = _islands(panes, ["user_id", "bucket"], gap).groupBy("user_id", "bucket", "island").agg(*_merged())
    newest = F.max("island").over(Window.partitionBy("user_id", "bucket"))
    inner = (F.col("island") > 1) & (F.col("island") < newest)
    # complete sessions stay by bucket; pieces at an edge meet under one slot
    pieces = pieces.withColumn("slot", F.when(inner, F.col("bucket"))).drop("bucket", "island")
    return _islands(pieces, ["user_id", "slot"], gap).groupBy("user_id", "slot", "island").agg(*_merged()).drop("slot", "island")


def session_rows(sessions: DataFrame) -> DataFrame:
    """user_id, session_start, session_end and sums → rows of the sessions table."""
    return sessions.select(
        F.col("session_end").alias("time"),
        "user_id",
        "session_start",
        "session_end",
        F.col("n").cast("long").alias("reading_count"),
        _r2(mean(F.col("hr_sum"), F.col("hr_far"), F.col("hr_n"))).alias("avg_heart_rate"),
        F.col("hr_min").cast("double").alias("min_heart_rate"),
        F.col("hr_max").cast("double").alias("max_heart_rate"),
    )


def user_sessions(readings: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    """Sessions of every user with their heart-rate summary."""
    gap = opts.session_gap_minutes * 60_000_000
    p = session_partials(readings, opts)
    return session_rows(p.withColumns({"session_start": F.timestamp_micros("first"), "session_end": F.timestamp_micros(F.col("last") + gap)}))


def session_stream(readings: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    """Watermarked readings → closed sessions (append mode)."""
    w = F.session_window("ts", f"{opts.session_gap_minutes} minutes")
    rows = _usable(readings).groupBy("user_id", w.alias("w")).agg(*_aggregates())
    return rows.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *SUMS, "hr_min", "hr_max")
