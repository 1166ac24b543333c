"""Counters of running jobs: messages, alerts, result rows of unknown type.

The jobs observe their streams (aggregates that ride along with a micro-batch);
``CounterListener`` writes what each batch observed to the counters table, a row
per (job, batch, counter). A batch that runs again after a failure has the same
number and counts once, and a restarted job goes on from its checkpoint's numbers,
so the sums hold over batches and restarts.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import options as O
from ..operators import windows as W
from ..options import Options

COUNTERS = "job_counters"
SCHEMA = "job string, batch long, counter string, value long"
PREFIX = "counted_"
MESSAGES, ALERTS, UNKNOWN = "messages_processed", "alerts_generated", "unknown_types"
DRAIN = -1  # batch number of what a job's shutdown flush adds


def with_message_count(readings: DataFrame, job: str) -> DataFrame:
    return readings.observe(PREFIX + job + "_messages", F.count(F.lit(1)).alias(MESSAGES))


def alerts_in(metrics: tuple[str, ...], opts: Options):
    """Alerts that a row of window partials raises, as a column."""
    made = {
        "hr": lambda: (F.col("_hr_n") > 0) & W._hr_alert(F.col("_hr_avg"), opts).isNotNull(),
        "bp": lambda: (F.col("_bp_n") > 0) & W._bp_alert(F.col("_bp_sys"), F.col("_bp_dia"), opts).isNotNull(),
        "sugar": lambda: (F.col("_su_n") > 0) & W._sugar_alert(F.col("_su_avg"), opts).isNotNull(),
    }
    return sum((F.coalesce(made[m](), F.lit(False)).cast("int") for m in metrics), F.lit(0))


def with_alert_count(partials: DataFrame, metrics: tuple[str, ...], job: str, opts: Options) -> DataFrame:
    return partials.observe(PREFIX + job + "_alerts", F.coalesce(F.sum(alerts_in(metrics, opts)), F.lit(0)).alias(ALERTS))


def unknown(results: DataFrame):
    """Result rows that no table takes (a null type is unknown too)."""
    return ~F.coalesce(F.col("metric_type").isin(O.METRIC_HR, O.METRIC_BP, O.METRIC_SUGAR), F.lit(False))


def with_unknown_count(results: DataFrame, job: str) -> DataFrame:
    return results.observe(PREFIX + job + "_unknown", F.count_if(unknown(results)).alias(UNKNOWN))


def _path(root: str) -> str:
    return f"{root.rstrip('/')}/{COUNTERS}"


def add_counts(spark: SparkSession, root: str, job: str, batch: int, counts: dict[str, int]) -> None:
    rows = [(job, batch, name, int(value)) for name, value in counts.items()]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(_path(root))


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    """Sums over all jobs and batches, one row; a counter nobody wrote is 0."""
    rows = spark.read.schema(SCHEMA).parquet(_path(root))
    once = rows.groupBy("job", "batch", "counter").agg(F.max("value").alias("value"))
    total = lambda c: F.coalesce(F.sum(F.when(F.col("counter") == c, F.col("value"))), F.lit(0)).cast("long").alias(c)
    return once.agg(total(MESSAGES), total(ALERTS), total(UNKNOWN))


class CounterListener(StreamingQueryListener):
    """Writes the observed counters of every micro-batch of named queries."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics or {}
        counts: dict[str, int] = {}
        for name, row in seen.items():
            if name.startswith(PREFIX):
                for counter, value in row.asDict().items():
                    counts[counter] = counts.get(counter, 0) + (value or 0)
        if counts:
            add_counts(self.spark, self.root, event.progress.name, event.progress.batchId, counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, timeout: float = 120) -> None:
        """Until all batches of a query that has ended are written (its end is
        told after its last batch)."""
        if not self._end(str(query.runId)).wait(timeout):
            raise TimeoutError(f"no end of {query.name} was told")


class counting:
    """``with counting(spark, root) as counters:`` counts the jobs inside."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.listener = spark, CounterListener(spark, root)

    def __enter__(self) -> CounterListener:
        self.spark.streams.addListener(self.listener)
        return self.listener

    def __exit__(self, *exc) -> bool:
        self.spark.streams.removeListener(self.listener)
        return False
