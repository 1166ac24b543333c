"""Raw-topic ingestion on Structured Streaming.

Kafka (or replayed files) → enrich with topic / partition / offset /
protocol / ingestion time → per-topic raw tables, partitioned by table and
ingestion date. The file sink with a checkpoint is exactly-once (the source
offsets and the sink's commit log advance together), replacing the source
system's at-most-once auto-commit. Micro-batches are bounded by a trigger
interval and a per-trigger cap (the writer's batch size / flush interval).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ingest as I
from ..options import DEFAULT, Options
from ..session import checkpoint_dir, pin, stream_conf


def raw_stream(kafka_rows: DataFrame, replay: bool = False) -> DataFrame:
    """Kafka-shaped stream → raw-table rows (``table`` column routes them).

    Live ingestion stamps the processing time; a replay of stored records
    keeps each record's original time (its ``timestamp`` column)."""
    return I.raw_rows(I.enrich(kafka_rows, now=F.col("timestamp") if replay else None))


def observed(df: DataFrame, name: str = "ingest_counters") -> DataFrame:
    """Attach streaming counters (messages, distinct topics seen in the
    batch, unknown devices) reported in each batch's progress."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("device_id") == "unknown").alias("unknown_devices"),
    )


def start(
    spark: SparkSession,
    kafka_rows: DataFrame,
    root: str,
    opts: Options = DEFAULT,
    name: str = "ingest",
    trigger: dict | None = None,
    replay: bool = False,
) -> StreamingQuery:
    pin(spark)
    rows = observed(raw_stream(kafka_rows, replay))
    with stream_conf(spark, opts.state_partitions):
        return _start(spark, rows, root, opts, name, trigger)


def _start(spark, rows, root, opts, name, trigger):
    return (
        rows.writeStream.format("parquet")
        .option("path", root)
        .option("checkpointLocation", checkpoint_dir(spark, name))
        .partitionBy("table", "ingest_date")
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": f"{opts.flush_interval_seconds} seconds"}))
        .queryName(name)
        .start()
    )


def batch_counters(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Batch form of the counters: ``Observation`` filled when ``df`` runs."""
    obs = Observation("ingest_counters")
    return df.observe(obs, F.count(F.lit(1)).alias("messages")), obs
