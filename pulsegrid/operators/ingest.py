"""Ingestion: Kafka metadata enrichment, routing to per-topic raw tables,
per-topic consumption statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import options as O
from ..functions import jsonx as J


def enrich(kafka: DataFrame, now: Column | None = None) -> DataFrame:
    """Kafka rows (``topic, partition, offset, value``) → ENVELOPE rows.

    ``ingested_at`` is the processing time of the micro-batch.
    """
    return kafka.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        F.lit(O.INGESTION_PROTOCOL).alias("ingestion_protocol"),
        (now if now is not None else F.current_timestamp()).alias("ingested_at"),
        F.col("value").cast("string").alias("raw_data"),
    )


def topic_to_table(topic: Column) -> Column:
    """``virtual-wearables`` → ``virtual_wearables``."""
    return F.translate(topic, "-", "_")


def device_id(raw_data: Column) -> Column:
    """``device_id`` of the JSON payload; ``unknown`` when missing, null, or
    when the payload is not a JSON object."""
    return F.coalesce(J.get(J.parse(raw_data), "$.device_id", "string"), F.lit("unknown"))


def raw_rows(envelopes: DataFrame) -> DataFrame:
    """ENVELOPE rows → raw-table rows: ``table``, ``device_id`` + envelope,
    plus ``ingest_date`` for date partitioning. The JSON text is stored as
    received (no re-serialisation)."""
    return envelopes.select(
        topic_to_table(F.coalesce(F.col("kafka_topic"), F.lit("unknown"))).alias("table"),
        device_id(F.col("raw_data")).alias("device_id"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        F.coalesce(F.col("ingestion_protocol"), F.lit(O.INGESTION_PROTOCOL)).alias("ingestion_protocol"),
        F.coalesce(F.col("ingested_at"), F.current_timestamp()).alias("ingested_at"),
        "raw_data",
    ).withColumn("ingest_date", F.to_date("ingested_at"))


def topic_stats(envelopes: DataFrame) -> DataFrame:
    """Per topic: messages consumed, last message time, last offset seen.

    "Last" is the latest message by (ingested_at, partition, offset); one
    partial aggregate per topic, so a hot topic is combined map-side.
    """
    return envelopes.groupBy("kafka_topic").agg(
        F.count(F.lit(1)).alias("messages_consumed"),
        F.max("ingested_at").alias("last_message"),
        F.max_by("kafka_offset", F.struct("ingested_at", "kafka_partition", "kafka_offset")).alias("last_offset"),
    )


def kafka_value_json(df: DataFrame, device_type_col: str = "device_type", key_col: str = "device_id") -> DataFrame:
    """Rows → Kafka sink shape: ``key`` = device id, ``value`` = JSON of the
    row (null fields kept), ``topic`` by device type with a ``virtual-{type}`` fallback."""
    topic = (
        F.when(F.col(device_type_col) == "wearable", F.lit(O.TOPIC_WEARABLES))
        .when(F.col(device_type_col) == "restaurant", F.lit(O.TOPIC_RESTAURANTS))
        .when(F.col(device_type_col) == "gps", F.lit(O.TOPIC_GPS))
        .otherwise(F.concat(F.lit(O.TOPIC_FALLBACK_PREFIX), F.col(device_type_col)))
    )
    return df.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"),
        topic.alias("topic"),
    )
