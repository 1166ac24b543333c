"""Queries over ingestion and browsing: envelopes, routing, statistics, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import options as O
from ..operators import alerts as A
from ..operators import browse as B
from ..operators import ingest as I
from . import fixtures as X
from .common import TABLE_OPTS, ntz, prepare
from .health import readings


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw-topic rows (what the per-topic tables hold together)."""
    k = X.kafka_records(prepare(spark), sf_dir)
    return I.raw_rows(I.enrich(k, now=F.col("timestamp")))


def enriched_messages(spark, sf_dir):
    return ntz(raw_table(spark, sf_dir).drop("raw_data", "ingest_date"))


def topic_routing(spark, sf_dir):
    return raw_table(spark, sf_dir).groupBy("table", "ingest_date").agg(F.count(F.lit(1)).alias("rows"))


def kafka_sink_rows(spark, sf_dir):
    """Device messages as Kafka rows; the reading is null for every third event."""
    dev = X.device_messages(prepare(spark), sf_dir)
    rows = dev.select("device_id", "device_type", "event_id", F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 100).alias("reading"), "is_anomaly")
    return I.kafka_value_json(rows)


def topic_stats(spark, sf_dir):
    k = X.kafka_records(prepare(spark), sf_dir)
    return ntz(I.topic_stats(I.enrich(k, now=F.col("timestamp"))))


def table_stats(spark, sf_dir):
    return ntz(B.table_stats(spark, raw_table(spark, sf_dir)))


def _page(spark, sf_dir, limit, offset, device=None):
    raw = raw_table(spark, sf_dir).filter(F.col("table") == "virtual_wearables").drop("table", "ingest_date")
    p = B.page(raw, limit=limit, offset=offset, device_id=device)
    return B.render(p.drop("raw_data")).withColumn("total", B.total(raw))


def table_page(spark, sf_dir):
    """Page 3 (rows 101-150) of ``virtual_wearables`` newest first + table total."""
    return _page(spark, sf_dir, 50, 100)


def table_page_device(spark, sf_dir):
    """Device-filtered page; the total still counts the whole table."""
    return _page(spark, sf_dir, 10, 0, "wearable_3")


def table_page_json(spark, sf_dir):
    """A page of 100 rows with its payloads rendered as JSON; the columns are
    values inside the rendered payload, null where it isn't JSON or lacks them."""
    raw = raw_table(spark, sf_dir).filter(F.col("table") == "virtual_wearables").drop("table", "ingest_date")
    page = B.render(B.page(raw, limit=100))

    def inside(path: str, kind: str):
        return F.try_variant_get("raw_data", path, kind)

    return page.select(
        "kafka_offset",
        "ingested_at",
        F.col("raw_data").isNotNull().alias("is_json"),
        inside("$.is_anomaly", "string").alias("is_anomaly"),
        inside("$.user_id", "string").alias("user_id"),
        inside("$.blood_pressure.systolic", "double").alias("systolic"),
        inside("$.raw_data.user_id", "string").alias("wrapped_user_id"),
    )


def latest_metrics(spark, sf_dir):
    m = A.metric_rows(readings(spark, sf_dir), TABLE_OPTS, ("1min",))["1min"].filter(F.col("metric_type") == O.METRIC_HR)
    return ntz(B.latest(m, 20, "time", ("user_id",)))


def latest_alerts(spark, sf_dir):
    a = A.alert_rows(readings(spark, sf_dir), TABLE_OPTS)
    return ntz(B.latest(a, 20, "time", ("user_id", "alert_type")))


QUERIES = {
    "kafka_sink_rows": kafka_sink_rows,
    "enriched_messages": enriched_messages,
    "topic_routing": topic_routing,
    "topic_stats": topic_stats,
    "table_stats": table_stats,
    "table_page": table_page,
    "table_page_device": table_page_device,
    "table_page_json": table_page_json,
    "latest_metrics": latest_metrics,
    "latest_alerts": latest_alerts,
}
