"""Stream sources: Kafka (value-only, multi-topic with metadata) and files.

The Kafka connector JAR is not bundled; ``kafka_options`` builds the option
map (checked in tests) and ``kafka_*_stream`` apply it when the connector
is on the classpath. File sources replay stored messages in time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import DEFAULT, Options


def kafka_options(
    opts: Options = DEFAULT, topics: tuple[str, ...] | None = None, starting: str = "latest", group: str | None = None
) -> dict[str, str]:
    """Options for ``format("kafka")``: brokers, topic list, starting offsets.

    ``group`` prefixes the consumer groups Spark makes, one per query (a fixed
    group id would be shared by a job's queries). Offsets that are gone fail
    the query, and a batch takes all that has arrived unless
    ``max_offsets_per_trigger`` is set."""
    t = topics if topics is not None else (opts.health_topic,)
    out = {
        "kafka.bootstrap.servers": opts.kafka_bootstrap_servers,
        "subscribe": ",".join(t),
        "startingOffsets": starting,
        "groupIdPrefix": group or opts.health_group,
    }
    if opts.max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(opts.max_offsets_per_trigger)
    return out


def kafka_value_stream(spark: SparkSession, opts: Options = DEFAULT) -> DataFrame:
    """One topic, values as text (the stream job's source)."""
    raw = spark.readStream.format("kafka").options(**kafka_options(opts)).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp"))


def kafka_records_stream(spark: SparkSession, opts: Options = DEFAULT) -> DataFrame:
    """Several topics, keeping topic / partition / offset (ingestion source)."""
    raw = spark.readStream.format("kafka").options(**kafka_options(opts, opts.topics, group=opts.ingest_group)).load()
    return raw.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"), "timestamp")


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Files as a stream; all new files make one micro-batch unless a number
    per trigger is given."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def time_slices(df: DataFrame, ts_col: str, slices: int) -> list[DataFrame]:
    """``df`` cut into ``slices`` equal spans of time, oldest first. Written
    one after another they replay in time order on any file system, each by
    as many tasks as the data asks for. Rows without a time are in the first."""
    low, high = df.select(F.unix_micros(F.min(ts_col)), F.unix_micros(F.max(ts_col))).first()
    if low is None:
        return [df]
    at = F.unix_micros(ts_col)
    cuts = [low + (high + 1 - low) * k // slices for k in range(slices + 1)]
    spans = [(at >= a) & (at < b) for a, b in zip(cuts, cuts[1:])]
    return [df.filter(spans[0] | at.isNull()), *map(df.filter, spans[1:])]


def kafka_sink_options(opts: Options = DEFAULT) -> dict[str, str]:
    """Producer settings of the device sink: brokers, acks from all
    replicas, three retries. The topic comes from each row's ``topic``."""
    return {
        "kafka.bootstrap.servers": opts.kafka_bootstrap_servers,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }


def write_kafka(df: DataFrame, opts: Options = DEFAULT) -> None:
    """Write rows shaped by ``operators.ingest.kafka_value_json`` (``key``,
    ``value``, ``topic``) to Kafka (needs the Kafka connector on the
    classpath)."""
    df.select("key", "value", "topic").write.format("kafka").options(**kafka_sink_options(opts)).save()
