"""Session helpers: pinned runtime settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime settings every query relies on. Window bounds are UTC (times are
# stored without zone in the source tables), so the session zone is pinned.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state is kept off the JVM heap, and a batch uploads its changes only.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Session settings for a large cluster (set when the session is built; the
# values are starting points for ~100 TB inputs on ~1000 executors):
# shuffle partitions sized by AQE from a high initial count, ~256 MB
# partitions after coalescing, skew splitting and 256 MB scan splits.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def pin(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine depends on (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession, sub: str = "") -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set (to shared storage) when the session is built;
    it is a static setting and is only read here. A session without one
    (an ad-hoc local session) gets a folder under the system temp folder,
    registered on the SparkContext.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the setting must be given
        sc = None
    if sc is not None:
        base = base or sc.getCheckpointDir()
        if not base:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="pulsegrid-ckpt-"))
            base = sc.getCheckpointDir()
        elif not sc.getCheckpointDir():
            sc.setCheckpointDir(base)
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set")
    return os.path.join(base, sub) if sub else base


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pulsegrid") -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local sessions only: a private checkpoint folder (clusters name a shared one)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pulsegrid-ckpt-"))
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class conf_while(object):
    """Set runtime SQL settings for the duration of a ``with`` block (e.g.
    while a streaming query starts: the query snapshots the session
    settings at ``start()``), then restore them."""

    def __init__(self, spark: SparkSession, **settings):
        self.spark = spark
        self.settings = {k.replace("__", "."): v for k, v in settings.items() if v is not None}
        self.saved = {}

    def __enter__(self):
        for k, v in self.settings.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, str(v))
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def stream_conf(spark: SparkSession, state_partitions: int | None) -> conf_while:
    return conf_while(spark, spark__sql__shuffle__partitions=state_partitions)
