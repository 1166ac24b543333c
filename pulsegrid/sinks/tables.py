"""Result tables: schemas, creation, idempotent insert-if-absent appends.

Tables are Parquet folders partitioned by ``date`` (the day of ``time``),
which plays the role of the time-partitioned tables of the source system:
a batch only reads back the partitions of its own dates (partition
pruning), and per-partition Parquet min/max statistics stand in for the
time-ordered secondary indexes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

METRICS_1MIN = "health_metrics_1min"
METRICS_10MIN = "health_metrics_10min"
ALERTS = "health_alerts"
SESSIONS = "user_sessions"
CORRELATED = "multi_metric_alerts"

TABLE_SCHEMAS = {
    METRICS_1MIN: S.METRIC,
    METRICS_10MIN: S.METRIC,
    ALERTS: S.ALERT,
    SESSIONS: S.SESSION,
    CORRELATED: S.CORRELATED,
    "virtual_wearables": S.RAW_TABLE,
    "virtual_restaurants": S.RAW_TABLE,
    "virtual_gps": S.RAW_TABLE,
}
TABLE_KEYS = {METRICS_1MIN: S.METRIC_KEY, METRICS_10MIN: S.METRIC_KEY, ALERTS: S.ALERT_KEY, SESSIONS: S.SESSION_KEY, CORRELATED: S.CORRELATED_KEY}
PARTITION_COL = "date"


def _time_col(name: str) -> str:
    return "ingested_at" if name.startswith("virtual_") else "time"


WRITER_COL = "writer"


def full_schema(name: str) -> T.StructType:
    """Table columns plus the partition columns ``writer`` and ``date``."""
    return T.StructType(
        TABLE_SCHEMAS[name].fields + [T.StructField(WRITER_COL, T.StringType()), T.StructField(PARTITION_COL, T.DateType())]
    )


def table_path(root: str, name: str, writer: str | None = None) -> str:
    """Folder of a table, or of one writer's part of it.

    Concurrent streaming queries appending to one folder would share the
    committer's ``_temporary`` folder and break each other's commits; every
    writer therefore appends under its own ``writer=<id>`` sub-partition.
    Readers see one table with ``writer`` and ``date`` partition columns."""
    base = f"{root.rstrip('/')}/{name}"
    return f"{base}/{WRITER_COL}={writer}" if writer else base


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read a result table (all writers, all dates) with its fixed schema; a
    table that nobody has written yet is empty."""
    base = table_path(root, name)
    try:
        return spark.read.schema(full_schema(name)).option("basePath", base).parquet(base)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full_schema(name))


def create_table(spark: SparkSession, root: str, name: str, writer: str = "main") -> str:
    """Create a table part if absent (Spark writes it without rows); return
    its path."""
    path = table_path(root, name, writer)
    empty = with_partition(spark.createDataFrame([], TABLE_SCHEMAS[name]), name)
    empty.write.mode("append").partitionBy(PARTITION_COL).parquet(path)
    return path


def create_all(spark: SparkSession, root: str) -> dict[str, str]:
    return {n: create_table(spark, root, n) for n in TABLE_SCHEMAS}


def with_partition(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(PARTITION_COL, F.to_date(F.col(_time_col(name))))


def dedupe_first(batch: DataFrame, key: tuple[str, ...], order_col: str | None = None) -> DataFrame:
    """One row per key: the first by ``order_col`` (arrival order).

    ``min_by`` over a struct of all columns is a partial aggregate, so
    duplicates of a hot key are combined map-side before the exchange.
    """
    if order_col is None:
        return batch.dropDuplicates(list(key))
    others = [c for c in batch.columns if c not in key]
    agg = batch.groupBy(*key).agg(F.min_by(F.struct(*others), F.col(order_col)).alias("_r"))
    return agg.select(*key, *[F.col("_r")[c].alias(c) for c in others]).select(*batch.columns)


def insert_if_absent(
    target: DataFrame, batch: DataFrame, key: tuple[str, ...], order_col: str | None = None, assume_unique: bool = False
) -> DataFrame:
    """Rows of ``batch`` to append: first per key, and only keys the target
    does not hold yet (``ON CONFLICT DO NOTHING``). ``assume_unique`` skips
    the de-duplication shuffle for batches that are unique per key by
    construction (rows straight out of a ``groupBy`` on the key)."""
    first = batch if assume_unique else dedupe_first(batch, key, order_col)
    return first.join(target.select(*key), list(key), "left_anti")


def append_if_absent(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    name: str,
    order_col: str | None = None,
    writer: str = "main",
    assume_unique: bool = False,
    held: bool = False,
) -> None:
    """Idempotent append of ``batch`` into table ``name`` (a replayed batch
    adds nothing). Keys are checked against the whole table — every
    writer's part — but only for the batch's dates: its first and last date
    prune the target scan to the ``date`` partitions between them. The batch
    is held meanwhile, so that whatever made it runs once; one whose rows
    are held already costs no second copy if its caller says so (``held``)."""
    b = with_partition(batch, name)
    if held:
        _append_new(spark, b, root, name, order_col, writer, assume_unique)
        return
    b = b.persist()
    try:
        _append_new(spark, b, root, name, order_col, writer, assume_unique)
    finally:
        b.unpersist()


def _append_new(spark: SparkSession, b: DataFrame, root: str, name: str, order_col: str | None, writer: str, assume_unique: bool) -> None:
    path = table_path(root, name, writer)
    key = TABLE_KEYS[name]
    first, last = b.select(F.unix_date(F.min(PARTITION_COL)), F.unix_date(F.max(PARTITION_COL))).first()
    target = read_table(spark, root, name).drop(WRITER_COL)
    day = lambda n: F.date_from_unix_date(F.lit(n).cast("int"))
    target = target.where(F.col(PARTITION_COL).between(day(first), day(last)))
    new = insert_if_absent(target, b, key + (PARTITION_COL,), order_col, assume_unique)
    if order_col is not None and order_col not in TABLE_SCHEMAS[name].fieldNames():
        new = new.drop(order_col)
    new = new.select(*TABLE_SCHEMAS[name].fieldNames(), PARTITION_COL)
    new.write.mode("append").partitionBy(PARTITION_COL).parquet(path)


def register_views(spark: SparkSession, root: str, raw_root: str | None = None) -> list[str]:
    """Expose the result tables (and the raw topic tables) as temp views so
    guarded ad-hoc SELECTs can reach them by their usual names."""
    names = []
    for n in (METRICS_1MIN, METRICS_10MIN, ALERTS, SESSIONS, CORRELATED):
        read_table(spark, root, n).createOrReplaceTempView(n)
        names.append(n)
    if raw_root:
        raw = spark.read.parquet(raw_root)
        for t in ("virtual_wearables", "virtual_restaurants", "virtual_gps"):
            raw.filter(F.col("table") == t).drop("table", "ingest_date").createOrReplaceTempView(t)
            names.append(t)
    return names
