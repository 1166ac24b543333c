"""Browsing the result tables: pages, totals, table statistics, latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import options as O


class BrowseError(ValueError):
    pass


def iso(ts: Column) -> Column:
    """Timestamp → ISO-8601 text with offset, as Python's ``isoformat`` on a
    UTC datetime (fraction omitted when the microseconds are zero)."""
    with_frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    no_frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    return F.when(ts.isNull(), F.lit(None)).when(F.unix_micros(ts) % 1_000_000 == 0, no_frac).otherwise(with_frac)


def render(df: DataFrame) -> DataFrame:
    """Timestamps → ISO text; ``raw_data`` text → parsed JSON (VARIANT).
    Names may repeat or hold dots: columns are taken by position."""
    placed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    cols = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"c{i}")
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            c = iso(c.cast("timestamp"))
        elif f.name == "raw_data":
            c = F.try_parse_json(c)
        cols.append(c.alias(f.name))
    return placed.select(*cols)


def page(
    table: DataFrame,
    limit: int = O.BROWSE_DEFAULT_LIMIT,
    offset: int = 0,
    device_id: str | None = None,
    order_col: str = "ingested_at",
    tie_breakers: tuple[str, ...] = ("kafka_partition", "kafka_offset"),
) -> DataFrame:
    """``ORDER BY ingested_at DESC LIMIT l OFFSET o`` with stable tie-breakers.

    Planned as a top-k (``TakeOrderedAndProject``): each task keeps its best
    ``offset + limit`` rows, so nothing but the page reaches the driver.
    """
    if limit > O.BROWSE_MAX_LIMIT or limit < 0:
        raise BrowseError(f"limit must be within 0..{O.BROWSE_MAX_LIMIT}")
    if offset < 0:
        raise BrowseError("offset must be >= 0")
    df = table
    if device_id:
        df = df.filter(F.col("device_id") == F.lit(device_id))
    order = [F.col(order_col).desc()] + [F.col(c).desc() for c in tie_breakers]
    return df.orderBy(*order).offset(offset).limit(limit)


def total(table: DataFrame) -> Column:
    """Row count of the whole (unfiltered) table as a scalar subquery column."""
    return table.select(F.count(F.lit(1))).scalar()


def table_stats(spark: SparkSession, raw: DataFrame, tables=O.RAW_TABLES) -> DataFrame:
    """Per raw table: row count and latest ``ingested_at``; every known table
    is reported, empty ones with 0 rows.

    The statistics side has one row per topic table, so the outer join to
    the fixed list of table names is between two tiny sides.
    """
    stats = raw.groupBy("table").agg(F.count(F.lit(1)).alias("row_count"), F.max("ingested_at").alias("latest_record"))
    dim = spark.createDataFrame([(t,) for t in tables], "table string")
    return dim.join(stats, "table", "left").select(
        "table", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"), "latest_record"
    )


def latest(df: DataFrame, n: int, order_col: str = "time", tie_breakers: tuple[str, ...] = ()) -> DataFrame:
    """Latest ``n`` rows by ``order_col`` (top-k, ties broken deterministically)."""
    return df.orderBy(F.col(order_col).desc(), *[F.col(c).asc() for c in tie_breakers]).limit(n)


def browse_raw(
    spark: SparkSession,
    raw_root: str,
    table: str,
    limit: int = O.BROWSE_DEFAULT_LIMIT,
    offset: int = 0,
    device_id: str | None = None,
) -> tuple[DataFrame, Column]:
    """Page of a stored raw topic table (ingestion sink layout
    ``table=<name>/ingest_date=<d>/``) and its unfiltered total.

    Only known tables may be browsed. The table choice is a partition
    filter, so only that table's folders are scanned; the device filter is
    pushed into the Parquet scan."""
    if table not in O.RAW_TABLES:
        raise BrowseError(f"Table '{table}' not found")
    raw = spark.read.parquet(raw_root).filter(F.col("table") == table).drop("table", "ingest_date")
    return render(page(raw, limit, offset, device_id)), total(raw)
