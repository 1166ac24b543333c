"""Skew-resistant "next row in time" per key.

``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one task;
a key holding a third of all rows would then be sorted by a single task.
Instead:

1. ``lead`` within ``(key, time bucket)`` — a hot key is spread over its
   buckets (hours by default) — and, in the same sorted pass, the bucket's
   first row;
2. the last row of each bucket (whose in-bucket ``lead`` is NULL) carries that
   first row: one row per ``(key, bucket)``, so small;
3. ``lead`` over those rows per key completes each with the first row of the
   next non-empty bucket. No aggregate, no join, no second read of the input.

The result equals ``lead`` over the whole key, ordered by ``(ts, tie)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_next(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    cols: tuple[str, ...],
    bucket: str = "hour",
    prefix: str = "next_",
) -> DataFrame:
    """Add ``next_<c>`` for ``c`` in ``(ts, tie) + cols``: the following row of
    the same ``key`` in ``(ts, tie)`` order, NULL for the last row."""
    carry = (ts, tie) + tuple(c for c in cols if c not in (ts, tie))
    b = df.withColumn("_bucket", F.date_trunc(bucket, F.col(ts)))
    w = Window.partitionBy(key, "_bucket").orderBy(F.col(ts), F.col(tie))
    inner = b.select(
        "*",
        *[F.lead(c).over(w).alias(prefix + c) for c in carry],
        F.lead(F.lit(True)).over(w).alias("_more"),
        F.first(F.struct(*[F.col(c) for c in carry])).over(w).alias("_first"),
    )
    done = inner.filter(F.col("_more").isNotNull()).drop("_more", "_first")
    across = F.lead("_first").over(Window.partitionBy(key).orderBy("_bucket"))
    tail = inner.filter(F.col("_more").isNull()).select(*b.columns, across.alias("_next"))
    tail = tail.select(*b.columns, *[F.col("_next")[c].alias(prefix + c) for c in carry])
    return done.unionByName(tail).drop("_bucket")
