"""Joins in time per key: within a span, point in interval, and as of.

None of them sorts or gathers a whole key: a key that holds a third of all rows
is spread over its time bins or buckets, and rows only meet in the bin where they
can match. Keys or times that are null match nothing.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICRO = timedelta(microseconds=1)
#: Intervals shorter than 2**20 microseconds (about a second) share a level.
LEAST_LEVEL = 20


def _us(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def interval_join(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, before: timedelta, after: timedelta) -> DataFrame:
    """Pairs of rows of one key with ``right_time`` from ``left_time - before`` to
    ``left_time + after`` (both ends count). Other columns must differ in name.

    Time is cut into bins of the span's width. The span of a left row lies in
    two bins, a right row in one, so every pair meets exactly once."""
    low, width = before // MICRO, max(1, (before + after) // MICRO)
    first = F.floor((_us(left_time) - low) / F.lit(width)).cast("long")
    a = left.where(F.col(on).isNotNull() & F.col(left_time).isNotNull()).withColumn("_bin", F.explode(F.array(first, first + 1)))
    b = right.where(F.col(on).isNotNull() & F.col(right_time).isNotNull()).withColumn("_bin", F.floor(_us(right_time) / F.lit(width)).cast("long"))
    gap = _us(right_time) - _us(left_time)
    return a.join(b, [on, "_bin"]).where((gap >= -low) & (gap <= after // MICRO)).drop("_bin")


def range_join(points: DataFrame, intervals: DataFrame, on: str, time: str, start: str, end: str) -> DataFrame:
    """Pairs of rows of one key with ``start <= time < end``. Other columns must
    differ in name.

    An interval is put in bins of its own level: the least power of two that
    covers its length, so long ones are not copied to many bins and short ones
    do not meet many points. A point looks in one bin per level that occurs (a
    few: levels are the logarithm of lengths)."""
    length = _us(end) - _us(start)
    own = intervals.where(F.col(on).isNotNull() & (length > 0)).withColumn("_level", F.greatest(F.ceil(F.log2(length)).cast("int"), F.lit(LEAST_LEVEL)))
    levels = sorted(r["_level"] for r in own.select("_level").distinct().collect())
    own = own.withColumns({"_a": _us(start), "_b": _us(end) - 1})
    own = own.withColumn("_bin", F.explode(F.expr("sequence(shiftright(_a, _level), shiftright(_b, _level))"))).drop("_a", "_b")
    at = points.where(F.col(on).isNotNull() & F.col(time).isNotNull())
    at = at.withColumn("_level", F.explode(F.lit(levels).cast("array<int>"))).withColumn("_us", _us(time))
    at = at.withColumn("_bin", F.expr("shiftright(_us, _level)")).drop("_us")
    inside = (_us(start) <= _us(time)) & (_us(time) < _us(end))
    return at.join(own, [on, "_level", "_bin"]).where(inside).drop("_level", "_bin")


def as_of_join(
    left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, tie: str, tolerance: timedelta | None = None,
    bucket: timedelta = timedelta(hours=1),
) -> DataFrame:
    """Every left row with the last right row of its key at or before its time
    (of equal times the largest ``tie``), nulls where there is none or it is
    more than ``tolerance`` older. Other columns must differ in name.

    Both sides are one sorted run per (key, bucket), in which the last right row
    so far is carried along. Rows before the first right row of their bucket
    take the last one of the buckets before, from a table of one row per bucket."""
    width = max(1, bucket // MICRO)
    carried = [c for c in right.columns if c != on]
    some = right.where(F.col(on).isNotNull() & F.col(right_time).isNotNull())
    r = some.select(on, _us(right_time).alias("_us"), F.lit(0).alias("_side"), F.struct(*carried).alias("_r"), F.lit(None).cast(_struct(left)).alias("_l"))
    l = left.select(on, _us(left_time).alias("_us"), F.lit(1).alias("_side"), F.lit(None).cast(_struct(right.select(*carried))).alias("_r"), F.struct(*left.columns).alias("_l"))
    both = r.unionByName(l).withColumn("_bucket", F.floor(F.col("_us") / F.lit(width)).cast("long"))
    order = (F.col("_us"), F.col("_side"), F.col("_r")[tie])
    so_far = Window.partitionBy(on, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_in", F.last("_r", ignorenulls=True).over(so_far)).where("_side = 1")

    newest = F.max(F.when(F.col("_side") == 0, F.struct(F.col("_us"), F.col("_r")[tie].alias("_tie"), F.col("_r"))))
    ends = both.where(F.col(on).isNotNull() & F.col("_bucket").isNotNull()).groupBy(on, "_bucket").agg(newest.alias("_end"))
    before = Window.partitionBy(on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    links = ends.select(on, "_bucket", F.last("_end", ignorenulls=True).over(before)["_r"].alias("_before"))
    found = found.join(links, [on, "_bucket"], "left").withColumn("_got", F.coalesce("_in", "_before"))
    if tolerance is not None:
        near = F.col("_us") - F.unix_micros(F.col("_got")[right_time].cast("timestamp")) <= tolerance // MICRO
        found = found.withColumn("_got", F.when(near, F.col("_got")))
    return found.select(*[F.col("_l")[c].alias(c) for c in left.columns], *[F.col("_got")[c].alias(c) for c in carried])


def _struct(df: DataFrame) -> str:
    return df.schema.simpleString()
