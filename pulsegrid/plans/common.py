"""Shared pieces of the query catalogue: options used on the driver tables
and output normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import Options
from ..session import pin

# Readings in the driver tables are sparse (about 2.4 per user-day), so the
# catalogue uses windows of 1 day (HR, BP) and 10 days (sugar), keeping the
# 1:10 ratio of the default 1/1/10-minute widths.
DAY = 24 * 60
TABLE_OPTS = Options(
    hr_window_minutes=DAY, bp_window_minutes=DAY, sugar_window_minutes=10 * DAY, session_gap_minutes=DAY // 4, slide_minutes=600,
    correlation_minutes=DAY, baseline_bucket_minutes=DAY, baseline_buckets=7,
)
TABLE_OPTS_METRIC = TABLE_OPTS.with_(validity="metric")


def prepare(spark: SparkSession) -> SparkSession:
    return pin(spark)


def ntz(df: DataFrame) -> DataFrame:
    """Zoned timestamps → TIMESTAMP_NTZ (UTC wall time) so results compare
    with engines whose TIMESTAMP has no zone."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
