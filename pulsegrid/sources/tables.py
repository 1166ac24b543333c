"""Table scans (batch) over the Parquet tables of a data folder."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet`` (a file or a folder), else the folder ``{sf_dir}/{name}``.

    Paths are only opened by Spark, so any file system it reads will do."""
    base = f"{sf_dir.rstrip('/')}/{name}"
    try:
        return spark.read.parquet(f"{base}.parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(base)


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> list[str]:
    """Register each table that is there as a temp view so ad-hoc SQL can reach it."""
    done = []
    for n in names:
        try:
            table(spark, sf_dir, n).createOrReplaceTempView(n)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        done.append(n)
    return done


def dealt(df: DataFrame) -> DataFrame:
    """The scan as Spark splits it, or dealt anew into as many partitions as
    the session's ``pulsegrid.scan.partitions`` says. Set it for files that
    can't be split (one row group) and costly per-row work; it is off unless set."""
    n = df.sparkSession.conf.get("pulsegrid.scan.partitions", "")
    return df.repartition(int(n)) if n else df


ROWS_AT_ONCE = 500_000


def spread(df: DataFrame, key: str, rows: int = ROWS_AT_ONCE) -> DataFrame:
    """``df`` by ``key`` in partitions of about ``rows`` rows, for joins and
    aggregates whose tasks hold their partition; as it is while the session's
    own number of shuffle partitions gives no larger ones."""
    n = math.ceil(df.count() / rows)
    return df.repartition(n, key) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
