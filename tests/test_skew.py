"""Correctness with a hot key: one user holds a third of all events. The
catalogue queries run on the skewed table and must equal the oracle SQL run
by DuckDB over the same skewed table."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from pulsegrid.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = ["metrics_1min", "all_alerts", "anchored_hr", "gps_heading", "device_metrics"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    ev = spark.read.parquet(f"{SF}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("user_id")))
    hot.coalesce(1).write.parquet(os.path.join(d, "events.parquet"))
    return d


@pytest.mark.parametrize("name", NAMES)
def test_hot_user_matches_oracle(spark, skewed_dir, name):
    sdf = QUERIES[name](spark, skewed_dir)
    got = _rows(sdf.columns, sdf.collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{skewed_dir}/events.parquet/*.parquet')")
    res = con.execute(ORACLE[name])
    cols = [c[0] for c in res.description]
    want = _rows(cols, res.fetchall())
    assert sorted(sdf.columns) == sorted(cols)
    assert got == want
