"""Plan checks: no Python on the hot path, partial aggregation before the
exchange, top-k for pages, pushdown into the Parquet scan."""

import re

from pulsegrid.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_health_windows_are_jvm_only_with_partial_aggregation(spark):
    p = plan(QUERIES["metrics_1min"](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow"):
        assert node not in p
    assert "partial_count" in p or "partial_sum" in p


def test_page_is_top_k(spark):
    p = plan(QUERIES["table_page"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_parquet_pushdown_and_pruning(spark):
    from pyspark.sql import functions as F
    from pulsegrid.sources.tables import table

    df = table(spark, SF, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_anchored_uses_python_only_on_minute_partials(spark):
    p = plan(QUERIES["anchored_hr"](spark, SF))
    assert "FlatMapGroupsInArrow" in p
    # the Python fold sits above the minute aggregation
    assert p.index("FlatMapGroupsInArrow") < p.rindex("HashAggregate")


def test_next_fix_has_no_join_and_no_sorted_aggregate(spark):
    p = plan(QUERIES["gps_heading"](spark, SF))
    for node in ("Join", "SortAggregate", "ObjectHashAggregate"):
        assert node not in p
    # both halves of the union sort the hours, and one the hours' last rows
    assert len(re.findall(r"[+:]- Window ", p)) == len(re.findall(r"[+:]- Sort ", p)) == 3
