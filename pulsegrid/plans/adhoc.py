"""Ad-hoc SELECT through the guard over the star-schema tables, and the
insert-if-absent query over metric rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import alerts as A
from ..operators.sqlgate import guarded_select
from ..sinks.tables import insert_if_absent as _iia
from ..sources.tables import register_views
from .common import TABLE_OPTS, TABLE_OPTS_METRIC, ntz, prepare
from .health import readings

# Same text runs in Spark (through the guard) and in the DuckDB oracle.
SQL_TEXT = {
    "sql_join": """SELECT r.r_name, n.n_name, count(DISTINCT o.o_orderkey) AS orders,
       round(sum(l.l_extendedprice), 2) AS gross, round(sum(l.l_quantity), 2) AS qty
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, n.n_name""",
    "sql_semi_anti": """SELECT 'big_spender' AS kind, c.c_mktsegment, count(*) AS customers
FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)
GROUP BY c.c_mktsegment
UNION ALL
SELECT 'other' AS kind, c.c_mktsegment, count(*) AS customers
FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)
GROUP BY c.c_mktsegment
UNION ALL
SELECT 'supplier_nation' AS kind, c.c_mktsegment, count(*) AS customers
FROM customer c
WHERE c.c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
GROUP BY c.c_mktsegment""",
    "sql_setops": """SELECT 'union' AS op, count(*) AS n
FROM (SELECT s_nationkey AS k FROM supplier UNION SELECT c_nationkey FROM customer) u
UNION ALL
SELECT 'intersect' AS op, count(*) AS n
FROM (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0
      INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') i
UNION ALL
SELECT 'except' AS op, count(*) AS n
FROM (SELECT c_custkey AS k FROM customer
      EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') e""",
    "sql_rank": """SELECT n_name, c_custkey, spend, CAST(rnk AS BIGINT) AS rnk
FROM (SELECT n.n_name, c.c_custkey, round(sum(o.o_totalprice), 2) AS spend,
             rank() OVER (PARTITION BY n.n_name ORDER BY sum(o.o_totalprice) DESC) AS rnk
      FROM orders o
      JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey
      GROUP BY n.n_name, c.c_custkey) t
WHERE rnk <= 3""",
    # names no limit: the guard's own (100 rows) is put on the ordered result
    "sql_default_limit": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey",
    "sql_grouping_sets": """SELECT o_orderstatus, o_orderpriority, count(*) AS orders,
       round(sum(o_totalprice), 2) AS total,
       CAST(grouping(o_orderstatus) AS INTEGER) AS g_status,
       CAST(grouping(o_orderpriority) AS INTEGER) AS g_priority
FROM orders
GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
}


def _sql(name):
    def q(spark, sf_dir):
        prepare(spark)
        register_views(spark, sf_dir, ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"))
        return guarded_select(spark, SQL_TEXT[name])

    q.__name__ = name
    return q


def insert_if_absent(spark, sf_dir):
    """Short-window metric table after two batches: the record-mode rows, then
    a replay under per-metric validity. Keys already present keep their first
    row; only new keys are appended."""
    first = A.metric_rows(readings(spark, sf_dir, TABLE_OPTS), TABLE_OPTS, ("1min",))["1min"]
    second = A.metric_rows(readings(spark, sf_dir, TABLE_OPTS_METRIC), TABLE_OPTS_METRIC, ("1min",))["1min"]
    # each batch is unique per key: rows straight out of one window groupBy
    new = _iia(first, second, S.METRIC_KEY, assume_unique=True)
    return ntz(first.unionByName(new))


QUERIES = {name: _sql(name) for name in SQL_TEXT}
QUERIES["insert_if_absent"] = insert_if_absent
