
import pytest
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators import browse as B
from pulsegrid.operators import ingest as I
from pulsegrid.operators import sqlgate as G
from pulsegrid.plans.common import TABLE_OPTS
from pulsegrid.plans.health import readings
from pulsegrid.operators import alerts as A
from pulsegrid.sinks import tables as TB
from pulsegrid.sources.streams import kafka_options

SF = "/root/testdata/sf0.001"


def test_append_if_absent_is_idempotent(spark, scratch):
    m = A.metric_rows(readings(spark, SF), TABLE_OPTS)["1min"]
    TB.append_if_absent(spark, m, scratch, TB.METRICS_1MIN)
    n1 = TB.read_table(spark, scratch, TB.METRICS_1MIN).count()
    TB.append_if_absent(spark, m, scratch, TB.METRICS_1MIN)
    n2 = TB.read_table(spark, scratch, TB.METRICS_1MIN).count()
    assert n1 == n2 == m.count()


def test_dedupe_first_keeps_earliest(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")], "k string, seq int, v string")
    got = {r.k: r.v for r in TB.dedupe_first(df, ("k",), "seq").collect()}
    assert got == {"a": "early", "b": "only"}


def test_topic_table_name_and_enrichment(spark):
    df = spark.createDataFrame([("virtual-wearables", 0, 12345, '{"device_id": "w1", "x": 1}')], "topic string, partition int, offset long, value string")
    (r,) = I.raw_rows(I.enrich(df)).collect()
    assert r.table == "virtual_wearables" and r.device_id == "w1"
    assert (r.kafka_partition, r.kafka_offset, r.ingestion_protocol) == (0, 12345, "kafka")
    bad = spark.createDataFrame([("t", 0, 1, "not json")], "topic string, partition int, offset long, value string")
    assert I.raw_rows(I.enrich(bad)).collect()[0].device_id == "unknown"


def test_kafka_sink_shape(spark):
    df = spark.createDataFrame([("w1", "wearable", 1), ("x1", "drone", 2)], "device_id string, device_type string, v int")
    rows = {r.key: r.topic for r in I.kafka_value_json(df).collect()}
    assert rows == {"w1": "virtual-wearables", "x1": "virtual-drone"}


def test_kafka_options():
    from pulsegrid.sources.streams import kafka_sink_options

    o = kafka_options(TABLE_OPTS, ("a", "b"))
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "latest"
    assert not {"maxOffsetsPerTrigger", "failOnDataLoss", "kafka.group.id"} & set(o)
    assert kafka_options(TABLE_OPTS.with_(max_offsets_per_trigger=7))["maxOffsetsPerTrigger"] == "7"
    assert kafka_options(TABLE_OPTS)["groupIdPrefix"] != kafka_options(TABLE_OPTS, group=TABLE_OPTS.ingest_group)["groupIdPrefix"]
    k = kafka_sink_options(TABLE_OPTS)
    assert k["kafka.acks"] == "all" and k["kafka.retries"] == "3"


@pytest.mark.parametrize(
    "sql,mode,ok",
    [
        ("SELECT 1", "compat", True),
        ("  select 1", "compat", True),
        ("DROP TABLE x", "compat", False),
        ("SELECT * FROM t; DELETE FROM t", "compat", False),
        ("SELECT created_at FROM t", "compat", False),
        ("SELECT created_at FROM t", "strict", True),
        ("WITH a AS (SELECT 1) SELECT * FROM a", "compat", False),
        ("WITH a AS (SELECT 1) SELECT * FROM a", "strict", True),
        ("SELECT 1; DROP TABLE t", "strict", False),
    ],
)
def test_guard(sql, mode, ok):
    if ok:
        G.check(sql, mode)
    else:
        with pytest.raises(G.QueryRefused):
            G.check(sql, mode)


def test_limit_injection(spark):
    assert not G.names_limit("SELECT 1 -- LIMIT 5") and G.names_limit("SELECT * FROM (SELECT 1 LIMIT 5)")
    assert G.run_query(spark, "SELECT id FROM range(1000) -- all")["row_count"] == 100
    assert G.run_query(spark, "SELECT id FROM range(1000) LIMIT 300")["row_count"] == 300
    assert G.run_query(spark, "SELECT id FROM range(20000) LIMIT 20000")["row_count"] == G.MAX_ROWS
    res = G.run_query(spark, "SELECT id FROM range(1000)", limit=7)
    assert res["row_count"] == 7 and res["columns"] == ["id"]


def test_select_lists_of_any_shape(spark):
    assert G.run_query(spark, "SELECT 1.5")["rows"] == [{"1.5": __import__("decimal").Decimal("1.5")}]
    res = G.run_query(spark, "SELECT a.id, b.id, avg(a.id * 1.0) FROM range(3) a JOIN range(3) b ON a.id = b.id GROUP BY a.id, b.id ORDER BY 1")
    assert res["columns"][:2] == ["id", "id"] and [v[:2] for v in res["values"]] == [[0, 0], [1, 1], [2, 2]]
    res = G.run_query(spark, """SELECT '{"x": [1, null]}' AS raw_data""")
    assert res["rows"] == [{"raw_data": {"x": [1, None]}}]


def test_no_way_out_of_the_tables(spark, scratch):
    for mode in ("compat", "strict"):
        with pytest.raises(G.QueryRefused):
            G.run_query(spark, "SELECT reflect('java.util.UUID', 'randomUUID')", mode=mode)
        with pytest.raises(G.QueryRefused):
            G.run_query(spark, "SELECT `java_method` /* x */ ('java.util.UUID', 'randomUUID')", mode=mode)
    G.run_query(spark, "SELECT 'reflect(1)' AS t")
    spark.range(3).write.parquet(scratch + "/t")
    with pytest.raises(Exception):
        G.run_query(spark, f"SELECT * FROM parquet.`{scratch}/t`")


def test_kafka_json_keeps_nulls(spark):
    df = spark.createDataFrame([("w1", "wearable", None)], "device_id string, device_type string, v int")
    assert I.kafka_value_json(df).first().value == '{"device_id":"w1","device_type":"wearable","v":null}'


def test_page_bounds(spark):
    df = spark.range(10).select(F.col("id").alias("kafka_offset"), F.lit(0).alias("kafka_partition"), F.current_timestamp().alias("ingested_at"))
    with pytest.raises(B.BrowseError):
        B.page(df, limit=1001)
    with pytest.raises(B.BrowseError):
        B.page(df, offset=-1)
    assert [r.kafka_offset for r in B.page(df, limit=3, offset=2).collect()] == [7, 6, 5]


def test_iso_rendering(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:07.179575' AS a, TIMESTAMP'2024-01-01 00:00:07' AS b")
    r = B.render(df).collect()[0]
    assert r.a == "2024-01-01T00:00:07.179575+00:00" and r.b == "2024-01-01T00:00:07+00:00"
