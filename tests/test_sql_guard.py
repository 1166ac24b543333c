"""The ad-hoc SELECT guard judges the parsed and the analysed plan."""

import pytest

from pulsegrid.operators import sqlgate as G

CALL = "reflect('java.util.UUID','randomUUID')"
BYPASSES = [
    f"""SELECT "'" AS a, {CALL} AS b""",
    f"""SELECT '"' AS a, {CALL} AS b, '"' AS c""",
    rf"""SELECT '\'' AS a, {CALL} AS b""",
    rf"""SELECT r'\' AS a, {CALL} AS b, '' AS c""",
    "SELECT `java_method`('java.util.UUID','randomUUID')",
    f"SELECT /* /* */ ' */ try_{CALL} -- '",
    f"SELECT id FROM range(3) WHERE id IN (SELECT length({CALL}) FROM range(2))",
    f"SELECT (SELECT max({CALL}) FROM range(2)) AS x",
    f"SELECT transform(array(1), x -> {CALL}) AS y",
    f"SELECT system.builtin.{CALL}",
]


@pytest.mark.parametrize("mode", ["compat", "strict"])
@pytest.mark.parametrize("sql", BYPASSES)
def test_no_quoting_hides_a_call(spark, sql, mode, monkeypatch):
    with pytest.raises(Exception):
        G.run_query(spark, sql, mode=mode)
    monkeypatch.setattr(G, "check", lambda q, mode: q.strip())  # whatever the text looks like, its plan is judged
    with pytest.raises((G.QueryRefused, Exception)) as refused:
        G.run_query(spark, sql, mode=mode)
    assert isinstance(refused.value, G.QueryRefused) or "PARSE_SYNTAX_ERROR" in str(refused.value)


@pytest.mark.parametrize(
    "sql",
    [
        "DROP VIEW nothing",
        "CREATE TABLE made_by_guard (a INT) USING parquet",
        "SET a.b = 1",
        "SHOW TABLES",
        "CACHE TABLE x AS SELECT 1",
        "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a",
    ],
)
def test_only_queries_get_past_the_parser(spark, sql, monkeypatch):
    monkeypatch.setattr(G, "check", lambda q, mode: q.strip())
    with pytest.raises(G.QueryRefused):
        G.guarded_select(spark, sql, mode="strict")


def test_relations_can_be_named(spark):
    for name in ("seen", "hidden"):
        spark.range(3).createOrReplaceTempView(name)
    ok = "WITH a AS (SELECT * FROM seen) SELECT count(*) FROM a JOIN Seen s ON a.id = s.id"
    assert G.guarded_select(spark, ok, mode="strict", relations=["seen"]).first()[0] == 3
    for sql in (
        "SELECT * FROM hidden",
        "SELECT * FROM seen WHERE id IN (SELECT id FROM hidden)",
        "SELECT (SELECT max(id) FROM hidden)",
        "WITH a AS (SELECT * FROM hidden) SELECT * FROM a",
    ):
        with pytest.raises(G.QueryRefused):
            G.guarded_select(spark, sql, mode="strict", relations=["seen"])


def test_bare_text():
    assert G.bare("SELECT 'a''b' , \"c -- d\" FROM `x'y` -- 'z\n, 1").split() == ["SELECT", "''''", ",", "''", "FROM", "`x'y`", ",", "1"]
    assert G.bare("SELECT /* a /* b */ c */ 1 /* open").split() == ["SELECT", "1"]
    assert not G.names_limit("SELECT \"'\" AS a, 'LIMIT 5' AS b") and G.names_limit("SELECT \"'\" AS a FROM t LIMIT 5")


def test_truncation_is_told(spark):
    res = G.run_query(spark, "SELECT id FROM range(15000) ORDER BY id LIMIT 15000")
    assert res["row_count"] == G.MAX_ROWS and res["truncated"]
    res = G.run_query(spark, f"SELECT id FROM range({G.MAX_ROWS}) LIMIT 20000")
    assert res["row_count"] == G.MAX_ROWS and not res["truncated"]
