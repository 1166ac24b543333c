"""Guarded ad-hoc SELECT over registered views.

The guard runs on the text *before* ``spark.sql`` because Spark executes DDL
eagerly. Two modes:

* ``compat`` — the original rule: the trimmed text must start with SELECT
  and must not contain any forbidden keyword as a *substring* (so ``WITH``
  queries and a column named ``created_at`` are refused); the default limit
  holds when the text names no ``LIMIT`` anywhere (a LIMIT inside a subquery
  suppresses the outer one).
* ``strict`` — keyword matching on whole tokens; ``WITH`` is allowed.

What a text does is judged by Spark's own parse of it, not by its letters: the
parsed plan must be a query (no command or insert anywhere in it), must call no
function that runs code outside the query, and may be held to a set of relations;
after analysis the plan is looked through again, so no alias or quoting hides a
call. Paths in place of tables are refused. The limit is put on the planned frame,
so no text (a comment, say) can swallow it. The result is a lazy DataFrame;
``run_query`` alone gathers rows, at most ``MAX_ROWS`` of them whatever LIMIT the
text names, and says so in ``truncated``.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import options as O
from ..session import conf_while
from .browse import render


# rows that run_query hands to the driver at most
MAX_ROWS = 10_000
# functions that run code outside the query, and the expressions they become
REFUSED_NAMES = ("reflect", "java_method", "try_reflect")
REFUSED_EXPRESSIONS = ("CallMethodViaReflection", "TryReflect")
REFUSED_FUNCTIONS = re.compile(rf"\b({'|'.join(REFUSED_NAMES)})\b\W*\(", re.IGNORECASE)


class QueryRefused(ValueError):
    pass


_TOKEN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def check(sql: str, mode: str = "compat") -> str:
    """Return the trimmed text if allowed, else raise ``QueryRefused``."""
    q = sql.strip()
    up = q.upper()
    if REFUSED_FUNCTIONS.search(bare(q)):
        raise QueryRefused("Query calls a function that is not allowed")
    if mode == "strict":
        tokens = {t.upper() for t in _TOKEN.findall(bare(q))}
        first = next(iter(_TOKEN.findall(up)), "")
        if first not in ("SELECT", "WITH"):
            raise QueryRefused("Only SELECT queries are allowed")
        for kw in O.FORBIDDEN_KEYWORDS:
            if kw in tokens:
                raise QueryRefused(f"Query contains forbidden keyword: {kw}")
        return q
    if not up.startswith("SELECT"):
        raise QueryRefused("Only SELECT queries are allowed")
    for kw in O.FORBIDDEN_KEYWORDS:
        if kw in up:
            raise QueryRefused(f"Query contains forbidden keyword: {kw}")
    return q


# whatever can hold quotes: raw strings, strings of both quotes, names, comments
_QUOTED = re.compile(
    r"""(?<![A-Za-z0-9_])[rR](?:'[^']*'|"[^"]*")|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|(?P<name>`[^`]*`)|--[^\n]*|/\*""", re.DOTALL
)
_BRACKET = re.compile(r"/\*|\*/")


def bare(q: str) -> str:
    """The text without comments (which may nest) and with empty literals."""
    out, at = [], 0
    while found := _QUOTED.search(q, at):
        out.append(q[at : found.start()])
        at = found.end()
        if found["name"]:
            out.append(found["name"])
        elif found[0] == "/*":
            depth = 1
            while depth and (mark := _BRACKET.search(q, at)):
                depth, at = depth + (1 if mark[0] == "/*" else -1), mark.end()
            out.append(" ")
            if depth:  # never closed: nothing of it runs
                return "".join(out)
        else:
            out.append(" " if found[0].startswith("--") else "''")
    return "".join([*out, q[at:]])


def names_limit(q: str, mode: str = "compat") -> bool:
    """Whether the text (comments and literals aside) names a LIMIT."""
    text = bare(q)
    return "LIMIT" in (text.upper() if mode == "compat" else {t.upper() for t in _TOKEN.findall(text)})


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _nodes(jvm, plan) -> Iterator[tuple[str, object]]:
    """(class name, node) of a plan: its operators, their expressions, and the
    plans inside those (subqueries, common table expressions)."""
    is_a = jvm.py4j.reflection.TypeUtil.isInstanceOf
    todo = [plan]
    while todo:
        node = todo.pop()
        yield node.getClass().getSimpleName(), node
        todo += _items(node.children())
        if is_a("org.apache.spark.sql.catalyst.plans.logical.LogicalPlan", node):
            todo += _items(node.expressions())
            todo += (c for c in _items(node.innerChildren()) if is_a("org.apache.spark.sql.catalyst.plans.logical.LogicalPlan", c))
        elif is_a("org.apache.spark.sql.catalyst.expressions.PlanExpression", node):
            todo.append(node.plan())


def check_parsed(spark: SparkSession, q: str, relations: Iterable[str] | None = None) -> None:
    """Refuse by the parsed plan; nothing of the text has run by then."""
    jvm = spark._jvm
    is_a = jvm.py4j.reflection.TypeUtil.isInstanceOf
    logical = "org.apache.spark.sql.catalyst.plans.logical"
    allowed = None if relations is None else {r.lower() for r in relations}
    read, own = set(), set()
    for kind, node in _nodes(jvm, spark._jsparkSession.sessionState().sqlParser().parsePlan(q)):
        if any(is_a(f"{logical}.{c}", node) for c in ("Command", "ParsedStatement")) or kind in ("CompoundBody", "InsertIntoStatement"):
            raise QueryRefused("Only SELECT queries are allowed")
        if kind == "UnresolvedFunction" and node.nameParts().last().lower() in REFUSED_NAMES:
            raise QueryRefused("Query calls a function that is not allowed")
        if kind == "UnresolvedRelation":
            read.add(node.multipartIdentifier().mkString(".").lower())
        if kind == "UnresolvedWith":
            own |= {alias._2().alias().lower() for alias in _items(node.cteRelations())}
    if allowed is not None and read - own - allowed:
        raise QueryRefused(f"Query reads a relation that is not allowed: {min(read - own - allowed)}")


def check_analysed(spark: SparkSession, df: DataFrame) -> None:
    for kind, _ in _nodes(spark._jvm, df._jdf.queryExecution().analyzed()):
        if kind in REFUSED_EXPRESSIONS:
            raise QueryRefused("Query calls a function that is not allowed")


def guarded_select(
    spark: SparkSession, sql: str, limit: int = O.QUERY_DEFAULT_LIMIT, mode: str = "compat", relations: Iterable[str] | None = None
) -> DataFrame:
    """Guard, add the default limit, and plan the query (lazily). ``relations``
    names the only relations a text may read (its own WITH names aside)."""
    q = check(sql, mode)
    here = hasattr(spark, "_jsparkSession")  # Spark Connect shows no plans: there the text alone is judged
    if not here and relations is not None:
        raise QueryRefused("Relations can't be checked in this session")
    if here:
        check_parsed(spark, q, relations)
    with conf_while(spark, spark__sql__runSQLOnFiles="false"):
        df = spark.sql(q)
    if here:
        check_analysed(spark, df)
    return df if names_limit(q, mode) else df.limit(int(limit))


def run_query(spark: SparkSession, sql: str, limit: int = O.QUERY_DEFAULT_LIMIT, mode: str = "compat") -> dict:
    """Execute and return ``columns, rows, row_count, truncated, execution_time_ms``.

    Rows are bounded by the default limit or the text's own, and by
    ``MAX_ROWS``; ``truncated`` tells that ``MAX_ROWS`` cut some off. ``rows`` are dicts; of columns with one name the last is
    kept there, ``values`` has all of them in order.
    """
    t0 = time.time()
    df = guarded_select(spark, sql, limit, mode)
    shown = render(df)
    as_json = [t.dataType.typeName() == "variant" for t in shown.schema.fields]
    plain = shown.toDF(*[f"c{i}" for i in range(len(as_json))])
    plain = plain.select(*[F.to_json(f"c{i}").alias(f"c{i}") if j else F.col(f"c{i}") for i, j in enumerate(as_json)])
    values = []
    found = plain.limit(MAX_ROWS + 1).collect()
    for r in found[:MAX_ROWS]:
        own = r.asDict(recursive=True)
        values.append([json.loads(v) if j and v is not None else v for v, j in zip((own[f"c{i}"] for i in range(len(as_json))), as_json)])
    rows = [dict(zip(df.columns, v)) for v in values]
    return {
        "columns": df.columns,
        "rows": rows,
        "values": values,
        "row_count": len(rows),
        "truncated": len(found) > MAX_ROWS,
        "execution_time_ms": round((time.time() - t0) * 1000, 2),
    }
