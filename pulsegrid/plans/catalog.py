"""The query catalogue: name → Spark query, and name → DuckDB oracle SQL."""

from __future__ import annotations

from . import (
    activity,
    adhoc,
    fleet,
    health,
    ingestion,
    oracle_activity,
    oracle_adhoc,
    oracle_fleet,
    oracle_health,
    oracle_ingestion,
    oracle_streams,
    oracle_trends,
    streams,
    trends,
)

QUERIES = {}
ORACLE = {}
PARTS = (
    (health, oracle_health),
    (ingestion, oracle_ingestion),
    (activity, oracle_activity),
    (fleet, oracle_fleet),
    (adhoc, oracle_adhoc),
    (trends, oracle_trends),
    (streams, oracle_streams),
)
for _mod, _sql in PARTS:
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_sql.SQL)
