"""DuckDB SQL for the ad-hoc SELECT queries (same text) and insert-if-absent."""

from __future__ import annotations

from .adhoc import SQL_TEXT
from .oracle_health import EV, MET, REC, _bp_groups, _hr_groups, _metric_sel, pyround, with_


def _metrics(src: str) -> str:
    return (
        _metric_sel(f"hr_{src}", "heart_rate", pyround("a", 2), "mn", "mx")
        + "\nUNION ALL\n"
        + _metric_sel(f"bp_{src}", "blood_pressure", pyround("s", 2), pyround("d", 2), pyround("s", 2))
    )


def _groups(src: str) -> str:
    return ",\n".join(
        [
            _hr_groups(src).replace("hr AS (", f"hr_{src} AS (", 1),
            _bp_groups(src=src).replace("bp AS (", f"bp_{src} AS (", 1),
        ]
    )


SQL = dict(SQL_TEXT)
SQL["sql_default_limit"] += " LIMIT 100"
SQL["insert_if_absent"] = with_(EV, REC, MET, _groups("rec"), _groups("met")) + f""", first AS ({_metrics('rec')}),
second AS ({_metrics('met')})
SELECT * FROM first
UNION ALL
SELECT s.* FROM second s
WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.window_start = s.window_start AND f.user_id = s.user_id
                  AND f.metric_type = s.metric_type)"""
