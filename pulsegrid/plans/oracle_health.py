"""DuckDB SQL equivalents of the health queries.

The readings are recomputed from ``events`` columns (``value``, ``user_id``
and ``k``) with CASE expressions — never through JSON — so the Spark parser
is checked independently.
"""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id, ts, user_id AS uid, value AS v,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

# Record validity: k 0 (all negative), 4 (malformed), 5 (HR negative),
# 6 (HR as text) invalidate the whole reading; k 2, 3 (null / wrong
# containers) and 10 (no HR key) leave fields absent but valid.
REC = """rec AS (
  SELECT event_id, ts,
    CASE WHEN k IN (4, 9) THEN 'unknown' ELSE 'user_' || CAST(uid AS VARCHAR) END AS user_id,
    CAST(CASE WHEN k IN (0, 2, 3, 4, 5, 6, 10) THEN -1
              WHEN k = 1 THEN 370 + floor(v / 2)
              WHEN k = 11 THEN 1
              ELSE 70 + floor(v / 2) END AS INTEGER) AS heart_rate,
    CAST(CASE WHEN k IN (0, 2, 3, 4, 5, 6) THEN -1
              WHEN k = 1 THEN 415 + floor(v / 2)
              ELSE 115 + floor(v / 2) END AS INTEGER) AS bp_systolic,
    CAST(CASE WHEN k IN (0, 2, 3, 4, 5, 6, 12) THEN -1
              WHEN k = 1 THEN 280 + 8 * (uid % 3)
              ELSE 80 + 8 * (uid % 3) END AS INTEGER) AS bp_diastolic,
    CAST(CASE WHEN k IN (0, 2, 3, 4, 5, 6) THEN -1
              WHEN k = 1 THEN 610 + 2 * floor(v)
              ELSE 110 + 2 * floor(v) END AS INTEGER) AS blood_sugar,
    CASE WHEN k IN (0, 4, 5, 6) THEN 0 ELSE 1 END AS valid
  FROM ev
)"""

# Per-metric validity: only the bad field is dropped, floats are kept,
# malformed messages (k 4) are skipped.
MET = """met AS (
  SELECT event_id, ts,
    CASE WHEN k = 9 THEN 'unknown' ELSE 'user_' || CAST(uid AS VARCHAR) END AS user_id,
    CAST(CASE WHEN k IN (0, 2, 3, 5, 6, 10) THEN NULL
              WHEN k = 1 THEN 370 + floor(v / 2)
              WHEN k = 7 THEN 70 + floor(v / 2) + 0.9
              WHEN k = 11 THEN 1
              ELSE 70 + floor(v / 2) END AS DOUBLE) AS heart_rate,
    CAST(CASE WHEN k IN (0, 2, 3) THEN NULL
              WHEN k = 1 THEN 415 + floor(v / 2)
              ELSE 115 + floor(v / 2) END AS DOUBLE) AS bp_systolic,
    CAST(CASE WHEN k IN (0, 2, 3, 12) THEN NULL
              WHEN k = 1 THEN 280 + 8 * (uid % 3)
              ELSE 80 + 8 * (uid % 3) END AS DOUBLE) AS bp_diastolic,
    CAST(CASE WHEN k IN (0, 2, 3) THEN NULL
              WHEN k = 1 THEN 610 + 2 * floor(v)
              ELSE 110 + 2 * floor(v) END AS DOUBLE) AS blood_sugar
  FROM ev WHERE k <> 4
)"""


def pyround(x: str, digits: int = 2) -> str:
    """SQL for half-even rounding on the exact binary value (Python ``round``):
    the product's rounding error, recovered with a Veltkamp split, decides
    ties that the rounded product ``x * 10^d`` would otherwise create."""
    s = f"CAST({10 ** digits} AS DOUBLE)"
    x = f"CAST({x} AS DOUBLE)"
    p = f"({x} * {s})"
    c = f"({x} * CAST(134217729 AS DOUBLE))"
    hi = f"({c} - ({c} - {x}))"
    lo = f"({x} - {hi})"
    err = f"(({hi} * {s} - {p}) + {lo} * {s})"
    fl = f"floor({p})"
    return (
        f"((CASE WHEN {p} - {fl} = 0.5 AND {err} < 0 THEN {fl} "
        f"WHEN {p} - {fl} = 0.5 AND {err} > 0 THEN {fl} + 1 "
        f"ELSE round_even({p}, 0) END) / {s})"
    )


def xavg(col: str) -> str:
    """Mean from the exact decimal sum."""
    return f"(CAST(sum(CAST({col} AS DECIMAL(28, 9))) AS DOUBLE) / count(*))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def bucket(days: int) -> str:
    return f"time_bucket(INTERVAL '{days} days', ts, TIMESTAMP '1970-01-01')"


def _hr_groups(src: str = "rec", days: int = 1) -> str:
    b = bucket(days)
    return f"""hr AS (
  SELECT user_id, {b} AS window_start, {b} + INTERVAL '{days} days' AS window_end,
         {xavg("heart_rate")} AS a, min(heart_rate) AS mn, max(heart_rate) AS mx, count(*) AS n
  FROM {src} WHERE heart_rate > 0 AND user_id IS NOT NULL GROUP BY 1, 2, 3
)"""


def _bp_groups(days: int = 1, src: str = "rec") -> str:
    b = bucket(days)
    return f"""bp AS (
  SELECT user_id, {b} AS window_start, {b} + INTERVAL '{days} days' AS window_end,
         {xavg("bp_systolic")} AS s, {xavg("bp_diastolic")} AS d, count(*) AS n
  FROM {src} WHERE bp_systolic > 0 AND bp_diastolic > 0 AND user_id IS NOT NULL GROUP BY 1, 2, 3
)"""


def _sugar_groups(days: int = 10) -> str:
    b = bucket(days)
    return f"""su AS (
  SELECT user_id, {b} AS window_start, {b} + INTERVAL '{days} days' AS window_end,
         {xavg("blood_sugar")} AS a, min(blood_sugar) AS mn, max(blood_sugar) AS mx, count(*) AS n
  FROM rec WHERE blood_sugar > 0 AND user_id IS NOT NULL GROUP BY 1, 2, 3
)"""


HR_ALERTS = f"""SELECT window_end AS time, user_id, 'elevated_heart_rate' AS alert_type,
       CASE WHEN a < 120 THEN 'warning' ELSE 'critical' END AS severity,
       {pyround("a", 2)} AS metric_value, CAST(100 AS DOUBLE) AS threshold_value,
       window_start, window_end
FROM hr WHERE a > 100"""


def bp_alerts_sql(threshold: int) -> str:
    return f"""SELECT window_end AS time, user_id, 'elevated_blood_pressure' AS alert_type,
       CASE WHEN s < 160 THEN 'warning' ELSE 'critical' END AS severity,
       {pyround("s", 2)} AS metric_value, CAST({threshold} AS DOUBLE) AS threshold_value,
       window_start, window_end
FROM bp WHERE s >= 140 OR d >= 90"""


SUGAR_ALERTS = f"""SELECT window_end AS time, user_id, 'elevated_blood_sugar' AS alert_type,
       CASE WHEN a < 250 THEN 'warning' ELSE 'critical' END AS severity,
       {pyround("a", 2)} AS metric_value, CAST(180 AS DOUBLE) AS threshold_value,
       window_start, window_end
FROM su WHERE a >= 180"""


def _metric_sel(src: str, mtype: str, avg: str, mn: str, mx: str) -> str:
    return f"""SELECT window_end AS time, user_id, '{mtype}' AS metric_type, window_start, window_end,
       CAST({avg} AS DOUBLE) AS avg_value, CAST({mn} AS DOUBLE) AS min_value,
       CAST({mx} AS DOUBLE) AS max_value, CAST(n AS BIGINT) AS reading_count
FROM {src}"""


SQL = {
    "parse_readings_record": with_(EV, REC) + "SELECT * FROM rec",
    "parse_readings_metric": with_(EV, MET) + "SELECT * FROM met",
    "hr_window_metrics": with_(EV, REC, _hr_groups())
    + f"""SELECT user_id, window_start, window_end, {pyround("a", 2)} AS avg_heart_rate,
       CAST(mn AS INTEGER) AS min_heart_rate, CAST(mx AS INTEGER) AS max_heart_rate,
       n AS reading_count FROM hr""",
    "bp_window_metrics": with_(EV, REC, _bp_groups())
    + f"""SELECT user_id, window_start, window_end, {pyround("s", 2)} AS avg_bp_systolic,
       {pyround("d", 2)} AS avg_bp_diastolic, n AS reading_count FROM bp""",
    "sugar_window_metrics": with_(EV, REC, _sugar_groups())
    + f"""SELECT user_id, window_start, window_end, {pyround("a", 2)} AS avg_blood_sugar,
       CAST(mn AS INTEGER) AS min_blood_sugar, CAST(mx AS INTEGER) AS max_blood_sugar,
       n AS reading_count FROM su""",
    "hr_window_metrics_metric_mode": with_(EV, MET, _hr_groups("met"))
    + f"""SELECT user_id, window_start, window_end, {pyround("a", 2)} AS avg_heart_rate,
       mn AS min_heart_rate, mx AS max_heart_rate, n AS reading_count FROM hr""",
    "hr_alerts": with_(EV, REC, _hr_groups()) + HR_ALERTS,
    "bp_alerts_stream": with_(EV, REC, _bp_groups()) + bp_alerts_sql(0),
    "bp_alerts_standalone": with_(EV, REC, _bp_groups()) + bp_alerts_sql(140),
    "sugar_alerts": with_(EV, REC, _sugar_groups()) + SUGAR_ALERTS,
    "window_results": with_(EV, REC, _hr_groups(), _bp_groups(), _sugar_groups())
    + f"""SELECT 'heart_rate_1min' AS type, window_start, window_end, user_id, n AS reading_count,
  CASE WHEN a > 100 THEN 'elevated_heart_rate' END AS alert_type, CASE WHEN a > 100 THEN {pyround("a", 2)} END AS alert_value,
  CASE WHEN a > 100 THEN '100' END AS threshold, CASE WHEN a > 100 THEN CASE WHEN a < 120 THEN 'warning' ELSE 'critical' END END AS severity FROM hr
UNION ALL
SELECT 'blood_pressure_1min', window_start, window_end, user_id, n, CASE WHEN s >= 140 OR d >= 90 THEN 'elevated_blood_pressure' END,
  CASE WHEN s >= 140 OR d >= 90 THEN {pyround("s", 2)} END, CASE WHEN s >= 140 OR d >= 90 THEN '140/90' END,
  CASE WHEN s >= 140 OR d >= 90 THEN CASE WHEN s < 160 THEN 'warning' ELSE 'critical' END END FROM bp
UNION ALL
SELECT 'blood_sugar_10min', window_start, window_end, user_id, n, CASE WHEN a >= 180 THEN 'elevated_blood_sugar' END,
  CASE WHEN a >= 180 THEN {pyround("a", 2)} END, CASE WHEN a >= 180 THEN '180' END,
  CASE WHEN a >= 180 THEN CASE WHEN a < 250 THEN 'warning' ELSE 'critical' END END FROM su""",
    "metrics_1min": with_(EV, REC, _hr_groups(), _bp_groups())
    + _metric_sel("hr", "heart_rate", pyround("a", 2), "mn", "mx")
    + "\nUNION ALL\n"
    + _metric_sel("bp", "blood_pressure", pyround("s", 2), pyround("d", 2), pyround("s", 2)),
    "metrics_10min": with_(EV, REC, _sugar_groups())
    + _metric_sel("su", "blood_sugar", pyround("a", 2), "mn", "mx"),
    "all_alerts": with_(EV, REC, _hr_groups(), _bp_groups(), _sugar_groups())
    + HR_ALERTS
    + "\nUNION ALL\n"
    + bp_alerts_sql(0)
    + "\nUNION ALL\n"
    + SUGAR_ALERTS,
    "health_counters": with_(EV, REC, _hr_groups(), _bp_groups(), _sugar_groups())
    + f"""SELECT (SELECT count(*) FROM rec) AS messages_processed,
       (SELECT count(*) FROM ({HR_ALERTS} UNION ALL {bp_alerts_sql(0)} UNION ALL {SUGAR_ALERTS})) AS alerts_generated""",
}


def anchored_sql(value_expr: str, second_expr: str | None, cond: str, minutes: int) -> str:
    """First-reading-anchored windows by recursion over distinct minutes.

    ``nx`` maps each minute to the first minute at or after minute + L; the recursion walks that map from each user's first minute;
    every point then falls in the latest start at or before its minute.
    """
    sec = second_expr or "NULL"
    return f"""WITH RECURSIVE {EV}, {MET},
pts AS (
  SELECT user_id, date_trunc('minute', ts) AS m, ts, event_id,
         {value_expr} AS v, {sec} AS v2
  FROM met WHERE {cond} AND user_id IS NOT NULL
),
mins AS (SELECT DISTINCT user_id, m, m + INTERVAL '{minutes} minutes' AS lim FROM pts),
nx AS (
  SELECT a.user_id, a.m,
         (SELECT min(b.m) FROM mins b WHERE b.user_id = a.user_id AND b.m >= a.lim) AS nm
  FROM mins a
),
chain AS (
  SELECT user_id, min(m) AS s FROM mins GROUP BY user_id
  UNION ALL
  SELECT c.user_id, nx.nm FROM chain c JOIN nx ON nx.user_id = c.user_id AND nx.m = c.s
  WHERE nx.nm IS NOT NULL
),
assigned AS (
  SELECT p.*, (SELECT max(c.s) FROM chain c WHERE c.user_id = p.user_id AND c.s <= p.m) AS s
  FROM pts p
)
"""


def _anchored_hr() -> str:
    return anchored_sql("heart_rate", None, "heart_rate > 0", 1440) + f"""SELECT user_id, s AS window_start,
  s + INTERVAL '1440 minutes' AS window_end, {pyround(xavg("v"), 2)} AS avg_heart_rate,
  min(v) AS min_heart_rate, max(v) AS max_heart_rate, count(*) AS reading_count
FROM assigned GROUP BY user_id, s"""


def _anchored_bp() -> str:
    return anchored_sql("bp_systolic", "bp_diastolic", "bp_systolic > 0 AND bp_diastolic > 0", 1440) + f"""SELECT user_id,
  s AS window_start, s + INTERVAL '1440 minutes' AS window_end,
  {pyround(xavg("v"), 2)} AS avg_bp_systolic, {pyround(xavg("v2"), 2)} AS avg_bp_diastolic,
  count(*) AS reading_count
FROM assigned GROUP BY user_id, s"""


def _anchored_sugar() -> str:
    return anchored_sql("blood_sugar", None, "blood_sugar > 0", 14400) + f"""SELECT user_id, s AS window_start,
  s + INTERVAL '14400 minutes' AS window_end, {pyround(xavg("v"), 2)} AS avg_blood_sugar,
  min(v) AS min_blood_sugar, max(v) AS max_blood_sugar, count(*) AS reading_count
FROM assigned GROUP BY user_id, s"""


SQL["anchored_hr"] = _anchored_hr()
SQL["anchored_bp"] = _anchored_bp()
SQL["anchored_sugar"] = _anchored_sugar()


def _anchored_alerts() -> str:
    # one recursive query per metric, unioned
    hr = anchored_sql("heart_rate", None, "heart_rate > 0", 1440) + f"""SELECT s + INTERVAL '1440 minutes' AS time, user_id,
  'elevated_heart_rate' AS alert_type, CASE WHEN a < 120 THEN 'warning' ELSE 'critical' END AS severity,
  {pyround("a", 2)} AS metric_value, CAST(100 AS DOUBLE) AS threshold_value,
  s AS window_start, s + INTERVAL '1440 minutes' AS window_end
FROM (SELECT user_id, s, {xavg("v")} AS a FROM assigned GROUP BY user_id, s) WHERE a > 100"""
    bp = anchored_sql("bp_systolic", "bp_diastolic", "bp_systolic > 0 AND bp_diastolic > 0", 1440) + f"""SELECT s + INTERVAL '1440 minutes' AS time, user_id,
  'elevated_blood_pressure' AS alert_type, CASE WHEN a < 160 THEN 'warning' ELSE 'critical' END AS severity,
  {pyround("a", 2)} AS metric_value, CAST(140 AS DOUBLE) AS threshold_value,
  s AS window_start, s + INTERVAL '1440 minutes' AS window_end
FROM (SELECT user_id, s, {xavg("v")} AS a, {xavg("v2")} AS d FROM assigned GROUP BY user_id, s) WHERE a >= 140 OR d >= 90"""
    su = anchored_sql("blood_sugar", None, "blood_sugar > 0", 14400) + f"""SELECT s + INTERVAL '14400 minutes' AS time, user_id,
  'elevated_blood_sugar' AS alert_type, CASE WHEN a < 250 THEN 'warning' ELSE 'critical' END AS severity,
  {pyround("a", 2)} AS metric_value, CAST(180 AS DOUBLE) AS threshold_value,
  s AS window_start, s + INTERVAL '14400 minutes' AS window_end
FROM (SELECT user_id, s, {xavg("v")} AS a FROM assigned GROUP BY user_id, s) WHERE a >= 180"""
    return f"SELECT * FROM ({hr}) UNION ALL SELECT * FROM ({bp}) UNION ALL SELECT * FROM ({su})"


SQL["anchored_alerts"] = _anchored_alerts()
