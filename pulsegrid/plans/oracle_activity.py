"""DuckDB SQL for device activity and data-quality queries."""

from __future__ import annotations

from .oracle_health import EV, pyround, with_

DM = """dm AS (
  SELECT CASE WHEN uid % 2 = 0 THEN 'wearable' ELSE 'restaurant' END AS device_type,
         CASE WHEN uid % 2 = 0 THEN 'wearable' ELSE 'restaurant' END || '_' || CAST(uid AS VARCHAR) AS device_id,
         k < 5 AS is_anomaly, ts AS sent_at
  FROM ev
)"""

PER_DEVICE = """pd AS (
  SELECT device_id, device_type, count(*) AS data_points_sent,
         CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS bad_data_points,
         max(sent_at) AS last_sent_at, min(sent_at) AS started_at
  FROM dm GROUP BY 1, 2
)"""

TYPES = """tm AS (
  SELECT t.device_type,
         CAST(coalesce(a.active_devices, 0) AS BIGINT) AS active_devices,
         CAST(coalesce(a.total_data_points, 0) AS BIGINT) AS total_data_points,
         CAST(coalesce(a.total_bad_data_points, 0) AS BIGINT) AS total_bad_data_points
  FROM (VALUES ('wearable'), ('restaurant'), ('gps')) t(device_type)
  FULL JOIN (SELECT device_type, count(*) AS active_devices, sum(data_points_sent) AS total_data_points,
                    sum(bad_data_points) AS total_bad_data_points FROM pd GROUP BY 1) a
    ON a.device_type = t.device_type
)"""


def _rate(bad: str, total: str) -> str:
    return pyround(f"CAST({bad} AS DOUBLE) / CAST(greatest({total}, 1) AS DOUBLE) * 100", 2)


HALF = "floor(v / 2)"
WV = f"""wv AS (
  SELECT event_id, k,
    CASE WHEN k IN (2, 3, 4, 6, 10, 11) THEN NULL
         WHEN k IN (0, 5) THEN -(70 + {HALF}) WHEN k = 1 THEN 370 + {HALF}
         WHEN k = 7 THEN 70 + {HALF} + 0.9 ELSE 70 + {HALF} END AS hr,
    CASE WHEN k IN (2, 3, 4) THEN NULL WHEN k = 0 THEN -(115 + {HALF})
         WHEN k = 1 THEN 415 + {HALF} ELSE 115 + {HALF} END AS sys,
    CASE WHEN k IN (2, 3, 4, 12) THEN NULL WHEN k = 0 THEN -(80 + 8 * (uid % 3))
         WHEN k = 1 THEN 280 + 8 * (uid % 3) ELSE 80 + 8 * (uid % 3) END AS dia,
    CASE WHEN k IN (2, 3, 4) THEN NULL WHEN k = 0 THEN -(110 + 2 * floor(v))
         WHEN k = 1 THEN 610 + 2 * floor(v) ELSE 110 + 2 * floor(v) END AS sugar
  FROM ev
)"""

WEARABLE = """SELECT event_id,
  CASE WHEN k = 4 THEN 'malformed'
       WHEN coalesce(hr < 0, false) OR coalesce(sys < 0, false) OR coalesce(dia < 0, false)
            OR coalesce(sugar < 0, false) THEN 'negative'
       WHEN coalesce(sys >= 300, false) OR coalesce(dia >= 200, false) OR coalesce(sugar >= 500, false)
            OR coalesce(hr >= 250, false) THEN 'extreme'
       WHEN k = 2 THEN 'null'
       WHEN k IN (3, 6, 11) THEN 'invalid_type'
       ELSE 'ok' END AS anomaly_class
FROM wv"""

GPS = """SELECT event_id, 'VH-' || CAST(uid AS VARCHAR) AS vehicle_id,
  CASE k WHEN 2 THEN 'null_coords' WHEN 3 THEN 'out_of_range' WHEN 0 THEN 'invalid_coords'
         WHEN 1 THEN 'extreme_speed' ELSE 'ok' END AS anomaly_class
FROM ev"""

ORDERS = """SELECT o_orderkey AS order_key,
  CASE WHEN o_orderkey % 100 = 3 OR NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) THEN 'null_fields'
       WHEN o_orderkey % 100 = 4 THEN 'invalid_status'
       WHEN o_orderkey % 100 = 0 THEN 'invalid_dish'
       WHEN o_orderkey % 100 = 1 THEN 'negative_quantity'
       WHEN o_orderkey % 100 = 2 AND o_totalprice > 0 THEN 'impossible_total'
       ELSE 'ok' END AS anomaly_class
FROM orders o"""

SQL = {
    "device_metrics": with_(EV, DM, PER_DEVICE) + "SELECT * FROM pd",
    "type_metrics": with_(EV, DM, PER_DEVICE, TYPES)
    + f"""SELECT device_type, active_devices, total_data_points, total_bad_data_points,
       {_rate('total_bad_data_points', 'total_data_points')} AS bad_data_rate FROM tm""",
    "overall_summary": with_(EV, DM, PER_DEVICE, TYPES)
    + f"""SELECT device_type, active_devices, total_data_points, total_bad_data_points,
       {_rate('total_bad_data_points', 'total_data_points')} AS bad_data_rate FROM tm
UNION ALL
SELECT 'all', CAST(sum(active_devices) AS BIGINT), CAST(sum(total_data_points) AS BIGINT),
       CAST(sum(total_bad_data_points) AS BIGINT),
       {_rate('sum(total_bad_data_points)', 'sum(total_data_points)')} FROM tm""",
    "device_counts": with_(EV, DM, PER_DEVICE)
    + """SELECT device_type, count(*) AS devices FROM pd GROUP BY 1
UNION ALL SELECT 'all', count(*) FROM pd""",
    "wearable_classes": with_(EV, WV) + WEARABLE,
    "gps_classes": with_(EV) + GPS,
    "order_classes": ORDERS,
    "quality_report": with_(EV, WV)
    + f""", u AS (
  SELECT 'wearable' AS device_type, anomaly_class FROM ({WEARABLE})
  UNION ALL SELECT 'gps', anomaly_class FROM ({GPS})
  UNION ALL SELECT 'restaurant', anomaly_class FROM ({ORDERS})
), a AS (SELECT device_type, anomaly_class, count(*) AS messages FROM u GROUP BY 1, 2)
SELECT device_type, anomaly_class, messages,
       {pyround("CAST(messages AS DOUBLE) / CAST(sum(messages) OVER (PARTITION BY device_type) AS DOUBLE) * 100", 2)} AS rate_pct
FROM a""",
}
