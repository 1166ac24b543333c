"""DuckDB SQL for the ingestion and browsing queries."""

from __future__ import annotations

from .oracle_health import EV, HR_ALERTS, REC, SUGAR_ALERTS, _bp_groups, _hr_groups, _sugar_groups, bp_alerts_sql, pyround, with_

RAW = """raw AS (
  SELECT CASE uid % 3 WHEN 0 THEN 'virtual_wearables' WHEN 1 THEN 'virtual_restaurants' ELSE 'virtual_gps' END AS "table",
         CASE WHEN k IN (4, 8) THEN 'unknown' ELSE 'wearable_' || CAST(uid AS VARCHAR) END AS device_id,
         CASE uid % 3 WHEN 0 THEN 'virtual-wearables' WHEN 1 THEN 'virtual-restaurants' ELSE 'virtual-gps' END AS kafka_topic,
         CAST(uid % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
         'kafka' AS ingestion_protocol, ts AS ingested_at
  FROM ev
)"""

ISO = """CASE WHEN microsecond(ingested_at) % 1000000 = 0
     THEN strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') || '+00:00'
     ELSE strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END"""


def _page(limit: int, offset: int, device: str | None = None) -> str:
    where = "\"table\" = 'virtual_wearables'" + (f" AND device_id = '{device}'" if device else "")
    return with_(EV, RAW) + f"""SELECT device_id, kafka_topic, kafka_partition, kafka_offset, ingestion_protocol,
       {ISO} AS ingested_at,
       (SELECT count(*) FROM raw WHERE "table" = 'virtual_wearables') AS total
FROM (SELECT * FROM raw WHERE {where}
      ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC
      LIMIT {limit} OFFSET {offset})"""


SQL = {
    "kafka_sink_rows": with_(EV)
    + """SELECT d || '_' || CAST(uid AS VARCHAR) AS key,
  '{"device_id":"' || d || '_' || CAST(uid AS VARCHAR) || '","device_type":"' || d || '","event_id":' || CAST(event_id AS VARCHAR)
  || ',"reading":' || CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 100 AS VARCHAR) ELSE 'null' END
  || ',"is_anomaly":' || CASE WHEN k < 5 THEN 'true' ELSE 'false' END || '}' AS value,
  'virtual-' || d || 's' AS topic
FROM (SELECT *, CASE WHEN uid % 2 = 0 THEN 'wearable' ELSE 'restaurant' END AS d FROM ev)""",
    "enriched_messages": with_(EV, RAW) + "SELECT * FROM raw",
    "topic_routing": with_(EV, RAW)
    + """SELECT "table", CAST(ingested_at AS DATE) AS ingest_date, count(*) AS "rows" FROM raw GROUP BY 1, 2""",
    "topic_stats": with_(EV, RAW)
    + """SELECT kafka_topic, count(*) AS messages_consumed, max(ingested_at) AS last_message,
       first(kafka_offset ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC) AS last_offset
FROM raw GROUP BY kafka_topic""",
    "table_stats": with_(EV, RAW)
    + """SELECT t."table", CAST(coalesce(s.row_count, 0) AS BIGINT) AS row_count, s.latest_record
FROM (VALUES ('virtual_wearables'), ('virtual_restaurants'), ('virtual_gps')) t("table")
LEFT JOIN (SELECT "table", count(*) AS row_count, max(ingested_at) AS latest_record FROM raw GROUP BY 1) s
  ON s."table" = t."table\"""",
    "table_page": _page(50, 100),
    "table_page_device": _page(10, 0, "wearable_3"),
    "table_page_json": with_(EV)
    + f"""SELECT event_id AS kafka_offset, {ISO} AS ingested_at, k <> 4 AS is_json,
       CASE WHEN k NOT IN (4, 8) THEN CAST(k < 5 AS VARCHAR) END AS is_anomaly,
       CASE WHEN k NOT IN (4, 8, 9) THEN 'user_' || CAST(uid AS VARCHAR) END AS user_id,
       CAST(CASE WHEN k IN (2, 3, 4, 8) THEN NULL WHEN k = 0 THEN -(115 + floor(v / 2))
                 WHEN k = 1 THEN 415 + floor(v / 2) ELSE 115 + floor(v / 2) END AS DOUBLE) AS systolic,
       CASE WHEN k = 8 THEN 'user_' || CAST(uid AS VARCHAR) END AS wrapped_user_id
FROM (SELECT *, ts AS ingested_at FROM ev WHERE uid % 3 = 0 ORDER BY ts DESC, uid % 4 DESC, event_id DESC LIMIT 100)""",
    "latest_metrics": with_(EV, REC, _hr_groups())
    + f"""SELECT window_end AS time, user_id, 'heart_rate' AS metric_type, window_start, window_end,
       CAST({pyround("a", 2)} AS DOUBLE) AS avg_value, CAST(mn AS DOUBLE) AS min_value,
       CAST(mx AS DOUBLE) AS max_value, CAST(n AS BIGINT) AS reading_count
FROM hr ORDER BY window_end DESC, user_id LIMIT 20""",
    "latest_alerts": with_(EV, REC, _hr_groups(), _bp_groups(), _sugar_groups())
    + f"""SELECT * FROM ({HR_ALERTS} UNION ALL {bp_alerts_sql(0)} UNION ALL {SUGAR_ALERTS})
ORDER BY time DESC, user_id, alert_type LIMIT 20""",
}
