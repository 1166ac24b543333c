"""DuckDB SQL for GPS and order queries."""

from __future__ import annotations

from .oracle_health import EV, pyround, with_

FX = """fx AS (
  SELECT 'VH-' || CAST(uid AS VARCHAR) AS vehicle_id, event_id, ts,
         CAST(12.9 AS DOUBLE) + CAST(event_id % 1000 AS DOUBLE) / CAST(10000.0 AS DOUBLE) AS latitude,
         CAST(77.5 AS DOUBLE) + CAST((event_id * 7) % 1000 AS DOUBLE) / CAST(10000.0 AS DOUBLE) AS longitude,
         CAST(20.0 AS DOUBLE) + v / 4 AS speed_kmh
  FROM ev WHERE k NOT IN (0, 1, 2, 3)
)"""

PR = """pr AS (
  SELECT *, lead(ts) OVER w AS next_ts, lead(event_id) OVER w AS next_event_id,
         lead(latitude) OVER w AS nlat, lead(longitude) OVER w AS nlng
  FROM fx WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, event_id)
)"""

STEP = 3_600_000_000

HEADING = """CASE WHEN degrees(atan2(nlng - longitude, nlat - latitude)) < 0
                  THEN degrees(atan2(nlng - longitude, nlat - latitude)) + 360
                  ELSE degrees(atan2(nlng - longitude, nlat - latitude)) END"""

OEV = """oev AS (
  SELECT 'ORD-' || CAST(o_orderkey AS VARCHAR) AS order_id, s.status,
         o_orderdate + to_minutes(s.minutes) AS ts
  FROM orders,
       (VALUES ('ORDER_PLACED', 0), ('ORDER_UPDATED', 5), ('ORDER_COMPLETED', 10),
               ('PAYMENT_PENDING', 15), ('PAYMENT_COMPLETED', 20)) s(status, minutes)
  WHERE NOT (s.status = 'ORDER_UPDATED' AND o_orderkey % 10 >= 3)
    AND NOT (s.status = 'ORDER_COMPLETED' AND o_orderkey % 97 = 0)
)"""

SQL = {
    "gps_heading": with_(EV, FX, PR)
    + f"""SELECT vehicle_id, event_id, next_event_id, ts,
  {pyround(HEADING, 1)} AS heading_deg
FROM pr WHERE next_event_id IS NOT NULL""",
    "gps_grid": with_(EV, FX, PR)
    + f""", g AS (
  SELECT *, epoch_us(ts) AS a, epoch_us(next_ts) AS b,
         ((epoch_us(ts) + {STEP - 1}) // {STEP}) * {STEP} AS f
  FROM pr WHERE next_event_id IS NOT NULL
)
SELECT vehicle_id, make_timestamp(f + i * {STEP}) AS grid_ts,
       latitude + (nlat - latitude) * (CAST(f + i * {STEP} - a AS DOUBLE) / CAST(b - a AS DOUBLE)) AS latitude,
       longitude + (nlng - longitude) * (CAST(f + i * {STEP} - a AS DOUBLE) / CAST(b - a AS DOUBLE)) AS longitude
FROM g, range(0, CASE WHEN f < b THEN (b - 1 - f) // {STEP} + 1 ELSE 0 END) t(i)""",
    "gps_distance": with_(EV, FX, PR)
    + f"""SELECT vehicle_id, count(*) AS fixes, {pyround("km", 3)} AS distance_km FROM (
SELECT vehicle_id, next_event_id,
       CAST(sum(CAST(CASE WHEN next_event_id IS NOT NULL
                          THEN speed_kmh / 3600 * (CAST(epoch_us(next_ts) - epoch_us(ts) AS DOUBLE) / 1e6) END AS DECIMAL(28, 9)))
            OVER (PARTITION BY vehicle_id) AS DOUBLE) AS km
FROM pr) GROUP BY vehicle_id, km""",
    "order_items": """SELECT 'D' || CAST(101 + l_partkey % 50 AS VARCHAR) AS dish_code,
       count(DISTINCT o_orderkey) AS orders,
       CAST(sum(CAST(trunc(l_quantity) AS INTEGER) % 3 + 1) AS BIGINT) AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderkey % 100 NOT IN (0, 1, 2, 3, 4)
GROUP BY 1""",
    "order_bad_transitions": with_(OEV)
    + """, x AS (
  SELECT order_id, status, ts, lag(status) OVER (PARTITION BY order_id ORDER BY ts, status) AS prev_status FROM oev
)
SELECT order_id, prev_status, status, ts FROM x
WHERE (prev_status IS NULL AND status <> 'ORDER_PLACED')
   OR (prev_status IS NOT NULL AND (prev_status, status) NOT IN (
        ('ORDER_PLACED', 'ORDER_UPDATED'), ('ORDER_PLACED', 'ORDER_COMPLETED'),
        ('ORDER_UPDATED', 'ORDER_COMPLETED'), ('ORDER_COMPLETED', 'PAYMENT_PENDING'),
        ('PAYMENT_PENDING', 'PAYMENT_COMPLETED')))""",
    "order_state": with_(OEV)
    + """SELECT order_id, arg_max(status, ts) AS status,
       CASE WHEN arg_max(status, ts) = 'PAYMENT_COMPLETED' THEN 'COMPLETED' ELSE 'PENDING' END AS payment_status,
       max(ts) AS last_ts, count(*) AS events
FROM oev GROUP BY order_id""",
}
