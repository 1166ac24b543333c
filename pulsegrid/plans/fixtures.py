"""Adapters: derive the device-message shapes from the driver tables.

Every adapter is a Spark projection/join over the given tables, so its work
grows with them. The DuckDB oracle recomputes the same values from the
table columns directly (never through JSON), which tests parsing
independently.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import options as O
from ..functions.fence import fence
from ..sources.tables import dealt, table

ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _iso(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), ISO_FMT)


EVENT_COLUMNS = ("event_id", "ts", "user_id", "value", "k")


def events(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = EVENT_COLUMNS) -> DataFrame:
    """The named columns of ``events``, with ``k`` extracted and ``ts`` as a
    zoned TIMESTAMP (UTC).

    Fenced, so a later filter on derived columns does not copy the JSON
    extraction of ``k`` into a pushed-down predicate. The fence hides what is
    unused above it from the scan, so callers name the columns they need."""
    made = {"ts": F.col("ts").cast("timestamp").alias("ts"), "k": _k().alias("k")}
    scan = table(spark, sf_dir, "events").select(*["props" if c == "k" else c for c in columns])
    return fence(dealt(scan), [made.get(c, F.col(c)) for c in columns])


# ---------------------------------------------------------------------------
# health messages: JSON text exercising every parsing rule
# ---------------------------------------------------------------------------


def _s(c: Column) -> Column:
    return c.cast("string")


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _obj(*pairs) -> Column:
    """JSON object text from (key, JSON-text column) pairs (flat concat)."""
    parts = [F.lit("{")]
    for i, (k, v) in enumerate(pairs):
        parts.append(F.lit(("" if i == 0 else ", ") + f'"{k}": '))
        parts.append(v)
    parts.append(F.lit("}"))
    return F.concat(*parts)


def _hr(v: Column) -> Column:
    return _obj(("value", v), ("unit", F.lit('"bpm"')))


def _bp(s: Column, d: Column | None) -> Column:
    pairs = [("systolic", s)] + ([("diastolic", d)] if d is not None else []) + [("unit", F.lit('"mmHg"'))]
    return _obj(*pairs)


def _sugar(v: Column) -> Column:
    return _obj(("value", v), ("unit", F.lit('"mg/dL"')))


def _payload(hr=None, bp=None, sugar=None, user=True, with_hr=True) -> Column:
    pairs = [("device_id", _q(F.concat(F.lit("wearable_"), _s(F.col("user_id")))))]
    if user:
        pairs.append(("user_id", _q(F.concat(F.lit("user_"), _s(F.col("user_id"))))))
    if with_hr:
        pairs.append(("heart_rate", hr))
    pairs += [
        ("blood_pressure", bp),
        ("blood_sugar", sugar),
        ("is_anomaly", F.when(F.col("k") < 5, F.lit("true")).otherwise(F.lit("false"))),
        ("timestamp", _q(_iso(F.col("ts")))),
    ]
    return _obj(*pairs)


@functools.lru_cache(maxsize=1)
def health_message_text() -> Column:
    """Wearable JSON message text of one ``events`` row (see ``health_messages``).

    Built by flat string concatenation: cheap per row and small enough to
    stay inside one whole-stage-codegen method. The expression refers to
    columns by name only, so it is built once per process and reused."""
    half = F.floor(F.col("value") / 2)
    hr = F.lit(70) + half
    sys_ = F.lit(115) + half
    dia = F.lit(80) + F.lit(8) * (F.col("user_id") % 3)
    su = F.lit(110) + F.lit(2) * F.floor(F.col("value"))
    k = F.col("k")
    null = F.lit("null")
    # per-field JSON text, varied by k
    hr_c = (
        F.when(k.isin(0, 5), _hr(_s(-hr)))
        .when(k == 1, _hr(_s(hr + 300)))
        .when(k == 2, null)
        .when(k == 3, F.concat(F.lit("["), _s(hr), F.lit("]")))
        .when(k == 6, _hr(_q(_s(hr))))
        .when(k == 7, _hr(_s(hr.cast("double") + 0.9)))
        .when(k == 11, _hr(F.lit("true")))
        .otherwise(_hr(_s(hr)))
    )
    bp_c = (
        F.when(k == 0, _bp(_s(-sys_), _s(-dia)))
        .when(k == 1, _bp(_s(sys_ + 300), _s(dia + 200)))
        .when(k == 2, null)
        .when(k == 3, _q(F.concat(_s(sys_), F.lit(" over "), _s(dia))))
        .when(k == 12, _bp(_s(sys_), None))
        .otherwise(_bp(_s(sys_), _s(dia)))
    )
    su_c = (
        F.when(k == 0, _sugar(_s(-su)))
        .when(k == 1, _sugar(_s(su + 500)))
        .when(k == 2, null)
        .when(k == 3, _obj(("event", _s(F.col("event_id")))))
        .otherwise(_sugar(_s(su)))
    )
    full = _payload(hr_c, bp_c, su_c)
    envelope = _obj(
        ("kafka_topic", F.lit(f'"{O.TOPIC_WEARABLES}"')),
        ("kafka_partition", _s(F.col("user_id") % 4)),
        ("kafka_offset", _s(F.col("event_id"))),
        ("ingestion_protocol", F.lit(f'"{O.INGESTION_PROTOCOL}"')),
        ("ingested_at", _q(_iso(F.col("ts")))),
        ("raw_data", full),
    )
    return (
        F.when(k == 4, F.substring(full, 1, 40))
        .when(k == 8, envelope)
        .when(k == 9, _payload(hr_c, bp_c, su_c, user=False))
        .when(k == 10, _payload(None, bp_c, su_c, with_hr=False))
        .otherwise(full)
    )


def health_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, timestamp, value)`` — one wearable JSON message per event.

    Base readings: HR ``70+floor(value/2)``, systolic ``115+floor(value/2)``,
    diastolic ``80+8*(user_id%3)``, sugar ``110+2*floor(value)``; ``k``
    selects the variation (negatives, extremes, nulls, wrong types,
    malformed text, floats, envelope, missing keys, booleans).
    """
    ev = events(spark, sf_dir)
    return ev.select("event_id", F.col("ts").alias("timestamp"), health_message_text().alias("value"))


# ---------------------------------------------------------------------------
# enriched envelopes and device messages
# ---------------------------------------------------------------------------


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched Kafka envelopes: topic by ``user_id%3``, partition ``user_id%4``,
    offset ``event_id``, ingested at ``ts``, raw_data the health message."""
    ev = events(spark, sf_dir)
    topic = (
        F.when(F.col("user_id") % 3 == 0, F.lit(O.TOPIC_WEARABLES))
        .when(F.col("user_id") % 3 == 1, F.lit(O.TOPIC_RESTAURANTS))
        .otherwise(F.lit(O.TOPIC_GPS))
    )
    # One projection over one scan: no join back to the events table.
    return ev.select(
        topic.alias("kafka_topic"),
        (F.col("user_id") % 4).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.lit(O.INGESTION_PROTOCOL).alias("ingestion_protocol"),
        F.col("ts").alias("ingested_at"),
        health_message_text().alias("raw_data"),
    )


def device_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device activity: wearable/restaurant by ``user_id%2`` (no GPS rows)."""
    ev = events(spark, sf_dir, ("event_id", "ts", "user_id", "k"))
    dtype = F.when(F.col("user_id") % 2 == 0, F.lit("wearable")).otherwise(F.lit("restaurant"))
    return ev.select(
        F.concat(dtype, F.lit("_"), F.col("user_id").cast("string")).alias("device_id"),
        dtype.alias("device_type"),
        (F.col("k") < 5).alias("is_anomaly"),
        F.col("ts").alias("sent_at"),
        "event_id",
    )


# ---------------------------------------------------------------------------
# GPS fixes
# ---------------------------------------------------------------------------

def gps_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    k = F.col("k")
    eid = F.col("event_id")
    lat = F.lit(12.9) + (eid % 1000) / F.lit(10000.0)
    lng = F.lit(77.5) + ((eid * 7) % 1000) / F.lit(10000.0)
    speed = F.lit(20.0) + F.col("value") / 4
    heading = (eid % 360).cast("double")
    altitude, accuracy = F.lit(900.0), F.lit(5.0)
    sats = (F.lit(6) + k % 7).cast("int")
    nd = F.lit(None).cast("double")
    return ev.select(
        F.concat(F.lit("VH-"), F.col("user_id").cast("string")).alias("vehicle_id"),
        "event_id",
        "ts",
        F.when(k == 0, lat + 90).when(k == 2, nd).when(k == 3, -lat - 90).otherwise(lat).alias("latitude"),
        F.when(k == 0, lng + 180).when(k == 2, nd).when(k == 3, lng + 120).otherwise(lng).alias("longitude"),
        F.when(k == 2, nd).when(k == 3, -altitude).otherwise(altitude).alias("altitude"),
        F.when(k == 1, speed + 600).when(k == 2, nd).when(k == 3, -speed).otherwise(speed).alias("speed_kmh"),
        F.when(k == 2, nd).when(k == 3, heading + 360).otherwise(heading).alias("heading"),
        F.when(k == 2, nd).when(k == 3, -accuracy).otherwise(accuracy).alias("accuracy_meters"),
        F.when(k == 2, F.lit(0)).when(k == 3, -sats).otherwise(sats).alias("satellites"),
    )


# ---------------------------------------------------------------------------
# restaurant orders
# ---------------------------------------------------------------------------


def _order_class_key() -> Column:
    return F.col("o_orderkey") % 100


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order message fields other than the items, one row per order; by
    ``o_orderkey % 100``: 2 negative total, 3 null fields, 4 invalid status."""
    o = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))
    c = _order_class_key()
    null_s = F.lit(None).cast("string")
    return o.select(
        F.concat(F.lit("rest_"), (F.col("o_custkey") % 10).cast("string")).alias("restaurant_id"),
        F.when(c == 3, null_s).otherwise(F.concat(F.lit("T-"), F.lpad((F.col("o_orderkey") % 20 + 1).cast("string"), 2, "0"))).alias("table_id"),
        F.when(c == 3, null_s).otherwise(F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string"))).alias("order_id"),
        F.col("o_orderkey").alias("order_key"),
        F.when(c == 3, null_s).when(c == 4, F.concat(F.lit("STEP_"), F.col("o_orderkey").cast("string"))).otherwise(F.lit("ORDER_PLACED")).alias("status"),
        (c != 3).alias("has_items"),
        F.when(c == 3, null_s).when(c == 4, F.concat(F.lit("PAID_"), F.col("o_orderkey").cast("string"))).otherwise(F.lit("PENDING")).alias("payment_status"),
        F.when(c.isin(3, 4), F.lit(None).cast("double")).when(c == 2, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias(
            "total_amount"
        ),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def order_item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order messages' items, one row per item (``lineitem``):
    ``dish_code = 'D' || (101 + l_partkey % 50)``, ``quantity =
    int(l_quantity) % 3 + 1``; by ``l_orderkey % 100``: 0 invalid dish codes,
    1 quantities <= 0, 3 no items (the message's items are null).

    The items stay flat — the tables are normalised, and rebuilding an array
    per order would gather a whole order into one row."""
    li = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity"))
    cls = F.col("l_orderkey") % 100
    dish = F.when(cls == 0, F.concat(F.lit("D-"), (F.col("l_partkey") % 1000).cast("string"))).otherwise(
        F.concat(F.lit("D"), (F.lit(101) + F.col("l_partkey") % 50).cast("string"))
    )
    q = F.col("l_quantity").cast("int") % 3
    qty = F.when(cls == 1, -q).otherwise(q + 1)
    return li.filter(cls != 3).select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        dish.alias("dish_code"),
        qty.cast("int").alias("quantity"),
    )


ORDER_FLOW = (
    # (status, minutes after placement) in life-cycle order
    ("ORDER_PLACED", 0),
    ("ORDER_UPDATED", 5),
    ("ORDER_COMPLETED", 10),
    ("PAYMENT_PENDING", 15),
    ("PAYMENT_COMPLETED", 20),
)


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events per order: UPDATED only when ``o_orderkey%10<3``;
    COMPLETED skipped when ``o_orderkey%97=0`` (a bad transition)."""
    o = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    steps = F.array(*[F.struct(F.lit(s).alias("status"), F.lit(m).alias("minutes")) for s, m in ORDER_FLOW])
    ok = F.col("o_orderkey")
    e = o.select(ok, F.col("o_orderdate").cast("timestamp").alias("placed"), F.explode(steps).alias("s"))
    keep = ~((F.col("s.status") == "ORDER_UPDATED") & (ok % 10 >= 3)) & ~(
        (F.col("s.status") == "ORDER_COMPLETED") & (ok % 97 == 0)
    )
    return e.filter(keep).select(
        F.concat(F.lit("ORD-"), ok.cast("string")).alias("order_id"),
        F.col("s.status").alias("status"),
        (F.col("placed") + F.make_dt_interval(mins=F.col("s.minutes"))).alias("ts"),
    )


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped rows (``topic, partition, offset, value, timestamp``) of the
    health messages, as a Kafka source would deliver them."""
    e = enriched(spark, sf_dir)
    return e.select(
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("raw_data").alias("value"),
        F.col("ingested_at").alias("timestamp"),
    )
