"""Data-quality classes for wearable, GPS and order messages, and a report.

The rules are the anomaly kinds the device simulators emit; the checks are
evaluated in a fixed order because classes overlap (first match wins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import options as O
from ..functions import jsonx as J
from ..functions.rounding import round_half_even

_NUMERIC = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")


def _num(v: Column) -> Column:
    """JSON number (booleans excluded) → double, else NULL."""
    t = J.vtype(v)
    return F.when(t.isin(*_NUMERIC) | t.startswith("DECIMAL"), J.as_double(v))


def classify_wearables(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``anomaly_class`` to wearable JSON messages:
    malformed / negative / extreme / null / invalid_type / ok.

    The parsed variant is its own column so the JSON text is parsed once.
    """
    x = df.withColumn("_j", J.parse(F.col(value_col)))
    x = x.withColumn("_p", F.coalesce(J.get(F.col("_j"), "$.raw_data"), F.col("_j")))
    return x.withColumn("anomaly_class", _wearable_class(F.col("_j"), F.col("_p"))).drop("_j", "_p")


def _wearable_class(j: Column, p: Column) -> Column:
    containers = [J.get(p, f"$.{c}") for c in ("heart_rate", "blood_pressure", "blood_sugar")]
    vals = {
        "hr": J.get(p, "$.heart_rate.value"),
        "sys": J.get(p, "$.blood_pressure.systolic"),
        "dia": J.get(p, "$.blood_pressure.diastolic"),
        "sugar": J.get(p, "$.blood_sugar.value"),
    }
    nums = {k: _num(v) for k, v in vals.items()}
    negative = F.lit(False)
    for n in nums.values():
        negative = negative | F.coalesce(n < 0, F.lit(False))
    extreme = (
        F.coalesce(nums["sys"] >= O.EXTREME_SYSTOLIC, F.lit(False))
        | F.coalesce(nums["dia"] >= O.EXTREME_DIASTOLIC, F.lit(False))
        | F.coalesce(nums["sugar"] >= O.EXTREME_SUGAR, F.lit(False))
        | F.coalesce(nums["hr"] >= O.EXTREME_HEART_RATE, F.lit(False))
    )
    all_null = F.lit(True)
    for c in containers:
        all_null = all_null & J.is_absent(c)
    bad_type = F.lit(False)
    for c in containers:
        bad_type = bad_type | (~J.is_absent(c) & ~F.coalesce(J.is_object(c), F.lit(False)))
    for k, v in vals.items():
        bad_type = bad_type | (~J.is_absent(v) & nums[k].isNull())
    malformed = j.isNull() | ~F.coalesce(J.is_object(j), F.lit(False)) | ~F.coalesce(J.is_object(p), F.lit(False))
    return (
        F.when(malformed, "malformed")
        .when(negative, "negative")
        .when(extreme, "extreme")
        .when(all_null, "null")
        .when(bad_type, "invalid_type")
        .otherwise("ok")
    )


def gps_class() -> Column:
    """null_coords / out_of_range / invalid_coords / extreme_speed / ok."""
    lat, lng = F.col("latitude"), F.col("longitude")
    out_of_range = (
        (F.col("speed_kmh") < 0) | (F.col("accuracy_meters") < 0) | (F.col("satellites") < 0) | (F.col("heading") > O.MAX_HEADING)
    )
    invalid = (F.abs(lat) > 90) | (F.abs(lng) > 180)
    return (
        F.when(lat.isNull() | lng.isNull(), "null_coords")
        .when(F.coalesce(out_of_range, F.lit(False)), "out_of_range")
        .when(invalid, "invalid_coords")
        .when(F.coalesce(F.col("speed_kmh") >= O.EXTREME_SPEED_KMH, F.lit(False)), "extreme_speed")
        .otherwise("ok")
    )


def bad_dish(code: Column) -> Column:
    """Dish code not of the form ``D`` + three digits within D101..D150."""
    num = F.regexp_extract(code, r"^D(\d{3})$", 1).try_cast("int")
    return ~code.rlike(r"^D\d{3}$") | ~F.coalesce(num.between(O.DISH_CODE_FIRST, O.DISH_CODE_LAST), F.lit(False))


def bad_quantity(q: Column) -> Column:
    return F.coalesce(q <= 0, F.lit(True))


def _order_case(missing: Column, dish: Column, qty: Column) -> Column:
    return (
        F.when(F.col("order_id").isNull() | F.col("status").isNull() | missing, "null_fields")
        .when(~F.col("status").isin(*O.ORDER_STATUSES), "invalid_status")
        .when(dish, "invalid_dish")
        .when(qty, "negative_quantity")
        .when(F.coalesce(F.col("total_amount") < 0, F.lit(False)), "impossible_total")
        .otherwise("ok")
    )


def order_class() -> Column:
    """Class of a nested order message (``items`` array inside the message):
    null_fields / invalid_status / invalid_dish / negative_quantity /
    impossible_total / ok."""
    items = F.col("items")
    return _order_case(
        items.isNull(),
        F.exists(items, lambda x: bad_dish(x["dish_code"])),
        F.exists(items, lambda x: bad_quantity(x["quantity"])),
    )


def classify_orders(headers: DataFrame, items: DataFrame, key: str = "order_key") -> DataFrame:
    """Same classes for normalised orders (header rows + one row per item).

    Items are reduced per order with partial aggregates (``bool_or``,
    count) — a hot order is combined map-side — and joined 1:1 to the
    headers; no items array is ever built."""
    per_order = items.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.bool_or(bad_dish(F.col("dish_code"))).alias("_bad_dish"),
        F.bool_or(bad_quantity(F.col("quantity"))).alias("_bad_qty"),
    )
    j = headers.join(per_order, key, "left")
    missing = ~F.coalesce(F.col("has_items"), F.lit(True)) | F.col("_n").isNull()
    return j.withColumn(
        "anomaly_class", _order_case(missing, F.coalesce("_bad_dish", F.lit(False)), F.coalesce("_bad_qty", F.lit(False)))
    ).drop("_n", "_bad_dish", "_bad_qty")


def quality_report(classified: DataFrame) -> DataFrame:
    """``(device_type, anomaly_class)`` rows → count and percentage within the
    device type. The percentage window runs over the aggregated rows (one
    per type × class), never over raw messages."""
    agg = classified.groupBy("device_type", "anomaly_class").agg(F.count(F.lit(1)).alias("messages"))
    tot = F.sum("messages").over(Window.partitionBy("device_type"))
    r = F.col("messages").cast("double") / tot.cast("double") * 100
    return agg.select("device_type", "anomaly_class", "messages", round_half_even(r, 2).alias("rate_pct"))
