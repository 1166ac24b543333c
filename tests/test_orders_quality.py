from datetime import datetime

from pyspark.sql import functions as F

from pulsegrid.operators import orders as OR
from pulsegrid.operators import quality as Q
from pulsegrid.sources.tables import spread

SCHEMA = "order_id string, status string, items array<struct<dish_code:string, quantity:int>>, total_amount double"


def test_nested_order_classes(spark):
    """Rule V3, each class from a good order changed in one place: dish codes just
    outside the menu, quantities at and below zero, a negated total."""
    menu = [f"D{n}" for n in range(101, 151)]
    good = dict(order_id="n1", status="ORDER_PLACED", items=[(menu[0], 1), (menu[-1], 4)], total_amount=42.5)
    cases = [
        ({}, "ok"),
        ({"total_amount": None}, "ok"),
        ({"items": [(menu[5], 1), ("D100", 1)]}, "invalid_dish"),
        ({"items": [("D" + menu[0], 1)]}, "invalid_dish"),
        ({"items": [(menu[3].lower(), 1)]}, "invalid_dish"),
        ({"items": [(menu[7], 2), (menu[8], 0)]}, "negative_quantity"),
        ({"items": [(menu[7], -2)]}, "negative_quantity"),
        ({"total_amount": -42.5}, "impossible_total"),
        (dict.fromkeys(good), "null_fields"),
        ({"status": "ORDER_" + menu[0]}, "invalid_status"),
    ]
    df = spark.createDataFrame([tuple((good | change).values()) for change, _ in cases], SCHEMA)
    assert [r.c for r in df.select(Q.order_class().alias("c")).collect()] == [want for _, want in cases]


def test_nested_items_per_dish(spark):
    df = spark.createDataFrame([("o1", "ORDER_PLACED", [("D101", 1), ("D101", 2), ("D102", 1)], 1.0), ("o2", "ORDER_PLACED", [("D101", 3)], 1.0)], SCHEMA)
    got = {r.dish_code: (r.orders, r.quantity) for r in OR.items_per_dish(df).collect()}
    assert got == {"D101": (2, 6), "D102": (1, 1)}


def test_bad_transitions_rules(spark):
    ev = [
        ("a", "ORDER_PLACED", datetime(2024, 1, 1, 10, 0)),
        ("a", "ORDER_COMPLETED", datetime(2024, 1, 1, 10, 10)),
        ("a", "PAYMENT_PENDING", datetime(2024, 1, 1, 10, 15)),
        ("b", "ORDER_PLACED", datetime(2024, 1, 1, 10, 0)),
        ("b", "PAYMENT_PENDING", datetime(2024, 1, 1, 11, 30)),  # skipped COMPLETED, across an hour bucket
        ("c", "ORDER_UPDATED", datetime(2024, 1, 1, 9, 0)),  # does not start with PLACED
        ("d", "ORDER_PLACED", datetime(2024, 1, 1, 9, 0)),
        ("d", "CANCELLED", datetime(2024, 1, 1, 9, 1)),  # declared but not in the flow
    ]
    df = spark.createDataFrame(ev, "order_id string, status string, ts timestamp")
    got = sorted((r.order_id, r.prev_status, r.status) for r in OR.bad_transitions(spark, df).collect())
    assert got == [("b", "ORDER_PLACED", "PAYMENT_PENDING"), ("c", None, "ORDER_UPDATED"), ("d", "ORDER_PLACED", "CANCELLED")]


def test_current_state(spark):
    ev = [("a", "ORDER_PLACED", datetime(2024, 1, 1, 10, 0)), ("a", "PAYMENT_COMPLETED", datetime(2024, 1, 1, 10, 20)), ("b", "ORDER_PLACED", datetime(2024, 1, 1, 10, 0))]
    df = spark.createDataFrame(ev, "order_id string, status string, ts timestamp")
    got = {r.order_id: (r.status, r.payment_status, r.events) for r in OR.current_state(df).collect()}
    assert got == {"a": ("PAYMENT_COMPLETED", "COMPLETED", 2), "b": ("ORDER_PLACED", "PENDING", 1)}


def test_gps_classes_order(spark):
    good = (48.2, 16.4, 55.0, 120.0, 4.0, 9)
    lat, lng, speed, heading, accuracy, satellites = good
    cases = [
        (good, "ok"),
        ((None, *good[1:]), "null_coords"),
        ((-lat - 90, lng + 180, -speed, heading + 360, -accuracy, -satellites), "out_of_range"),
        ((lat + 90, lng + 180, *good[2:]), "invalid_coords"),
        ((lat, lng, speed + 600, *good[3:]), "extreme_speed"),
    ]
    df = spark.createDataFrame([row for row, _ in cases], "latitude double, longitude double, speed_kmh double, heading double, accuracy_meters double, satellites int")
    assert [r.c for r in df.select(Q.gps_class().alias("c")).collect()] == [want for _, want in cases]


def test_more_items_make_more_partitions(spark):
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    items = spark.range(100 * default).selectExpr("id % 977 AS order_key", "id")
    wide = spread(items, "order_key", 50)
    assert wide.rdd.getNumPartitions() == 2 * default and wide.count() == 100 * default
    assert wide.groupBy(F.spark_partition_id().alias("p"), "order_key").count().groupBy("order_key").count().where("count > 1").count() == 0
    assert spread(items, "order_key", 100) is items
