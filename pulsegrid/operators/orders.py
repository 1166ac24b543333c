"""Restaurant order operators: items per dish, life-cycle check, current state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import options as O
from .sequence import with_next


def items_per_dish(orders: DataFrame) -> DataFrame:
    """Explode order items and total the quantity per dish.

    Two algebraic levels — (order, dish) then dish — count distinct orders
    without a distinct-aggregate expansion, and both combine map-side, so a
    hot dish is pre-aggregated before its shuffle."""
    e = orders.select("order_id", F.explode("items").alias("it")).select(
        "order_id", F.col("it.dish_code").alias("dish_code"), F.col("it.quantity").alias("quantity")
    )
    per_order = e.groupBy("order_id", "dish_code").agg(F.sum("quantity").alias("q"))
    return per_order.groupBy("dish_code").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("q").cast("long").alias("quantity"),
    )


def items_per_dish_rows(items: DataFrame, orders: DataFrame, key: str = "order_key") -> DataFrame:
    """Items per dish for normalised orders: item rows of the given orders
    (semi-join), then the same two algebraic levels."""
    e = items.join(orders.select(key), key, "left_semi")
    per_order = e.groupBy(key, "dish_code").agg(F.sum("quantity").alias("q"))
    return per_order.groupBy("dish_code").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("q").cast("long").alias("quantity"),
    )


def transitions(spark: SparkSession) -> DataFrame:
    """Allowed (from, to) status pairs; a fixed five-row table."""
    return spark.createDataFrame(list(O.ORDER_TRANSITIONS), "prev_status string, status string")


def bad_transitions(spark: SparkSession, events: DataFrame, bucket: str = "hour") -> DataFrame:
    """Status changes not in the allowed life cycle, and orders whose first
    status is not ORDER_PLACED.

    Consecutive events come from the skew-resistant ``with_next`` (no
    per-order window that would sort a hot order in one task); the first
    event per order is a ``min_by`` partial aggregate. The allowed-pairs
    table is a fixed five rows and is broadcast."""
    nxt = with_next(events.select("order_id", "status", "ts"), "order_id", "ts", "status", (), bucket)
    changes = nxt.filter(F.col("next_status").isNotNull()).select(
        "order_id", F.col("status").alias("prev_status"), F.col("next_status").alias("status"), F.col("next_ts").alias("ts")
    )
    bad = changes.join(F.broadcast(transitions(spark)), ["prev_status", "status"], "left_anti")
    first = events.groupBy("order_id").agg(F.min_by(F.struct("status", "ts"), F.struct("ts", "status")).alias("f"))
    first_bad = first.filter(F.col("f.status") != "ORDER_PLACED").select(
        "order_id", F.lit(None).cast("string").alias("prev_status"), F.col("f.status").alias("status"), F.col("f.ts").alias("ts")
    )
    return bad.unionByName(first_bad).select("order_id", "prev_status", "status", "ts")


def current_state(events: DataFrame) -> DataFrame:
    """Latest status per order and the derived payment status."""
    s = events.groupBy("order_id").agg(
        F.max_by(F.struct("ts", "status"), F.struct("ts", "status")).alias("last"),
        F.count(F.lit(1)).alias("events"),
    )
    st = F.col("last.status")
    return s.select(
        "order_id",
        st.alias("status"),
        F.when(st == "PAYMENT_COMPLETED", "COMPLETED").otherwise("PENDING").alias("payment_status"),
        F.col("last.ts").alias("last_ts"),
        "events",
    )
