"""Queries: GPS sequences and restaurant orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geo as G
from ..operators import orders as OR
from ..operators import quality as Q
from ..sources.tables import spread
from . import fixtures as X
from .common import ntz, prepare


def _ok_fixes(spark, sf_dir):
    f = X.gps_fixes(prepare(spark), sf_dir)
    return f.filter(Q.gps_class() == "ok")


def gps_heading(spark, sf_dir):
    return ntz(G.heading(_ok_fixes(spark, sf_dir)))


def gps_grid(spark, sf_dir):
    return ntz(G.grid(_ok_fixes(spark, sf_dir), step_minutes=60))


def gps_distance(spark, sf_dir):
    return G.distance(_ok_fixes(spark, sf_dir))


def order_items(spark, sf_dir):
    prepare(spark)
    # a task holds its items' orders twice (class and dishes): more items make more tasks
    items = spread(X.order_item_rows(spark, sf_dir), "order_key")
    ok = Q.classify_orders(X.order_headers(spark, sf_dir), items).filter(F.col("anomaly_class") == "ok")
    return OR.items_per_dish_rows(items, ok)


def order_bad_transitions(spark, sf_dir):
    return ntz(OR.bad_transitions(spark, X.order_events(prepare(spark), sf_dir)))


def order_state(spark, sf_dir):
    return ntz(OR.current_state(X.order_events(prepare(spark), sf_dir)))


QUERIES = {
    "gps_heading": gps_heading,
    "gps_grid": gps_grid,
    "gps_distance": gps_distance,
    "order_items": order_items,
    "order_bad_transitions": order_bad_transitions,
    "order_state": order_state,
}
