"""GPS sequence operators: heading, interpolation grid, distance travelled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round_half_even
from .sequence import with_next


def _pairs(fixes: DataFrame, bucket: str = "hour") -> DataFrame:
    return with_next(fixes, "vehicle_id", "ts", "event_id", ("latitude", "longitude", "speed_kmh"), bucket)


def heading(fixes: DataFrame, bucket: str = "hour") -> DataFrame:
    """Heading from each fix to the next one of the same vehicle: planar
    ``atan2(dlng, dlat)`` in degrees, +360 when negative, 1 decimal."""
    p = _pairs(fixes, bucket).filter(F.col("next_event_id").isNotNull())
    h = F.degrees(F.atan2(F.col("next_longitude") - F.col("longitude"), F.col("next_latitude") - F.col("latitude")))
    h = F.when(h < 0, h + 360).otherwise(h)
    return p.select(
        "vehicle_id",
        "event_id",
        "next_event_id",
        "ts",
        round_half_even(h, 1).alias("heading_deg"),
    )


def grid(fixes: DataFrame, step_minutes: int = 60, bucket: str = "hour") -> DataFrame:
    """Linear positions between consecutive fixes on a regular time grid
    (grid points ``p.ts <= t < q.ts``)."""
    step = step_minutes * 60_000_000
    p = _pairs(fixes, bucket).filter(F.col("next_event_id").isNotNull())
    p = p.select("*", F.unix_micros("ts").alias("_a"), F.unix_micros("next_ts").alias("_b"))
    # integer arithmetic: first grid point at or after ts, number of points before next_ts
    p = p.withColumn("_first", F.expr(f"((_a + {step - 1}) div {step}) * {step}"))
    p = p.withColumn("_n", F.expr(f"CASE WHEN _first < _b THEN ((_b - 1 - _first) div {step}) + 1 ELSE 0 END"))
    p = p.filter(F.col("_n") > 0)
    e = p.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_i"))
    t = F.col("_first") + F.col("_i") * step
    frac = (t - F.col("_a")).cast("double") / (F.col("_b") - F.col("_a")).cast("double")
    return e.select(
        "vehicle_id",
        F.timestamp_micros(t).alias("grid_ts"),
        (F.col("latitude") + (F.col("next_latitude") - F.col("latitude")) * frac).alias("latitude"),
        (F.col("longitude") + (F.col("next_longitude") - F.col("longitude")) * frac).alias("longitude"),
    )


def distance(fixes: DataFrame, bucket: str = "hour") -> DataFrame:
    """Distance per vehicle: sum over consecutive fixes of
    ``speed_kmh / 3600 * seconds`` (speed of the earlier fix)."""
    p = _pairs(fixes, bucket)
    secs = (F.unix_micros("next_ts") - F.unix_micros("ts")).cast("double") / 1e6
    seg = F.when(F.col("next_event_id").isNotNull(), F.col("speed_kmh") / 3600 * secs)
    return p.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("fixes"),
        # a decimal sum: the same in whatever order the segments meet
        round_half_even(F.sum(seg.cast("decimal(28,9)")).cast("double"), 3).alias("distance_km"),
    )
