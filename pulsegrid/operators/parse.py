"""Health message parsing (JSON text → typed reading), UDF-free.

Two validity policies:

* ``record`` — one bad field makes the whole reading invalid: every metric
  becomes -1 and ``valid = 0``. Numbers are truncated to INT. Malformed
  messages are kept as an ``unknown`` row with ``valid = 0``.
* ``metric`` — only the bad field is dropped (NULL); floats are kept;
  malformed messages are skipped.

A field is acceptable when it is absent (missing key, JSON null, or its
container is not an object) or when it is a JSON number/boolean > 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonx as J
from ..functions.fence import fence
from ..options import DEFAULT, Options

# (output column, JSON path inside the payload)
FIELDS = (
    ("heart_rate", "$.heart_rate.value"),
    ("bp_systolic", "$.blood_pressure.systolic"),
    ("bp_diastolic", "$.blood_pressure.diastolic"),
    ("blood_sugar", "$.blood_sugar.value"),
)
METRIC_COLS = tuple(name for name, _ in FIELDS)
_INT_MAX = 2147483647


def _extract(df: DataFrame, value_col: str, ts_col: str | None, opts: Options) -> DataFrame:
    """Add the private parse columns (``_j``, ``_p``, ``_bad``, per-field ``_v_*``)."""
    df = df.withColumn("_j", J.parse(F.col(value_col)))
    # Envelope unwrap: a missing raw_data means the root is the payload; an
    # explicit null (VOID, not SQL NULL) or a non-object raw_data is malformed.
    payload = F.coalesce(J.get(F.col("_j"), "$.raw_data"), F.col("_j"))
    df = df.withColumn("_p", payload)
    df = df.withColumns({f"_v_{name}": J.get(F.col("_p"), path) for name, path in FIELDS})
    bad = F.col("_j").isNull() | ~J.is_object(F.col("_j")) | ~J.is_object(F.col("_p"))
    df = df.withColumn("_bad", F.coalesce(bad, F.lit(True)))
    # Event time: payload timestamp, else envelope ingested_at, else the record
    # time of the message, else processing time.
    if opts.time_mode == "processing":
        ts = F.current_timestamp()
    else:
        candidates = [
            J.iso_to_ts(J.get(F.col("_p"), "$.timestamp", "string")),
            J.iso_to_ts(J.get(F.col("_j"), "$.ingested_at", "string")),
        ]
        if ts_col:
            candidates.append(F.col(ts_col).cast("timestamp"))
        ts = F.coalesce(*candidates, F.current_timestamp())
    u = J.get(F.col("_p"), "$.user_id")
    user = F.when(u.isNull(), F.lit("unknown")).when(F.is_variant_null(u), F.lit(None)).otherwise(J.as_string(u))
    return df.withColumns({"_ts": ts, "_user": user})


def _ok(v: Column) -> Column:
    """Acceptable field: absent, or a number/boolean strictly above zero."""
    return J.is_absent(v) | (J.is_number(v) & (J.as_double(v) > 0))


def _present_ok(v: Column) -> Column:
    return ~J.is_absent(v) & J.is_number(v) & (J.as_double(v) > 0)


def parse_health(
    df: DataFrame,
    opts: Options = DEFAULT,
    value_col: str = "value",
    ts_col: str | None = "timestamp",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Parse JSON health messages into readings under ``opts.validity``.

    ``keep`` lists input columns carried through (e.g. ``event_id``).
    Output: ``keep`` + ``ts, user_id, heart_rate, bp_systolic, bp_diastolic,
    blood_sugar`` (+ ``valid`` in record mode).
    """
    if ts_col is not None and ts_col not in df.columns:
        ts_col = None
    x = _extract(df, value_col, ts_col, opts)
    if opts.validity == "metric":
        out = [F.col(c) for c in keep] + [F.col("_ts").alias("ts"), F.col("_user").alias("user_id")]
        for name in METRIC_COLS:
            v = F.col(f"_v_{name}")
            out.append(F.when(_present_ok(v), J.as_double(v)).alias(name))
        # filter after the fence, so the predicate is not pushed into the parse
        return _fence(x, out + [F.col("_bad")]).filter(~F.col("_bad")).drop("_bad")

    valid = F.lit(True)
    for name in METRIC_COLS:
        valid = valid & _ok(F.col(f"_v_{name}"))
    x = x.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    # Truncate toward zero; a value too large for INT (or infinite) cannot be
    # converted and sends the message to the malformed fallback.
    trunc = {}
    overflow = F.lit(False)
    for name in METRIC_COLS:
        d = J.as_double(F.col(f"_v_{name}"))
        use = F.col("_valid") & ~J.is_absent(F.col(f"_v_{name}"))
        trunc[f"_t_{name}"] = F.when(use, F.when(d < _INT_MAX + 1.0, d.cast("long")))
        overflow = overflow | (use & ~(d < _INT_MAX + 1.0))
    x = x.withColumns(trunc).withColumn("_bad", F.col("_bad") | overflow)
    bad = F.col("_bad")
    out = [F.col(c) for c in keep]
    ts_fallback = F.col(ts_col).cast("timestamp") if ts_col else F.current_timestamp()
    if opts.time_mode == "processing":
        ts_fallback = F.current_timestamp()
    out.append(F.when(bad, F.coalesce(ts_fallback, F.current_timestamp())).otherwise(F.col("_ts")).alias("ts"))
    out.append(F.when(bad, F.lit("unknown")).otherwise(F.col("_user")).alias("user_id"))
    for name in METRIC_COLS:
        t = F.col(f"_t_{name}")
        # 0 after truncation stays 0 (e.g. 0.5); later removed by "> 0".
        out.append(F.when(bad, F.lit(-1)).otherwise(F.coalesce(t, F.lit(-1))).cast("int").alias(name))
    out.append(F.when(bad | ~F.col("_valid"), F.lit(0)).otherwise(F.lit(1)).alias("valid"))
    return _fence(x, out)


def _fence(x: DataFrame, out: list[Column]) -> DataFrame:
    """Project the parsed columns behind a fence (see ``functions.fence``):
    a later filter such as ``heart_rate > 0`` would otherwise be pushed into
    the parse and copy the JSON parse into the predicate many times over."""
    return fence(x, out)
