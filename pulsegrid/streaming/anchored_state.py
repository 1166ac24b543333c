"""First-reading-anchored windows on a stream.

Each task first reduces its readings to partials per (user, metric, minute), so
a hot user is a few rows per batch and task when the rows are grouped.
The rows are grouped by slot, a hash of user and metric, so that a call of the
processor does the work of many keys at once: per key it would cost several
round trips between Python and the JVM. ``transformWithState`` keeps a slot's
open minutes, an Arrow table per day of theirs in a map, until the watermark passes
the end of the window they open: an event-time timer folds them then, all keys of
the slot together, and drops them. Readings may come in any order within the watermark.
State per (user, metric) is one partial per minute of the watermark delay and a
window's length, never the readings themselves, and a slot whose windows are all
closed has no state and no timer left: what could still fall into an emitted
window is behind the watermark, and Spark drops it before it gets here. A batch
writes the days it touches and not a slot's whole history; ``SLOTS`` is to grow
with the users (a call holds a slot's open minutes), and is fixed for a checkpoint.
Exact sums travel as three integers (``PARTS``), which numpy adds; they are
DECIMAL(38, 9) again in what is emitted. The state is in RocksDB
(``session.RUNTIME_CONF``).
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.anchored import MINUTE_US, PARTIAL_SCHEMA, lengths_us, unpivot
from ..operators.windows import NEAR
from ..options import DEFAULT, Options

SLOTS = 2048
BASE = 1_000_000_000
PARTS = ("a", "b", "c")  # a sum is a * 10^9 + b + c / 10^9; each part's own sum holds 9 * 10^9 readings
SUMS = {"n": "long", **{f"s1{x}": "long" for x in PARTS}, "f1": "double", **{f"s2{x}": "long" for x in PARTS}, "f2": "double"}
HOW = {**dict.fromkeys(SUMS, "sum"), "mn": "min", "mx": "max"}
KEYS = ["user_id", "metric", "minute_us"]
PARTIAL = ", ".join(f"{c} {t}" for c, t in {**SUMS, "mn": "double", "mx": "double"}.items())
PANE_US = 1440 * MINUTE_US
HELD = pa.schema([("user_id", pa.string()), ("metric", pa.string()), ("minute_us", pa.int64()), *((c, pa.int64() if SUMS.get(c) == "long" else pa.float64()) for c in HOW)])
MINUTES = f"slot int, user_id string, metric string, minute_us long, {PARTIAL}"
CLOSED = f"user_id string, metric string, window_start_us long, window_end_us long, {PARTIAL}"


def _merged(rows: pa.Table, keys: list[str]) -> pa.Table:
    """One row per key: sums, least and largest value."""
    got = rows.group_by(keys, use_threads=False).aggregate(list(HOW.items()))
    return pa.table([got[k] for k in keys] + [got[f"{c}_{f}"] for c, f in HOW.items()], names=keys + list(HOW))


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task to one partial per (user, metric, minute) and batch."""
    for batch in batches:
        yield from _merged(pa.table(batch), ["slot", *KEYS]).to_batches()


def _packed(minutes: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, minutes.schema) as writer:
        writer.write_table(minutes.combine_chunks())
    return out.getvalue().to_pybytes()


def _unpacked(data) -> pa.Table:
    return pa.ipc.open_stream(bytes(data)).read_all()


def _by_pane(minutes: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    """The minutes of each pane of time."""
    pane = minutes["minute_us"].to_numpy() // PANE_US
    order = np.argsort(pane, kind="stable")
    at, first = np.unique(pane[order], return_index=True)
    for name, rows in zip(at.tolist(), np.split(order, first[1:])):
        yield name, minutes.take(pa.array(rows))


def fold_closed(minutes: pa.Table, lengths: dict[str, int], mark: int) -> tuple[pd.DataFrame, pa.Table, int | None]:
    """Windows that end by ``mark`` of all keys, the minutes left open, and when
    the next window ends. A key's first minute opens a window, and its first
    minute from that window's end on the next."""
    minutes = minutes.sort_by([(k, "ascending") for k in KEYS])
    minute = minutes["minute_us"].to_numpy()
    user, metric = (minutes[k].combine_chunks().dictionary_encode() for k in KEYS[:2])
    names = metric.dictionary.to_pylist()
    length = np.array([lengths[m] for m in names], np.int64)[metric.indices.to_numpy()]
    key = user.indices.to_numpy().astype(np.int64) * len(names) + metric.indices.to_numpy()
    opens = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    ends = np.append(opens[1:], len(key))
    at, until, starts, stops = opens, ends, [], []
    next_end = None
    while len(at):
        end = minute[at] + length[at]
        due = end <= mark
        if not due.all():
            least = int(end[~due].min())
            next_end = least if next_end is None else min(next_end, least)
        at, until, end = at[due], until[due], end[due]
        low, high = at + 1, until.copy()  # the first minute at or after the end, by bisection
        while (low < high).any():
            mid = (low + high) // 2
            before = (low < high) & (minute[np.minimum(mid, len(minute) - 1)] < end)
            low, high = np.where(before, mid + 1, low), np.where(before | (low >= high), high, mid)
        starts.append(at)
        stops.append(low)
        more = low < until
        at, until = low[more], until[more]
    first, stop = (np.concatenate(x).astype(np.int64) for x in (starts, stops))
    keep = np.zeros(len(minute) + 1, np.int64)
    np.add.at(keep, first, 1)
    np.add.at(keep, stop, -1)
    left = minutes.filter(pa.array(np.cumsum(keep)[:-1] == 0))
    bounds = np.column_stack((first, stop)).ravel()
    adds = {"sum": np.add, "min": np.minimum, "max": np.maximum}
    heads = minutes.select(KEYS).take(pa.array(first))
    out = {"user_id": heads["user_id"].to_pylist(), "metric": heads["metric"].to_pylist(), "window_start_us": minute[first], "window_end_us": minute[first] + length[first]}
    for c, how in HOW.items():
        column = minutes[c].to_numpy()
        out[c] = adds[how].reduceat(np.append(column, column[:1]), bounds)[::2] if len(bounds) else column[:0]
    return pd.DataFrame(out), left, next_end


class AnchoredWindows(StatefulProcessor):
    """Minutes of a slot's (user, metric) keys to their closed anchored windows."""

    def __init__(self, lengths_us: dict[str, int]):
        self.lengths_us = lengths_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.minutes = handle.getMapState("minutes", "pane long", "minutes binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [pa.Table.from_pandas(pdf[[*KEYS, *HOW]], schema=HELD, preserve_index=False) for pdf in rows if len(pdf)]
        if new:
            whole = pa.concat_tables(new)
            parts = list(_by_pane(whole))
            if len(parts) == 1:
                name = (parts[0][0],)
                held = {name[0]: self.minutes.getValue(name)[0]} if self.minutes.containsKey(name) else {}
            else:  # one round trip for all of them
                held = {name[0]: value[0] for name, value in self.minutes.iterator()}
            for pane, part in parts:
                both = [_unpacked(held[pane]), part] if pane in held else [part]
                self.minutes.updateValue((pane,), (_packed(_merged(pa.concat_tables(both), KEYS)),))
            first = whole.group_by("metric", use_threads=False).aggregate([("minute_us", "min")]).to_pylist()
            self.handle.registerTimer(min(r["minute_us_min"] + self.lengths_us[r["metric"]] for r in first) // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = {name[0]: _unpacked(value[0]) for name, value in self.minutes.iterator()}
        if not held:
            return
        out, left, next_end = fold_closed(pa.concat_tables(held.values()), self.lengths_us, timerValues.getCurrentWatermarkInMs() * 1000)
        if not len(out):  # a timer that folds nothing leaves the next one to its own
            return
        still = dict(_by_pane(left))
        for pane, before in held.items():  # only panes that lost minutes are written
            if pane not in still:
                self.minutes.removeKey((pane,))
            elif len(still[pane]) < len(before):
                self.minutes.updateValue((pane,), (_packed(still[pane]),))
        if next_end is not None:
            self.handle.registerTimer(next_end // 1000)
        yield out

    def close(self) -> None:
        pass


def _split(name: str, value: Column) -> list[Column]:
    """A DECIMAL(28, 9) of at least 0 as its three parts."""
    whole = F.floor(value).cast("long")
    rest = ((value - whole.cast("decimal(19,0)")) * F.lit(BASE)).cast("long")
    return [c.alias(f"{name}{x}") for x, c in zip(PARTS, (F.floor(whole / F.lit(BASE)), whole % F.lit(BASE), rest))]


def _joined(name: str) -> Column:
    """The three parts' sums as one DECIMAL(38, 9)."""
    a, b, c = (F.col(f"{name}{x}").cast("decimal(19,0)") for x in PARTS)
    whole = (a * F.lit(BASE).cast("decimal(10,0)") + b).cast("decimal(28,0)")
    return (whole + (c * F.lit("0.000000001").cast("decimal(9,9)")).cast("decimal(28,9)")).cast("decimal(38,9)")


def anchored_stream(readings: DataFrame, opts: Options = DEFAULT) -> DataFrame:
    """Readings (metric validity, no watermark yet) → closed anchored windows
    (``PARTIAL_SCHEMA`` rows), emitted in append mode. The watermark is on the
    reduced rows' minutes, ``opts.watermark_delay`` behind the newest."""
    near = lambda c: F.coalesce(F.when(F.abs(c) < NEAR, F.col(c)).cast("decimal(28,9)"), F.lit(0)).cast("decimal(28,9)")
    far = lambda c: F.coalesce(F.when(F.abs(c) >= NEAR, F.col(c)), F.lit(0.0))
    us = F.unix_micros("ts")
    rows = unpivot(readings).select(
        F.pmod(F.xxhash64("user_id", "metric"), F.lit(SLOTS)).cast("int").alias("slot"),
        "user_id", "metric", (us - F.pmod(us, F.lit(MINUTE_US))).alias("minute_us"), F.lit(1).cast("long").alias("n"),
        near("v1").alias("s1"), far("v1").alias("f1"), near("v2").alias("s2"), far("v2").alias("f2"), F.col("v1").alias("mn"), F.col("v1").alias("mx"),
    )
    rows = rows.select("slot", *KEYS, "n", *_split("s1", F.col("s1")), "f1", *_split("s2", F.col("s2")), "f2", "mn", "mx")
    minutes = rows.mapInArrow(_reduce, MINUTES).withColumn("minute", F.timestamp_micros("minute_us")).withWatermark("minute", opts.watermark_delay)
    closed = minutes.groupBy("slot").transformWithStateInPandas(
        AnchoredWindows(lengths_us(opts)), outputStructType=CLOSED, outputMode="append", timeMode="eventTime"
    )
    return closed.select(*[_joined(f.name).alias(f.name) if f.name in ("s1", "s2") else F.col(f.name) for f in PARTIAL_SCHEMA.fields])
