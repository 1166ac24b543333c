"""The anchored stream's state works on many keys a call, and folds them as one by
one; an append evaluates its batch once."""

import random

import pandas as pd
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators.anchored import MINUTE_US
from pulsegrid.sinks import tables as TB
from pulsegrid.streaming import anchored_state as ST

LENGTHS = {"heart_rate": 3 * MINUTE_US, "blood_sugar": 7 * MINUTE_US}


class Held:
    """State and timers of one grouping key; counts the calls."""

    def __init__(self):
        self.rows, self.timers, self.calls = {}, set(), 0

    def getMapState(self, *_):
        return self

    def containsKey(self, name):
        self.calls += 1
        return name in self.rows

    def getValue(self, name):
        self.calls += 1
        return self.rows[name]

    def updateValue(self, name, value):
        self.calls += 1
        self.rows[name] = value

    def removeKey(self, name):
        self.calls += 1
        del self.rows[name]

    def iterator(self):
        self.calls += 1
        return iter(list(self.rows.items()))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class Mark:
    def __init__(self, us):
        self.us = us

    def getCurrentWatermarkInMs(self):
        return self.us // 1000


def windows(readings, mark):
    """Closed windows of {(user, metric, minute): value}, one key at a time."""
    out = []
    for user, metric in {k[:2] for k in readings}:
        at = sorted(k[2] for k in readings if k[:2] == (user, metric))
        while at and at[0] + LENGTHS[metric] <= mark:
            own = [x for x in at if x < at[0] + LENGTHS[metric]]
            values = [readings[user, metric, x] for x in own]
            out.append((user, metric, own[0], sum(values), min(values), max(values)))
            at = at[len(own) :]
    return sorted(out)


def frame(readings):
    rows = [dict(zip(ST.KEYS, k)) | {c: float(v) if c in ("f1", "f2", "mn", "mx") else v for c in ST.HOW} for k, v in readings.items()]
    return pd.DataFrame(rows)


def test_many_keys_in_one_call():
    random.seed(3)
    made = {(f"u{random.randint(0, 300)}", random.choice(list(LENGTHS)), random.randint(-30, 3000) * MINUTE_US): random.randint(1, 9) for _ in range(5000)}
    held, got = Held(), []
    processor = ST.AnchoredWindows(LENGTHS)
    processor.init(held)
    cuts = [1000 * MINUTE_US, 2500 * MINUTE_US, 9000 * MINUTE_US]
    for low, mark in zip([-(10**15), *cuts], cuts):
        part = {k: v for k, v in made.items() if low <= k[2] < mark}
        if part:
            list(processor.handleInputRows((7,), iter([frame(part)]), Mark(low)))
        assert held.timers and min(held.timers) * 1000 <= mark
        for out in processor.handleExpiredTimer((7,), Mark(mark), None):
            got += out[["user_id", "metric", "window_start_us", "s1a", "mn", "mx"]].itertuples(index=False, name=None)
    assert sorted(got) == windows(made, cuts[-1]) and len(got) > 1000
    assert held.rows == {}
    assert held.calls < 60, held.calls  # not some per user


def test_append_evaluates_its_batch_once(spark, scratch):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(len(b))
            yield b

    rows = spark.range(0, 20, 1, 2).mapInPandas(count, "id long")
    day = F.timestamp_seconds(F.col("id") * 86400)
    batch = rows.select(*[
        (day if f.dataType.typeName() == "timestamp" else F.col("id")).cast(f.dataType).alias(f.name) for f in S.METRIC.fields
    ])
    for _ in range(2):
        TB.append_if_absent(spark, batch, scratch, TB.METRICS_1MIN, assume_unique=True)
    assert TB.read_table(spark, scratch, TB.METRICS_1MIN).count() == 20
    assert runs.value == 40
