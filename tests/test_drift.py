"""Histograms that add up and the stability index against numpy, with missing values."""

import datetime as dt

import numpy as np
import pytest

from pulsegrid.operators import drift as D

T0 = dt.datetime(2024, 1, 1)


def psi(a, b):
    bins = set(a) | set(b)
    p, q = ({k: (x.count(k) + 0.5) / (len(x) + 0.5 * len(bins)) for k in bins} for x in (a, b))
    return round(sum((p[k] - q[k]) * np.log(p[k] / q[k]) for k in bins), 6), len(bins)


@pytest.mark.parametrize("shift", [0.0, 8.0])
def test_drift_equals_numpy(spark, shift):
    rng = np.random.default_rng(1)
    rows = [(T0 + dt.timedelta(hours=h), float(80 + rng.normal(0, 12) + (shift if h >= 240 else 0))) for h in range(480) for _ in range(3)]
    rows += [(T0, None), (T0 + dt.timedelta(days=12), float("nan")), (T0 + dt.timedelta(days=13), float("inf")), (None, 80.0)]
    df = spark.createDataFrame(rows, "ts timestamp, heart_rate double").repartition(5)
    daily = D.daily_histograms(D.metric_rows(df, "wearable", "ts", ("heart_rate",)))
    (got,) = D.drift(daily, ("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21")).collect()
    cut = T0 + dt.timedelta(days=10)
    bins = lambda some: [int(x // 10) if x is not None and np.isfinite(x) else None for x in some]
    a, b = (bins([x for t, x in rows if t is not None and (t < cut) == side]) for side in (True, False))
    want, n = psi(a, b)
    assert (got.device_type, got.metric, got.n_before, got.n_after, got.bins) == ("wearable", "heart_rate", len(a), len(b), n)
    assert abs(got.psi - want) < 2e-6 and (got.psi < 0.1) == (shift == 0.0)
    assert D.drift(daily.limit(0), ("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21")).count() == 0
