"""Parsing and window cases taken from the source system's unit tests and
its parsing rules (record vs per-metric validity)."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import alerts as A
from pulsegrid.operators import windows as W
from pulsegrid.operators.parse import parse_health
from pulsegrid.options import DEFAULT

T0 = "2024-03-01T10:30:45+00:00"


def msg(payload, raw=False):
    return payload if raw else json.dumps(payload)


def wearable(hr=72, sys_=120, dia=80, sugar=95, user="user_1", ts=T0, **extra):
    d = {
        "device_id": "wearable_1",
        "user_id": user,
        "heart_rate": {"value": hr, "unit": "bpm"},
        "blood_pressure": {"systolic": sys_, "diastolic": dia, "unit": "mmHg"},
        "blood_sugar": {"value": sugar, "unit": "mg/dL"},
        "timestamp": ts,
    }
    d.update(extra)
    return d


def parse(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "event_id long, value string")
    opts = DEFAULT.with_(**kw) if kw else DEFAULT
    return [r.asDict() for r in parse_health(df, opts, ts_col=None, keep=("event_id",)).orderBy("event_id").collect()]


def row(r):
    return (r["user_id"], r["heart_rate"], r["bp_systolic"], r["bp_diastolic"], r["blood_sugar"], r["valid"])


def test_normal_and_envelope(spark):
    env = {"kafka_topic": "virtual-wearables", "kafka_partition": 0, "kafka_offset": 12345,
           "ingestion_protocol": "kafka", "ingested_at": T0, "raw_data": wearable()}
    rs = parse(spark, [msg(wearable()), msg(env)])
    assert row(rs[0]) == ("user_1", 72, 120, 80, 95, 1)
    assert row(rs[1]) == ("user_1", 72, 120, 80, 95, 1)


def test_null_containers_valid_all_absent(spark):
    d = wearable()
    d["heart_rate"] = d["blood_pressure"] = d["blood_sugar"] = None
    assert row(parse(spark, [msg(d)])[0]) == ("user_1", -1, -1, -1, -1, 1)


def test_negative_values_invalidate_record(spark):
    assert row(parse(spark, [msg(wearable(-50, -120, -80, -100))])[0]) == ("user_1", -1, -1, -1, -1, 0)


def test_one_bad_field_invalidates_all_in_record_mode(spark):
    r = parse(spark, [msg(wearable(hr=-5)), msg(wearable(hr="72"))])
    assert [row(x) for x in r] == [("user_1", -1, -1, -1, -1, 0)] * 2


def test_metric_mode_drops_only_the_bad_field(spark):
    r = parse(spark, [msg(wearable(hr=-5)), msg(wearable(hr="72")), msg(wearable(hr=72.9))], validity="metric")
    assert [x["heart_rate"] for x in r] == [None, None, 72.9]
    assert all(x["bp_systolic"] == 120.0 for x in r)


def test_wrong_containers_are_absent_not_invalid(spark):
    d = wearable()
    d["blood_pressure"] = "not_a_number"
    d["blood_sugar"] = {"invalid": True}
    d["heart_rate"] = [1, 2, 3]
    assert row(parse(spark, [msg(d)])[0]) == ("user_1", -1, -1, -1, -1, 1)


def test_truncation_boolean_and_defaults(spark):
    d = wearable(hr=72.9)
    b = wearable(hr=True)
    f = wearable(hr=False)
    nouser = wearable()
    del nouser["user_id"]
    r = parse(spark, [msg(d), msg(b), msg(f), msg(nouser)])
    assert r[0]["heart_rate"] == 72 and r[0]["valid"] == 1
    assert r[1]["heart_rate"] == 1 and r[1]["valid"] == 1
    assert r[2]["valid"] == 0  # false is not > 0
    assert r[3]["user_id"] == "unknown"


def test_malformed_and_null_envelope(spark):
    r = parse(spark, ['{"user_id": "u", "heart_rate": ', "[1,2]", '{"raw_data": null}', '{"heart_rate": {"value": 1e400}}'])
    for x in r:
        assert row(x)[0] == "unknown" and row(x)[5] == 0 and row(x)[1] == -1
    assert parse(spark, ['{"user_id": "u", "heart_rate": '], validity="metric") == []


def test_explicit_null_user_is_null_key(spark):
    assert parse(spark, [msg(wearable(user=None))])[0]["user_id"] is None


def _windows(spark, hrs=(), bps=(), sugars=(), opts=DEFAULT):
    msgs = []
    n = max(len(hrs), len(bps), len(sugars))
    for i in range(n):
        ts = f"2024-03-01T10:3{i % 10}:00+00:00"
        hr = hrs[i] if i < len(hrs) else None
        s, d = bps[i] if i < len(bps) else (None, None)
        su = sugars[i] if i < len(sugars) else None
        p = {"user_id": "u", "timestamp": ts}
        if hr is not None:
            p["heart_rate"] = {"value": hr}
        if s is not None:
            p["blood_pressure"] = {"systolic": s, "diastolic": d}
        if su is not None:
            p["blood_sugar"] = {"value": su}
        msgs.append(json.dumps(p))
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    r = parse_health(df, opts, ts_col=None)
    wide = opts.with_(hr_window_minutes=60, bp_window_minutes=60, sugar_window_minutes=60)
    return W.all_windows(r, wide), wide


@pytest.mark.parametrize(
    "values,avg,severity",
    [
        ([75, 80, 78, 82, 77], 78.4, None),
        ([105, 110, 108, 112, 106], 108.2, "warning"),
        ([125, 130, 128, 135, 132], 130.0, "critical"),
        ([100], 100.0, None),
        ([120], 120.0, "critical"),
    ],
)
def test_heart_rate_window(spark, values, avg, severity):
    res, _ = _windows(spark, hrs=values)
    (r,) = res["hr"].collect()
    assert r.avg_heart_rate == avg and r.reading_count == len(values)
    assert r.min_heart_rate == min(values) and r.max_heart_rate == max(values)
    assert (r.alert.severity if r.alert else None) == severity


@pytest.mark.parametrize(
    "sys_,dia,severity",
    [
        ([120, 118, 122, 119, 121], [80, 78, 82, 79, 81], None),
        ([145, 148, 142, 150, 146], [80, 78, 82, 79, 81], "warning"),
        ([120, 118, 122, 119, 121], [92, 95, 91, 94, 93], "warning"),
        ([140], [80], "warning"),
        ([120], [90], "warning"),
    ],
)
def test_blood_pressure_window(spark, sys_, dia, severity):
    res, opts = _windows(spark, bps=list(zip(sys_, dia)))
    (r,) = res["bp"].collect()
    assert (r.alert.severity if r.alert else None) == severity
    rows = A.bp_alert_rows(res["bp"], opts).collect()
    if severity:
        assert rows[0].threshold_value == 0.0 and rows[0].metric_value == r.avg_bp_systolic
        st = A.bp_alert_rows(res["bp"], opts.with_(bp_threshold_mode="standalone")).collect()
        assert st[0].threshold_value == 140.0


def test_blood_pressure_metric_row_layout(spark):
    res, _ = _windows(spark, bps=[(150, 95), (130, 85)])
    (m,) = A.bp_metric_rows(res["bp"]).collect()
    assert (m.avg_value, m.min_value, m.max_value) == (140.0, 90.0, 140.0)


@pytest.mark.parametrize(
    "values,severity",
    [([95, 100, 98, 105, 92], None), ([185, 190, 182, 195, 188], "warning"), ([260, 270, 255, 280, 265], "critical")],
)
def test_sugar_window(spark, values, severity):
    res, _ = _windows(spark, sugars=values)
    (r,) = res["sugar"].collect()
    assert (r.alert.severity if r.alert else None) == severity


def test_window_alignment(spark):
    df = spark.createDataFrame([(json.dumps(wearable()),)], "value string")
    r = parse_health(df, DEFAULT, ts_col=None)
    (w,) = W.heart_rate_windows(r, DEFAULT).collect()
    assert w.window_start.replace(tzinfo=None) == datetime(2024, 3, 1, 10, 30)
    assert w.window_end.replace(tzinfo=None) == datetime(2024, 3, 1, 10, 31)


def test_half_even_rounding_on_binary_value(spark):
    df = spark.createDataFrame([(0.125,), (75.475,), (2.675,)], "x double")
    got = [r[0] for r in df.select(W._r2(F.col("x"))).collect()]
    assert got == [round(0.125, 2), round(75.475, 2), round(2.675, 2)]
