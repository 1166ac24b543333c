import json
import os


from pulsegrid.operators import alerts as A
from pulsegrid.operators.parse import parse_health
from pulsegrid.options import DEFAULT
from pulsegrid.plans.common import TABLE_OPTS
from pulsegrid.plans.health import readings
from pulsegrid.sinks import tables as TB

SF = "/root/testdata/sf0.001"


def test_route_results_counts_unknown_types(spark):
    df = spark.createDataFrame(
        [("heart_rate",), ("blood_pressure",), ("blood_sugar",), ("steps",)], "metric_type string"
    )
    r = A.route_results(df)
    assert r["1min"].count() == 2 and r["10min"].count() == 1 and r["unknown"].count() == 1


def test_processing_time_mode_stamps_arrival(spark):
    msg = json.dumps({"user_id": "u", "heart_rate": {"value": 80}, "timestamp": "2001-01-01T00:00:00+00:00"})
    df = spark.createDataFrame([(msg,)], "value string")
    (r,) = parse_health(df, DEFAULT.with_(time_mode="processing"), ts_col=None).collect()
    assert r.ts.year >= 2024
    (e,) = parse_health(df, DEFAULT, ts_col=None).collect()
    assert e.ts.year == 2001


def test_counters_one_row(spark):
    r = readings(spark, SF)
    (c,) = A.counters(r, A.alert_rows(r, TABLE_OPTS)).collect()
    assert c.messages_processed == r.count()
    assert c.alerts_generated == A.alert_rows(r, TABLE_OPTS).count()


def test_create_all_tables(spark, scratch):
    paths = TB.create_all(spark, scratch)
    assert set(paths) == set(TB.TABLE_SCHEMAS)
    for name, p in paths.items():
        assert os.path.isdir(p)
        assert TB.read_table(spark, scratch, name).count() == 0  # readable while empty
    # creating again is a no-op
    assert TB.create_all(spark, scratch) == paths


def test_raw_payload_without_raw_data_uses_root_and_explicit_null_is_malformed(spark):
    ok = json.dumps({"user_id": "u1", "heart_rate": {"value": 90}})
    env_null = json.dumps({"ingested_at": "2024-01-01T00:00:00+00:00", "raw_data": None})
    env_str = json.dumps({"raw_data": "text"})
    df = spark.createDataFrame([(0, ok), (1, env_null), (2, env_str)], "event_id long, value string")
    rows = parse_health(df, DEFAULT, ts_col=None, keep=("event_id",)).orderBy("event_id").collect()
    assert (rows[0].user_id, rows[0].heart_rate, rows[0].valid) == ("u1", 90, 1)
    assert all((r.user_id, r.valid) == ("unknown", 0) for r in rows[1:])
