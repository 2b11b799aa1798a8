"""Drift correction: defaults, zero/NULL times, ties, as-of vs latest, spans."""

import datetime as dt

from pyspark.sql import functions as F

from fleetlake.functions.rules import WIRE_DEVICE_ID
from fleetlake.operators import drift

HB = "device_id string, session_id string, server_ts_ms long, estimated_drift_ms long"
EV = "event_id string, device_id string, event_ts_edge_ms long"


def _ms(r, col="event_ts_corrected"):
    v = r[col]
    return None if v is None else int(v.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_latest_default_and_zero(spark):
    hb = spark.createDataFrame([("r1", "s", 100, 40), ("r1", "s", 200, 70), ("r2", "s", 5, None)], HB)
    ev = spark.createDataFrame(
        [("a", "r1", 10_000), ("b", "r2", 10_000), ("c", "r3", 10_000), ("d", "r1", 0), ("e", "r1", None)], EV
    )
    out = {r["event_id"]: r for r in drift.correct_drift(ev, hb).collect()}
    assert _ms(out["a"]) == 10_000 - 70
    assert out["a"]["drift_source"] == "HEARTBEAT"
    assert _ms(out["b"]) == 10_000 and out["b"]["drift_ms"] == 0  # missing drift -> 0
    assert _ms(out["c"]) == 10_000 and out["c"]["drift_source"] == "DEFAULT"
    assert out["d"]["event_ts_corrected"] is None  # edge time 0 -> NULL
    assert out["e"]["event_ts_corrected"] is None


def test_latest_tie_breaks_by_session_then_value(spark):
    hb = spark.createDataFrame([("r1", "s-1", 100, 5), ("r1", "s-2", 100, 3), ("r1", "s-2", 100, 9)], HB)
    (row,) = drift.latest_drift(hb).collect()
    assert row["drift_ms"] == 9


def test_asof_uses_heartbeat_valid_at_event_time(spark):
    hb = spark.createDataFrame([("r1", "s", 1_000, 10), ("r1", "s", 5_000, 50), ("r1", "s", 9_000, 90)], HB)
    ev = spark.createDataFrame(
        [("before", "r1", 500), ("at", "r1", 5_000), ("mid", "r1", 6_000), ("late", "r1", 20_000)], EV
    )
    out = {r["event_id"]: r["drift_ms"] for r in drift.asof_drift(ev, hb).collect()}
    assert out == {"before": None, "at": 50, "mid": 50, "late": 90}
    latest = {r["event_id"]: r["drift_ms"] for r in drift.correct_drift(ev, hb).collect()}
    assert set(latest.values()) == {90}


def test_asof_carries_across_spans(spark):
    # span of 1 s: heartbeats only in span 0 and 3; events in spans 1, 2, 5 use the carry-in
    hb = spark.createDataFrame([("r1", "s", 100, 1), ("r1", "s", 3_500, 3)], HB)
    ev = spark.createDataFrame(
        [("s1", "r1", 1_200), ("s2", "r1", 2_999), ("s3", "r1", 3_400), ("s3b", "r1", 3_600), ("s5", "r1", 5_000)],
        EV,
    )
    out = {r["event_id"]: r["drift_ms"] for r in drift.asof_drift(ev, hb, span_ms=1_000).collect()}
    assert out == {"s1": 1, "s2": 1, "s3": 1, "s3b": 3, "s5": 3}


def test_asof_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    hbs = [(f"r{rnd.randint(1, 4)}", f"s{rnd.randint(1, 2)}", rnd.randint(0, 50_000), rnd.randint(-500, 500))
           for _ in range(60)]
    evs = [(f"e{i}", f"r{rnd.randint(1, 5)}", rnd.choice([None, rnd.randint(0, 60_000)])) for i in range(300)]
    hb = spark.createDataFrame(hbs, HB)
    ev = spark.createDataFrame(evs, EV)
    got = {r["event_id"]: r["drift_ms"] for r in drift.asof_drift(ev, hb, span_ms=7_000).collect()}
    for eid, rid, ts in evs:
        cands = [h for h in hbs if h[0] == rid and ts is not None and h[2] <= ts]
        want = max(cands, key=lambda h: (h[2], h[1], h[3]))[3] if cands else None
        assert got[eid] == want, eid


def test_drift_applied_seconds(spark):
    df = spark.createDataFrame([(1_700_000_000_300, dt.datetime(2023, 11, 14, 22, 13, 20))],
                               "event_ts_edge_ms long, event_ts_corrected timestamp")
    (r,) = df.select(drift.drift_applied_sec().alias("d")).collect()
    assert abs(r["d"] - 0.3) < 1e-6


def test_no_python_udf_in_plan(spark):
    hb = spark.createDataFrame([("r1", "s", 1, 1)], HB)
    ev = spark.createDataFrame([("a", "r1", 10)], EV)
    plan = drift.correct_drift_asof(ev, hb)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    plan = drift.correct_drift(ev, hb)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_heartbeat_source_missing_drift_is_zero(spark):
    import json

    from fleetlake.sources.topics import heartbeat_source

    msgs = [json.dumps({WIRE_DEVICE_ID: "r1", "session_id": "s", "server_ts_ms": 5}),
            json.dumps({WIRE_DEVICE_ID: "r2", "session_id": "s", "server_ts_ms": 5, "estimated_drift_ms": -12})]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    got = {r["device_id"]: r["estimated_drift_ms"] for r in heartbeat_source(df).collect()}
    assert got == {"r1": 0, "r2": -12}
