"""As-of drift from bucketed points: equal to the batch operator, reads bounded by the batch's spans."""

import os
import random

from pyspark.sql import functions as F

from fleetlake.operators import drift
from fleetlake.streaming.drift_state import POINTS, DriftState

HB = "device_id string, session_id string, server_ts_ms long, estimated_drift_ms long"
EV = "id int, device_id string, event_ts_edge_ms long"


def test_asof_from_points_equals_batch_with_late_heartbeats(spark, tmp_dir):
    rng = random.Random(4)
    state = DriftState(os.path.join(tmp_dir, "d"), slots=3, span_ms=100)
    devices = [f"device-{i}" for i in range(5)]
    ev = [(i, rng.choice([*devices, "unknown", None]), None if rng.random() < 0.05 else rng.randint(-300, 1500)) for i in range(300)]
    events = spark.createDataFrame(ev, EV)
    assert state.asof_drift(events).filter("drift_ms is not null").count() == 0
    hb = []
    for k in range(4):
        low = 250 * k
        batch = [(rng.choice([*devices, None]), rng.choice(["a", "b", None]), rng.randint(low, low + 250), rng.choice([1, 2, 3, None])) for _ in range(25)]
        batch += [(rng.choice(devices), "late", rng.randint(-200, low + 1), 9) for _ in range(4)] + batch[:3]
        hb += batch
        frame = spark.createDataFrame(batch, HB)
        assert state.apply(spark, frame, k) == k
        if k == 2:
            assert state.apply(spark, frame, k) == k  # a batch that is run again
        got = {r.id: r.drift_ms for r in state.asof_drift(events).collect()}
        want = {r.id: r.drift_ms for r in drift.asof_drift(events, spark.createDataFrame(hb, HB)).collect()}
        assert got == want and len(got) == 300


def test_what_a_batch_reads_does_not_grow(spark, tmp_dir):
    state = DriftState(os.path.join(tmp_dir, "d"), slots=2, span_ms=1000)
    rows = [(f"device-{i}", "s", t, t % 7) for i in range(4) for t in range(0, 12_000, 100)]
    read = []
    for k in range(4):
        part = [r for r in rows if 3000 * k <= r[2] < 3000 * (k + 1)]
        state.apply(spark, spark.createDataFrame(part, HB), k)
        events = spark.createDataFrame([(i, f"device-{i}", 3000 * (k + 1) - 1) for i in range(4)], EV)
        spans = events.select(state._slot().alias("slot"), state._span(F.col("event_ts_edge_ms")).alias("span")).distinct()
        points = state.state.read(spark, "points", POINTS, k, state.buckets_of(spark, spans, k))
        read.append((points.count(), len(points.inputFiles())))
        # a batch on time rewrites its own spans, no earlier one
        at = [r.at for r in state.state.manifest(spark, "points", k).collect()]
        assert at.count(k) <= 3 * 2
    assert all(n <= 4 * 11 for n, _ in read) and max(f for _, f in read[1:]) <= 4
    assert read[1][0] == read[3][0]
