"""Reports, gold models, drift and link status kept up to date batch by batch: equal to the batch operators."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.plans import gold, reports, silver
from fleetlake.schemas import BLOB_INDEX_SCHEMA, TELEMETRY_BRONZE_SCHEMA
from fleetlake.streaming import ingest
from fleetlake.streaming.gold_state import GoldState
from fleetlake.streaming.report_state import ReportState, kept_reports

T0 = dt.datetime(2024, 1, 1)


def _frame(spark, schema, rows):
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def _batches(rng, n_batches=4, size=60):
    """Telemetry and manifests that come in any order, late, repeated, without an id or media."""
    for _ in range(n_batches):
        tel, blobs = [], []
        for _ in range(size):
            device = rng.randint(1, 6)
            eid = None if rng.random() < 0.05 else f"device-{device}:s-{rng.randint(1, 4)}:{rng.randint(0, 12):012d}"
            when = T0 + dt.timedelta(minutes=rng.randint(0, 600), seconds=rng.randint(0, 59))
            tel.append({"event_id": eid, "device_id": None if rng.random() < 0.05 else f"device-{device}", "sensor_type": rng.choice(["imu", "force_torque", None]), "temperature": rng.choice([20.5, 33.25, 999.0, None, -41.0]),
                        "torque": rng.choice([1.5, 7.0, 301.0, None]), "joint_angle": rng.choice([0.5, -1.25, 9.0, None]), "event_ts_corrected": when, "ingest_ts": when + dt.timedelta(seconds=rng.randint(0, 90)), "ingest_status": rng.choice(["LINKED", "PENDING_BLOB_LINK", "ORPHANED"])})
            if rng.random() < 0.8:
                other = None if rng.random() < 0.05 else f"device-{device}:s-{rng.randint(1, 4)}:{rng.randint(0, 14):012d}"
                blobs.append({"event_id": other, "media_type": rng.choice(["audio", "camera_rgb", None]), "object_size": rng.randint(1, 1000), "ingest_ts": when})
        yield tel, blobs


def _row(df):
    (r,) = df.collect()
    return r.asDict(recursive=True)


def test_kept_reports_equal_full_reports(spark, tmp_dir):
    state = ReportState(os.path.join(tmp_dir, "s"), buckets=7)
    all_t, all_b = [], []
    now = T0 + dt.timedelta(minutes=603)
    for k, (tel, blobs) in enumerate(_batches(random.Random(2))):
        tel, blobs = tel if k != 1 else [], blobs if k != 2 else []
        all_t, all_b = all_t + tel, all_b + blobs
        state.apply(spark, _frame(spark, TELEMETRY_BRONZE_SCHEMA, tel) if tel else None, _frame(spark, BLOB_INDEX_SCHEMA, blobs) if blobs else None)
        ft, fb = _frame(spark, TELEMETRY_BRONZE_SCHEMA, all_t), _frame(spark, BLOB_INDEX_SCHEMA, all_b)
        assert _row(state.reconcile_report(spark, now)) == _row(reports.reconcile_report(ft, fb, now))
        assert _row(state.quality_report(spark, now)) == _row(reports.quality_report(ft, fb, now))


def test_kept_reports_before_the_first_batch(spark, tmp_dir):
    state = ReportState(os.path.join(tmp_dir, "s"))
    t, b = _frame(spark, TELEMETRY_BRONZE_SCHEMA, []), _frame(spark, BLOB_INDEX_SCHEMA, [])
    empty = _row(reports.reconcile_report(t, b, T0))
    assert (empty["telemetry_total"], empty["linked_count"], empty["blob_orphans"], empty["linkage_pct"], empty["status"]) == (0, 0, 0, 0.0, "DEGRADED")
    assert _row(state.reconcile_report(spark, T0)) == empty
    checks = _row(reports.quality_report(t, b, T0))["checks"]
    assert (checks["completeness_linkage"]["linked"], checks["accuracy"]["bad_temp_rows"], checks["completeness_linkage"]["severity"]) == (0, 0, "CRITICAL")
    assert _row(state.quality_report(spark, T0)) == _row(reports.quality_report(t, b, T0))
    state.apply(spark, t, b)
    assert _row(state.quality_report(spark, T0)) == _row(reports.quality_report(t, b, T0))


def test_a_batch_reads_and_writes_its_buckets_only(spark, tmp_dir):
    state = ReportState(os.path.join(tmp_dir, "s"), buckets=64)

    def session(s, n=20):
        return _frame(spark, TELEMETRY_BRONZE_SCHEMA, [{"event_id": f"device-1:s-{s}:{i:012d}", "device_id": "device-1", "ingest_ts": T0} for i in range(n)])

    for s in range(30):
        if s % 10 == 0:
            many = session(s)
            for k in range(1, 10):
                many = many.unionByName(session(s + k))
            state.apply(spark, many)
    before = state.state.newest(spark)["version"]
    state.apply(spark, session(3))
    held = {r.bucket: r.at for r in state.state.manifest(spark, "ids", before + 1).collect()}
    assert [a for a in held.values()].count(before + 1) == 1 and len(held) > 10
    (bucket,) = [b for b, a in held.items() if a == before + 1]
    touched = spark.createDataFrame([(bucket,)], "bucket long")
    files = state.state.read(spark, "ids", "event_id string", before, touched).inputFiles()
    assert files and all(f"bucket={bucket}/" in f for f in files)
    assert _row(state.reconcile_report(spark, T0))["telemetry_total"] == 620


def test_uncommitted_version_is_not_read(spark, tmp_dir, monkeypatch):
    state = ReportState(os.path.join(tmp_dir, "s"), buckets=5)
    (tel, blobs), (tel2, blobs2) = list(_batches(random.Random(5), 2, 25))
    state.apply(spark, _frame(spark, TELEMETRY_BRONZE_SCHEMA, tel), _frame(spark, BLOB_INDEX_SCHEMA, blobs))
    now = T0 + dt.timedelta(minutes=601)
    was = _row(state.reconcile_report(spark, now))
    t2, b2 = _frame(spark, TELEMETRY_BRONZE_SCHEMA, tel2), _frame(spark, BLOB_INDEX_SCHEMA, blobs2)
    with monkeypatch.context() as m:
        m.setattr(state.state, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            state.apply(spark, t2, b2)
    assert _row(state.reconcile_report(spark, now)) == was
    state.apply(spark, t2, b2)
    full = reports.reconcile_report(_frame(spark, TELEMETRY_BRONZE_SCHEMA, tel + tel2), _frame(spark, BLOB_INDEX_SCHEMA, blobs + blobs2), now)
    assert _row(state.reconcile_report(spark, now)) == _row(full)


def _close(got, want, keys):
    got, want = ({tuple(r[k] for k in keys): r.asDict() for r in x.collect()} for x in (got, want))
    assert got.keys() == want.keys()
    for k, w in want.items():
        for c, v in w.items():
            assert got[k][c] == (pytest.approx(v, rel=1e-12) if isinstance(v, float) else v), (k, c)


def test_kept_gold_models_take_late_rows(spark, tmp_dir):
    state = GoldState(os.path.join(tmp_dir, "g"))
    all_t, all_b = [], []
    for k, (tel, blobs) in enumerate(_batches(random.Random(9), 3)):
        all_t, all_b = all_t + tel, all_b + blobs
        state.apply(spark, _frame(spark, TELEMETRY_BRONZE_SCHEMA, tel), _frame(spark, BLOB_INDEX_SCHEMA, blobs))
        if k == 0:
            continue
        ft, fb = _frame(spark, TELEMETRY_BRONZE_SCHEMA, all_t), _frame(spark, BLOB_INDEX_SCHEMA, all_b)
        _close(state.device_hourly_stats(spark), gold.device_hourly_stats(silver.telemetry_validated(ft)), ("device_id", "hour_bucket", "sensor_type"))
        _close(state.linkage_report(spark), gold.linkage_report(ft, fb), ("hour_bucket",))
    # one late row rewrites one hour
    version = state.state.newest(spark)["version"] + 1
    late = {"event_id": "x", "device_id": "device-1", "sensor_type": "imu", "temperature": 1.0, "torque": 1.0, "event_ts_corrected": T0, "ingest_ts": T0 + dt.timedelta(hours=9)}
    state.apply(spark, _frame(spark, TELEMETRY_BRONZE_SCHEMA, [late]))
    at = [r.at for r in state.state.manifest(spark, "stats", version).collect()]
    assert at.count(version) == 1 and len(at) > 5


def test_refresh_applies_each_commit_once(spark, tmp_dir):
    from test_streaming import _man, _tel, _write_lines

    src_t, src_m = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "m")
    paths = ingest.IngestPaths(os.path.join(tmp_dir, "lake"))
    state, hourly = ReportState(os.path.join(tmp_dir, "s"), buckets=16), GoldState(os.path.join(tmp_dir, "g"))
    assert state.refresh(spark, paths) is None
    for k in range(2):
        _write_lines(src_t, f"t{k}.json", [_tel(i) for i in range(5 * k, 5 * k + 7)])
        _write_lines(src_m, f"m{k}.json", [_man(i) for i in range(3 * k, 3 * k + 3)])
        for kind, src in (("telemetry_events", src_t), ("blob_index", src_m)):
            ingest.start_table_stream(spark, kind, paths, src, trigger={"availableNow": True}, drift_mode=None).awaitTermination()
        version = state.refresh(spark, paths)
        assert state.refresh(spark, paths) == version == k
        hourly.refresh(spark, paths)
        tel, blobs = (ingest.read_committed(spark, paths, x) for x in ("telemetry_events", "blob_index"))
        now = dt.datetime(2030, 1, 1)
        assert _row(kept_reports(state, paths, now)["reconcile"](spark)) == _row(reports.reconcile_report(tel, blobs, now))
        quality = _row(kept_reports(state, paths, now)["quality"](spark))
        assert quality == _row(reports.quality_report(tel, blobs, now))
        _close(hourly.linkage_report(spark), gold.linkage_report(tel, blobs), ("hour_bucket",))
    assert json.loads(json.dumps(quality, default=str))["overall_severity"] == "CRITICAL"
