"""Streaming ingest on a file source: batch = stream, restart, rejects, late rows."""

import json
import os

from pyspark.sql import functions as F

from fleetlake.functions.rules import WIRE_DEVICE_ID
from fleetlake.operators import linkage
from fleetlake.streaming import ingest, monitor


def _write_lines(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        for r in records:
            fh.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def _tel(i, device="device-001", ts=1_704_067_200_000, temp=30.0):
    return {
        "event_id": f"{device}:s-1:{i:012d}",
        WIRE_DEVICE_ID: device,
        "session_id": "s-1",
        "event_ts_edge_ms": ts + i,
        "sensor_type": "imu",
        "temperature": temp,
        "torque": 5.0,
    }


def _man(i, device="device-001", ts=1_704_067_200_000):
    return {
        "event_id": f"{device}:s-1:{i:012d}",
        WIRE_DEVICE_ID: device,
        "session_id": "s-1",
        "media_type": "audio",
        "blob_uri": f"s3://raw-blobs/blob/{i}.bin",
        "blob_ts_edge_ms": ts + i,
        "object_size": 100,
        "checksum_sha256": "a" * 64,
        "quality_state": "INGESTED",
    }


def test_ingest_drift_rejects_restart(spark, tmp_dir):
    src_t, src_m, src_h = (os.path.join(tmp_dir, d) for d in ("t", "m", "h"))
    _write_lines(src_h, "h0.json", [{WIRE_DEVICE_ID: "device-001", "session_id": "s-1", "server_ts_ms": 1, "estimated_drift_ms": 250}])
    _write_lines(src_t, "t0.json", [_tel(i) for i in range(5)] + [_tel(99, temp=999.0), "{broken"])
    _write_lines(src_m, "m0.json", [_man(i) for i in range(3)])
    root = os.path.join(tmp_dir, "lake")
    paths = ingest.IngestPaths(root)
    trig = {"availableNow": True}

    hq = ingest.start_heartbeat_stream(spark, paths, src_h, trigger=trig)
    hq.awaitTermination()
    qs = [
        ingest.start_table_stream(spark, "telemetry_events", paths, src_t, trigger=trig),
        ingest.start_table_stream(spark, "blob_index", paths, src_m, trigger=trig),
    ]
    for q in qs:
        q.awaitTermination()

    tel = ingest.read_committed(spark, paths, "telemetry_events")
    assert tel.count() == 5
    row = tel.filter(F.col("event_id").endswith("000000000000")).collect()[0]
    assert row["ingest_status"] == "PENDING_BLOB_LINK"
    assert row["drift_source"] == "HEARTBEAT"
    assert int(row["event_ts_corrected"].timestamp() * 1000) == 1_704_067_200_000 - 250
    rej = spark.read.parquet(paths.rejects("telemetry_events"))
    assert rej.count() == 2
    assert {tuple(r["errors"])[0] for r in rej.collect()} == {
        "temperature_out_of_range:999.0",
        "missing_field:event_id",
    }

    # restart on the same checkpoint with one new file: only the new rows arrive
    _write_lines(src_t, "t1.json", [_tel(i) for i in range(10, 13)])
    q = ingest.start_table_stream(spark, "telemetry_events", paths, src_t, trigger=trig)
    q.awaitTermination()
    tel = ingest.read_committed(spark, paths, "telemetry_events")
    assert tel.count() == 8
    assert tel.select("event_id").distinct().count() == 8

    blobs = ingest.read_committed(spark, paths, "blob_index")
    (r,) = linkage.linkage_counts(tel, blobs).collect()
    assert r["linked_count"] == 3 and r["telemetry_unlinked"] == 5

    log = spark.read.parquet(paths.batch_log)
    assert log.filter(F.col("table_name") == "telemetry_events").count() == 2

    prog = monitor.stream_progress(spark, {"t": q}).collect()[0]
    assert prog["num_input_rows"] == 3


def test_replayed_batch_is_idempotent(spark, tmp_dir):
    from fleetlake import sinks

    df = spark.createDataFrame([(1, True, [])], "x int, is_valid boolean, errors array<string>")
    acc, rej, log = (os.path.join(tmp_dir, d) for d in ("a", "r", "l"))
    sinks.write_batch_with_rejects(df, 0, acc, rej, log)
    sinks.write_batch_with_rejects(df, 0, acc, rej, log)  # retried batch: skipped
    assert sinks.read_committed(spark, acc, log, "telemetry_events").count() == 1
    assert spark.read.parquet(log).count() == 1


def test_late_rows_land_in_old_partition(spark, tmp_dir):
    src_t = os.path.join(tmp_dir, "t")
    old_ts = 1_600_000_000_000
    _write_lines(src_t, "t0.json", [_tel(1), _tel(2, ts=old_ts)])
    paths = ingest.IngestPaths(os.path.join(tmp_dir, "lake"))
    q = ingest.start_table_stream(spark, "telemetry_events", paths, src_t, trigger={"availableNow": True})
    q.awaitTermination()
    tel = spark.read.parquet(paths.table("telemetry_events"))
    hours = {r["p_hour"] for r in tel.select("p_hour").collect()}
    assert len(hours) == 2  # nothing dropped: no watermark on ingest


def test_link_status_stream(spark, tmp_dir):
    import datetime as dt

    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    t_dir, b_dir = os.path.join(tmp_dir, "ts"), os.path.join(tmp_dir, "bs")
    tel = spark.createDataFrame(
        [("a", "r1", base), ("b", "r1", base), ("c", "r1", base + dt.timedelta(hours=2))],
        "event_id string, device_id string, ingest_ts timestamp",
    )
    blob = spark.createDataFrame(
        [("a", base + dt.timedelta(minutes=1)), ("z", base + dt.timedelta(hours=2, minutes=30))],
        "event_id string, ingest_ts timestamp",
    )
    tel.write.parquet(t_dir)
    blob.write.parquet(b_dir)
    ts = spark.readStream.schema(tel.schema).parquet(t_dir)
    bs = spark.readStream.schema(blob.schema).parquet(b_dir)
    out = monitor.link_status_stream(ts, bs, timeout_minutes=10)
    q = out.writeStream.format("memory").queryName("link_status_t").outputMode("append").start()
    q.processAllAvailable()
    # a second (empty) batch lets the watermark advance and emit the outer rows
    q.processAllAvailable()
    q.stop()
    got = {r["event_id"]: r["ingest_status"] for r in spark.sql("SELECT * FROM link_status_t").collect()}
    assert got.get("a") == "LINKED"
    assert got.get("b") == "ORPHANED"


def test_asof_drift_mode_in_stream(spark, tmp_dir):
    src_t, src_h = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "h")
    base = 1_704_067_200_000
    _write_lines(src_h, "h0.json", [
        {WIRE_DEVICE_ID: "device-001", "session_id": "s-1", "server_ts_ms": base - 10_000, "estimated_drift_ms": 100},
        {WIRE_DEVICE_ID: "device-001", "session_id": "s-1", "server_ts_ms": base + 5_000, "estimated_drift_ms": 300},
    ])
    _write_lines(src_t, "t0.json", [_tel(0, ts=base), _tel(0, ts=base + 9_000)])
    paths = ingest.IngestPaths(os.path.join(tmp_dir, "lake"))
    trig = {"availableNow": True}
    ingest.start_heartbeat_stream(spark, paths, src_h, trigger=trig).awaitTermination()
    ingest.start_table_stream(spark, "telemetry_events", paths, src_t, trigger=trig, drift_mode="asof").awaitTermination()
    got = sorted(int(r["event_ts_corrected"].timestamp() * 1000)
                 for r in spark.read.parquet(paths.table("telemetry_events")).collect())
    assert got == [base - 100, base + 9_000 - 300]


def test_run_and_test_models(spark, tmp_dir):
    from fleetlake.plans import models
    from fleetlake.sources.fixtures import Fixture
    from tests.conftest import SF_SMALL

    f = Fixture(spark, SF_SMALL)
    paths = models.run_models(spark, f.telemetry, f.blobs, os.path.join(tmp_dir, "models"))
    assert spark.read.parquet(paths["device_hourly_stats"]).count() > 0
    res = {(r["table_name"], r["column_name"], r["test_name"]): r["status"]
           for r in models.check_models(spark, f.telemetry, f.blobs, paths).collect()}
    assert res[("blob_linked", "event_id", "unique")] == "fail"  # duplicated manifests
    assert res[("telemetry_validated", "quality_flag", "accepted_values")] == "pass"


def test_hourly_stats_stream_matches_batch(spark, tmp_dir):
    from fleetlake.plans import gold, silver
    from fleetlake.sources.fixtures import Fixture
    from fleetlake.streaming import aggregates
    from tests.conftest import SF_SMALL

    tel = Fixture(spark, SF_SMALL).telemetry
    src = os.path.join(tmp_dir, "bronze")
    tel.write.parquet(src)
    stream = spark.readStream.schema(tel.schema).parquet(src)
    q = (aggregates.hourly_stats_stream(stream, "0 seconds").writeStream.format("memory")
         .queryName("hourly_stream_t").outputMode("append").start())
    q.processAllAvailable()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM hourly_stream_t")
    want = gold.device_hourly_stats(silver.telemetry_validated(tel))
    last_hour = want.agg(F.max("hour_bucket")).collect()[0][0]
    # every hour except the newest is closed by the watermark and emitted exactly
    want = want.filter(F.col("hour_bucket") < last_hour)
    got = got.filter(F.col("hour_bucket") < last_hour)
    key = ["device_id", "hour_bucket", "sensor_type", "event_count", "max_torque", "first_event", "last_event"]
    assert got.count() == want.count()
    assert got.select(*key).exceptAll(want.select(*key)).count() == 0


def test_drift_state_is_compact_and_latest(spark, tmp_dir):
    src_h = os.path.join(tmp_dir, "h")
    paths = ingest.IngestPaths(os.path.join(tmp_dir, "lake"))
    trig = {"availableNow": True}
    _write_lines(src_h, "h0.json", [
        {WIRE_DEVICE_ID: "device-001", "session_id": "s-1", "server_ts_ms": 10, "estimated_drift_ms": 5},
        {WIRE_DEVICE_ID: "device-002", "session_id": "s-1", "server_ts_ms": 10, "estimated_drift_ms": 7},
    ])
    ingest.start_heartbeat_stream(spark, paths, src_h, trigger=trig).awaitTermination()
    _write_lines(src_h, "h1.json", [
        {WIRE_DEVICE_ID: "device-001", "session_id": "s-1", "server_ts_ms": 20, "estimated_drift_ms": 9},
        {WIRE_DEVICE_ID: "device-002", "session_id": "s-0", "server_ts_ms": 5, "estimated_drift_ms": 1},
    ])
    ingest.start_heartbeat_stream(spark, paths, src_h, trigger=trig).awaitTermination()
    state = {r["device_id"]: r["drift_ms"] for r in ingest.read_drift_state(spark, paths).collect()}
    assert state == {"device-001": 9, "device-002": 7}  # older heartbeat of device-002 does not win
    assert spark.read.parquet(paths.table("heartbeats")).count() == 4


def test_optional_dedup(spark, tmp_dir):
    src_t = os.path.join(tmp_dir, "t")
    _write_lines(src_t, "t0.json", [_tel(1), _tel(1), _tel(2), "{broken"])
    paths = ingest.IngestPaths(os.path.join(tmp_dir, "lake"))
    ingest.start_table_stream(spark, "telemetry_events", paths, src_t, trigger={"availableNow": True},
                              dedup_within="10 minutes").awaitTermination()
    assert spark.read.parquet(paths.table("telemetry_events")).count() == 2
    assert spark.read.parquet(paths.rejects("telemetry_events")).count() == 1


def test_batch_replayed_after_crash_before_log(spark, tmp_dir):
    from fleetlake import sinks

    df = spark.createDataFrame([(1, True, []), (2, False, ["x"])], "x int, is_valid boolean, errors array<string>")
    acc, rej, log = (os.path.join(tmp_dir, d) for d in ("a", "r", "l"))
    # first attempt: data written, then the job dies before the log row (simulated: no log)
    sinks.write_batch_with_rejects(df, 7, acc, rej, None)
    # the engine replays batch 7 from the checkpoint
    sinks.write_batch_with_rejects(df, 7, acc, rej, log)
    assert spark.read.parquet(acc).count() == 2  # the failed attempt's files are there but in no log row
    assert sinks.read_committed(spark, acc, log, "telemetry_events").count() == 1
    assert sinks.read_committed(spark, rej, log, "telemetry_events").count() == 1
    assert spark.read.parquet(log).filter(F.col("batch_id") == 7).count() == 1


def test_asof_stream_equals_batch(spark, tmp_dir):
    """Heartbeats of any age count, in a stream as in a batch; rows without a
    device keep their place with the default drift."""
    from fleetlake.operators import drift

    src_t, src_h = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "h")
    day = 86_400_000
    base = 1_704_067_200_000 + 20 * day

    def hb(device, ms, value):
        return {WIRE_DEVICE_ID: device, "session_id": "s-1", "server_ts_ms": ms, "estimated_drift_ms": value}

    _write_lines(src_h, "h0.json", [
        hb("device-001", base - 10 * day, 11),
        hb("device-002", base - 10 * day, 22),  # the last one before the event, ten days old
        hb("device-002", base + day, 33),
        hb("device-003", base - 1000, 44),
        hb("device-003", base - 900, 44),
        hb("device-003", base - 800, 45),
        hb("device-003", base - 700, 44),
    ])
    rows = [_tel(1, "device-001", base), _tel(2, "device-002", base), _tel(3, "device-003", base), _tel(4, "device-004", base)]
    rows.append({**_tel(5, "device-001", base), WIRE_DEVICE_ID: None})
    _write_lines(src_t, "t0.json", rows)
    paths = ingest.IngestPaths(os.path.join(tmp_dir, "lake"))
    trig = {"availableNow": True}
    ingest.start_heartbeat_stream(spark, paths, src_h, trigger=trig).awaitTermination()
    ingest.start_table_stream(spark, "telemetry_events", paths, src_t, trigger=trig, drift_mode="asof", validated=False).awaitTermination()
    table = ingest.read_committed(spark, paths, "telemetry_events")
    got = {int(r["event_id"][-1]): (r["event_ts_edge_ms"] - int(r["event_ts_corrected"].timestamp() * 1000), r["drift_source"]) for r in table.collect()}
    assert got == {1: (11, "HEARTBEAT"), 2: (22, "HEARTBEAT"), 3: (44, "HEARTBEAT"), 4: (0, "DEFAULT"), 5: (0, "DEFAULT")}
    batch = drift.correct_drift_asof(table.drop("event_ts_corrected", "drift_source"), ingest.committed_heartbeats(spark, paths))
    assert {int(r["event_id"][-1]): (r["drift_ms"] or 0, r["drift_source"]) for r in batch.collect()} == got


def test_unreadable_drift_state_is_an_error(spark, tmp_dir):
    import pytest

    src_h = os.path.join(tmp_dir, "h")
    _write_lines(src_h, "h0.json", [{WIRE_DEVICE_ID: "device-001", "session_id": "s-1", "server_ts_ms": 10, "estimated_drift_ms": 5}])
    paths = ingest.IngestPaths(os.path.join(tmp_dir, "lake"))
    assert ingest.read_drift_state(spark, paths) is None
    ingest.start_heartbeat_stream(spark, paths, src_h, trigger={"availableNow": True}).awaitTermination()
    for name in os.listdir(f"{paths.drift_state}/batch_id=0"):
        if name.endswith(".parquet"):
            with open(f"{paths.drift_state}/batch_id=0/{name}", "wb") as f:
                f.write(b"broken")
    with pytest.raises(Exception, match="(?i)parquet"):
        ingest.read_drift_state(spark, paths).collect()
    _write_lines(src_h, "h1.json", [{WIRE_DEVICE_ID: "device-002", "session_id": "s-1", "server_ts_ms": 10, "estimated_drift_ms": 5}])
    q = ingest.start_heartbeat_stream(spark, paths, src_h, trigger={"availableNow": True})
    with pytest.raises(Exception, match="(?i)parquet"):
        q.awaitTermination()


def test_streamed_hour_lookup_is_pruned(spark, tmp_dir):
    import datetime as dt

    from fleetlake import sinks

    src_t = os.path.join(tmp_dir, "t")
    hour = 3_600_000
    _write_lines(src_t, "t0.json", [_tel(i, ts=1_704_067_200_000 + i * hour) for i in range(4)])
    paths = ingest.IngestPaths(os.path.join(tmp_dir, "lake"))
    ingest.start_table_stream(spark, "telemetry_events", paths, src_t, trigger={"availableNow": True}).awaitTermination()
    assert all(d.startswith("p_hour=") or d.startswith("_") or d.endswith(".crc") for d in os.listdir(paths.table("telemetry_events")))
    start = dt.datetime(2024, 1, 1, 2)
    cond = sinks.device_hour_filter("device-001", start, start + dt.timedelta(minutes=59))
    one = ingest.read_committed(spark, paths, "telemetry_events").filter(cond)
    assert [r["event_id"][-1] for r in one.collect()] == ["2"]
    for df in (one, spark.read.parquet(paths.table("telemetry_events")).filter(cond)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "p_hour" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_broker_options():
    import pytest

    from fleetlake.sources.topics import topic_options

    assert topic_options("t", "b1:9092,b2:9092") == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "t", "startingOffsets": "earliest"}
    assert topic_options("heartbeat", "b:9092", "latest")["startingOffsets"] == "latest"
    with pytest.raises(ValueError, match="bootstrap"):
        topic_options("t", None)


def test_ingest_reaches_the_broker_source(spark, tmp_dir, monkeypatch):
    """``bootstrap`` gets to the topic reader for every kind, heartbeats from the latest offsets."""
    seen = []

    def reader(spark, topic, starting="earliest", bootstrap=None, path=None, max_files_per_trigger=None):
        seen.append((topic, starting, bootstrap))
        src = os.path.join(tmp_dir, topic)
        _write_lines(src, "0.json", [])
        return spark.readStream.format("text").load(src)

    monkeypatch.setattr(ingest, "read_topic_stream", reader)
    for q in ingest.start_ingest(spark, os.path.join(tmp_dir, "lake"), bootstrap="b:9092", trigger={"availableNow": True}).values():
        q.awaitTermination()
    assert seen == [("heartbeat", "latest", "b:9092"), ("telemetry_events", "earliest", "b:9092"), ("blob_index", "earliest", "b:9092")]


def test_failed_report_is_a_line_of_its_own(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reports")
    monitor.start_periodic_report(spark, lambda s: s.read.parquet(os.path.join(tmp_dir, "none")), path, "", once=True)
    monitor.start_periodic_report(spark, lambda s: s.range(1).selectExpr("id", "raise_error('late failure') AS x"), path, "", once=True)
    monitor.start_periodic_report(spark, lambda s: s.range(1).selectExpr("'OK' AS overall_severity"), path, "", once=True)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert sorted(x["overall_severity"] for x in lines) == ["ERROR", "ERROR", "OK"]
    assert any("late failure" in x.get("error", "") for x in lines)


def test_append_stream_to_catalog_table(spark, tmp_dir):
    from fleetlake import sinks
    from fleetlake.schemas import TELEMETRY_SCHEMA
    from fleetlake.sources.topics import decode_payload, read_topic_stream

    src = os.path.join(tmp_dir, "t")
    _write_lines(src, "0.json", [_tel(i) for i in range(4)])
    spark.sql("CREATE DATABASE IF NOT EXISTS fl_stream")
    spark.sql(f"CREATE TABLE IF NOT EXISTS fl_stream.tel (event_id STRING, device_id STRING) USING parquet "
              f"LOCATION '{os.path.join(tmp_dir, 'wh')}'")
    df = decode_payload(read_topic_stream(spark, "t", path=src), TELEMETRY_SCHEMA).select("event_id", "device_id")
    q = sinks.append_stream(df, None, os.path.join(tmp_dir, "ck"), trigger={"availableNow": True},
                            table="fl_stream.tel")
    q.awaitTermination()
    assert spark.table("fl_stream.tel").count() == 4
    spark.sql("DROP TABLE fl_stream.tel")


def test_hourly_status_stream_matches_batch(spark, tmp_dir):
    from fleetlake.plans import gold
    from fleetlake.sources.fixtures import Fixture
    from fleetlake.streaming import aggregates
    from tests.conftest import SF_SMALL

    tel = Fixture(spark, SF_SMALL).telemetry
    src = os.path.join(tmp_dir, "bronze")
    tel.write.parquet(src)
    q = (aggregates.hourly_status_stream(spark.readStream.schema(tel.schema).parquet(src), "0 seconds")
         .writeStream.format("memory").queryName("hourly_status_t").outputMode("append").start())
    q.processAllAvailable()
    q.processAllAvailable()
    q.stop()
    want = gold.telemetry_hourly_status(tel)
    last = want.agg(F.max("hour_bucket")).collect()[0][0]
    got = spark.sql("SELECT * FROM hourly_status_t").filter(F.col("hour_bucket") < last)
    want = want.filter(F.col("hour_bucket") < last)
    cols = ["hour_bucket", "total_telemetry", "linked_count", "pending_count", "orphaned_count"]
    assert got.count() == want.count()
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
