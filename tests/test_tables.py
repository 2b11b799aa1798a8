"""Catalog listing, readiness probe, column description, report sink, periodic report."""

import json
import os

from pyspark.sql import functions as F

from fleetlake import sinks
from fleetlake.plans import reports
from fleetlake.sources import tables
from fleetlake.sources.fixtures import Fixture
from fleetlake.streaming import monitor
from tests.conftest import SF_SMALL


def test_describe_and_ready(spark, tmp_dir):
    f = Fixture(spark, SF_SMALL)
    desc = {r["column_name"]: r["data_type"] for r in tables.describe_columns(f.telemetry).collect()}
    assert desc["event_ts_edge_ms"] == "bigint" and desc["ingest_ts"] == "timestamp"
    assert tables.has_column(f.telemetry, "torque")
    path = os.path.join(tmp_dir, "t")
    assert not tables.table_ready(spark, path)
    f.telemetry.write.parquet(path)
    assert tables.table_ready(spark, path)
    assert tables.read_table(spark, path).count() == f.telemetry.count()
    assert tables.list_catalogs(spark).count() >= 1
    assert tables.list_schemas(spark).count() >= 1
    tables.list_tables(spark)  # does not raise


def test_report_sink_json_lines(spark, tmp_dir):
    f = Fixture(spark, SF_SMALL)
    now = f.telemetry.agg(F.max("ingest_ts")).scalar()
    path = os.path.join(tmp_dir, "reports")
    sinks.report_sink(reports.reconcile_report(f.telemetry, f.blobs, now), path)
    sinks.report_sink(reports.quality_report(f.telemetry, f.blobs, now), path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    kinds = {("status" in d) for d in lines}
    assert kinds == {True, False} and len(lines) == 2
    rec = [d for d in lines if "status" in d][0]
    assert rec["linked_count"] >= rec["telemetry_total"] - rec["telemetry_unlinked"]
    q = [d for d in lines if "overall_severity" in d][0]
    assert set(q["checks"]) == {"freshness", "completeness_volume", "completeness_linkage", "accuracy"}
    assert len(q["stale_devices_top5"]) == 5


def test_periodic_report(spark, tmp_dir):
    f = Fixture(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "periodic")

    def build(s):
        return reports.reconcile_report(f.telemetry, f.blobs)

    assert monitor.start_periodic_report(spark, build, path, os.path.join(tmp_dir, "ck"), once=True) is None
    import time

    q = monitor.start_periodic_report(spark, build, path, os.path.join(tmp_dir, "ck"), interval_sec=1)
    try:
        deadline = time.time() + 120
        while time.time() < deadline and len(q.recentProgress) < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    assert spark.read.text(path).count() >= 2


def test_replay_window_half_open(spark):
    df = spark.createDataFrame([(1_000,), (1_999,), (2_000,), (None,)], "event_ts_edge_ms long")
    got = tables.replay_window(df, start="1970-01-01 00:00:01", end="1970-01-01 00:00:02").collect()
    assert [r[0] for r in got] == [1_000, 1_999]
    got = tables.replay_window(df, hours_back=1, now="1970-01-01 00:00:02").count()
    assert got == 2


def test_read_as_of(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, s),) for s in range(5)], "ingest_ts timestamp")
    assert tables.read_as_of(df, "2024-01-01 00:00:02").count() == 3
