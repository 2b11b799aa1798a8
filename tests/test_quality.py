"""SLA classifiers at their exact thresholds, worst-of, freshness and windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import linkage, quality


def _one(spark, col, value, dtype):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col(F.col("x")).alias("y")).collect()[0]["y"]


@pytest.mark.parametrize("sec,want", [(None, "CRITICAL"), (0, "OK"), (60, "OK"), (61, "WARNING"),
                                      (120, "WARNING"), (121, "CRITICAL")])
def test_freshness(spark, sec, want):
    assert _one(spark, quality.classify_freshness, sec, "int") == want


@pytest.mark.parametrize("n,want", [(0, "WARNING"), (99, "WARNING"), (100, "OK")])
def test_volume(spark, n, want):
    assert _one(spark, quality.classify_volume, n, "long") == want


@pytest.mark.parametrize("pct,want", [(79.99, "CRITICAL"), (80.0, "WARNING"), (89.99, "WARNING"), (90.0, "OK")])
def test_linkage(spark, pct, want):
    assert _one(spark, quality.classify_linkage, pct, "double") == want


@pytest.mark.parametrize("bad,want", [(0, "OK"), (1, "CRITICAL")])
def test_accuracy(spark, bad, want):
    assert _one(spark, quality.classify_accuracy, bad, "long") == want


@pytest.mark.parametrize("pct,want", [(94.99, "DEGRADED"), (95.0, "HEALTHY"), (100.0, "HEALTHY")])
def test_link_health(spark, pct, want):
    assert _one(spark, linkage.link_health, pct, "double") == want


@pytest.mark.parametrize("levels,want", [(["OK", "OK"], "OK"), (["OK", "WARNING"], "WARNING"),
                                         (["WARNING", "CRITICAL", "OK"], "CRITICAL"), (["ERROR", "OK"], "OK")])
def test_worst_severity(spark, levels, want):
    df = spark.createDataFrame([tuple(levels)], ", ".join(f"c{i} string" for i in range(len(levels))))
    got = df.select(quality.worst_severity(*[F.col(f"c{i}") for i in range(len(levels))])).collect()[0][0]
    assert got == want


def test_freshness_seconds_truncates_and_floors(spark):
    now = dt.datetime(2024, 1, 1, 0, 1, 0)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 29, 600000),)], "ingest_ts timestamp")
    assert quality.freshness_seconds(df, now).collect()[0]["freshness_sec"] == 30  # int(30.4)
    future = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 2, 0),)], "ingest_ts timestamp")
    assert quality.freshness_seconds(future, now).collect()[0]["freshness_sec"] == 0
    empty = spark.createDataFrame([], "ingest_ts timestamp")
    assert quality.freshness_seconds(empty, now).collect()[0]["freshness_sec"] is None


def test_trailing_window_is_strict(spark):
    now = dt.datetime(2024, 1, 1, 0, 10, 0)
    rows = [(now - dt.timedelta(minutes=5),), (now - dt.timedelta(minutes=5) + dt.timedelta(microseconds=1),)]
    df = spark.createDataFrame(rows, "ingest_ts timestamp")
    assert quality.events_in_window(df, now, 5).collect()[0][0] == 1


def test_stale_devices_ties_by_id(spark):
    now = dt.datetime(2024, 1, 1, 1, 0, 0)
    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    df = spark.createDataFrame([("r2", t), ("r1", t), ("r3", now)], "device_id string, ingest_ts timestamp")
    got = [(r["device_id"], r["stale_sec"]) for r in quality.per_device_freshness(df, now, 2).collect()]
    assert got == [("r1", 3600), ("r2", 3600)]
