"""Partition layout columns (K4)."""

from pyspark.sql import functions as F

from fleetlake import sinks
from fleetlake.functions import rules
from fleetlake.sources.fixtures import Fixture
from tests.conftest import SF_SMALL


def test_bucket_stable_in_range_and_spread(spark):
    tel = sinks.telemetry_layout(Fixture(spark, SF_SMALL).telemetry)
    per_device = tel.groupBy("device_id").agg(F.countDistinct("p_bucket").alias("n")).filter(F.col("n") != 1)
    assert per_device.count() == 0  # one bucket per device
    lo, hi, used = tel.agg(F.min("p_bucket"), F.max("p_bucket"), F.countDistinct("p_bucket")).collect()[0]
    assert 0 <= lo and hi < rules.TELEMETRY_BUCKETS
    devices = tel.select("device_id").distinct().count()
    assert used >= min(devices, rules.TELEMETRY_BUCKETS) // 2  # hash spreads devices over buckets
    hours = tel.filter(F.col("p_hour") != F.date_trunc("hour", "event_ts_corrected")).count()
    assert hours == 0


def test_event_id_round_trip_and_malformed(spark):
    from fleetlake.functions import ids

    df = spark.createDataFrame([("device-001:s-5:000000000042",), ("a:b",), ("device-x:s:1",)], "e string")
    rows = df.select(ids.parse_event_id("e").alias("p"), ids.device_shard(F.lit("device-017")).alias("s")).collect()
    assert rows[0]["p"]["counter"] == 42 and rows[0]["p"]["device_id"] == "device-001"
    assert rows[1]["p"] is None
    assert rows[2]["p"]["counter"] == 1
    assert rows[0]["s"] == "01"  # 17 % 16
    made = spark.range(1).select(ids.make_event_id(F.lit("device-001"), F.lit("s-5"), F.lit(42)).alias("e")).first()
    assert made["e"] == "device-001:s-5:000000000042"


def test_time_helpers_exact(spark):
    import datetime as dt

    from fleetlake.functions import time as t

    df = spark.createDataFrame([(1_704_067_200_123, dt.datetime(2024, 1, 1, 0, 0, 1, 500000),
                                 dt.datetime(2024, 1, 1, 0, 0, 0, 250000))], "ms long, a timestamp, b timestamp")
    r = df.select(
        t.ms_to_timestamp("ms").alias("ts"),
        t.seconds_between("a", "b").alias("d"),
        t.add_seconds("b", 59).alias("p"),
        t.timestamp_to_ms(t.ms_to_timestamp("ms")).alias("back"),
    ).collect()[0]
    assert r["ts"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert r["d"] == 1.25
    assert r["p"] == dt.datetime(2024, 1, 1, 0, 0, 59, 250000)
    assert r["back"] == 1_704_067_200_123
