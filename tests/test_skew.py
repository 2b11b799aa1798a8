"""Hot keys: one device / one id / NULL ids holding a third of the rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fleetlake.operators import drift, linkage

HB = "device_id string, session_id string, server_ts_ms long, estimated_drift_ms long"
EV = "event_id string, device_id string, event_ts_edge_ms long"


def test_asof_hot_device_matches_brute_force(spark):
    rnd = random.Random(5)
    hbs = [("hot", "s", t, rnd.randint(-500, 500)) for t in range(0, 3_600_000, 60_000)]
    hbs += [(f"r{i}", "s", rnd.randint(0, 3_600_000), rnd.randint(-500, 500)) for i in range(20)]
    evs = [(f"h{i}", "hot", rnd.randint(0, 3_700_000)) for i in range(600)]
    evs += [(f"e{i}", f"r{rnd.randint(0, 25)}", rnd.randint(0, 3_700_000)) for i in range(1200)]
    got = {r["event_id"]: r["drift_ms"] for r in
           drift.asof_drift(spark.createDataFrame(evs, EV), spark.createDataFrame(hbs, HB), span_ms=300_000).collect()}
    for eid, rid, ts in evs:
        c = [h for h in hbs if h[0] == rid and h[2] <= ts]
        assert got[eid] == (max(c, key=lambda h: (h[2], h[1], h[3]))[3] if c else None), eid


def test_counts_with_a_hot_duplicated_id(spark):
    now = dt.datetime(2024, 1, 1)
    T = "event_id string, ingest_ts timestamp"
    B = "event_id string, media_type string, ingest_ts timestamp"
    tel = [("hot", now)] * 500 + [(f"e{i}", now) for i in range(500)] + [(None, now)] * 500
    blob = [("hot", "audio", now)] * 300 + [(f"e{i}", "lidar_pointcloud", now) for i in range(0, 500, 2)]
    t, b = spark.createDataFrame(tel, T), spark.createDataFrame(blob, B)
    (r,) = linkage.linkage_counts(t, b).collect()
    assert r["linked_count"] == 500 * 300 + 250
    assert r["telemetry_unlinked"] == 250 + 500
    media = {x["media_type"]: x["cnt"] for x in linkage.media_breakdown(t, b).collect()}
    assert media == {"audio": 150_000, "lidar_pointcloud": 250}


def test_null_ids_bypass_the_shuffle(spark):
    now = dt.datetime(2024, 1, 1)
    T = "event_id string, ingest_ts timestamp, ingest_status string"
    tel = spark.createDataFrame([(None, now, "P")] * 50 + [("a", now, "P")], T)
    blob = spark.createDataFrame([("a", now)], "event_id string, ingest_ts timestamp")
    out = linkage.assign_link_status(tel, blob, now)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the NULL-id branch of the union is a plain filter over the input, no exchange below it
    branches = plan.split("Union")[1]
    assert "isnull(event_id" in branches
    counts = {r["ingest_status"]: r["count"] for r in out.groupBy("ingest_status").count().collect()}
    assert counts == {"LINKED": 1, "PENDING_BLOB_LINK": 50}
