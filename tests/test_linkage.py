"""Linkage operators: duplicates, NULL ids, empty inputs, properties, tolerance match."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fleetlake.operators import linkage
from fleetlake.plans import reports

T = "event_id string, device_id string, ingest_ts timestamp, event_ts_corrected timestamp, ingest_status string, temperature double"
B = "event_id string, device_id string, media_type string, blob_uri string, ingest_ts timestamp, blob_ts_corrected timestamp"
NOW = dt.datetime(2024, 1, 1, 12, 0, 0)


def _t(rows):
    return [(e, r, NOW - dt.timedelta(seconds=s), NOW, "PENDING_BLOB_LINK", 20.0) for e, r, s in rows]


def _b(rows):
    return [(e, "r1", m, f"s3://x/{e}/{i}", NOW, NOW) for i, (e, m) in enumerate(rows)]


def test_counts_with_duplicates_and_nulls(spark):
    tel = spark.createDataFrame(_t([("a", "r1", 10), ("a", "r1", 20), ("b", "r1", 30), ("c", "r2", 700), (None, "r1", 5)]), T)
    blob = spark.createDataFrame(_b([("a", "camera_rgb"), ("a", "audio"), ("a", "audio"), ("b", "audio"), ("z", "audio"), (None, "audio")]), B)
    (r,) = linkage.linkage_counts(tel, blob, now=NOW).collect()
    # SQL semantics: pairs = 2*3 + 1 = 7; unlinked = c + NULL; orphans = z + NULL
    assert r["telemetry_total"] == 5 and r["blob_total"] == 6
    assert r["linked_count"] == 7
    assert r["telemetry_unlinked"] == 2
    assert r["blob_orphans"] == 2
    assert r["linkage_pct"] == round(7 / 5 * 100, 2)
    assert r["oldest_unlinked_sec"] == 700.0
    assert linkage.unlinked_telemetry(tel, blob).count() == 2
    assert linkage.orphan_blobs(blob, tel).count() == 2
    media = {x["media_type"]: x["cnt"] for x in linkage.media_breakdown(tel, blob).collect()}
    assert media == {"camera_rgb": 2, "audio": 5}
    (lj,) = linkage.linkage_rate_leftjoin(tel, blob).collect()
    assert lj["total_telemetry"] == 2 * 3 + 1 + 1 + 1 and lj["linked"] == 7


def test_empty_tables_do_not_raise(spark):
    tel = spark.createDataFrame([], T)
    blob = spark.createDataFrame([], B)
    (r,) = linkage.linkage_counts(tel, blob, now=NOW).collect()
    counts = ("telemetry_total", "blob_total", "linked_count", "telemetry_unlinked", "blob_orphans", "linked_events")
    assert [r[c] for c in counts] == [0] * 6
    assert r["linkage_pct"] == 0.0
    (lj,) = linkage.linkage_rate_leftjoin(tel, blob).collect()
    assert lj["linkage_pct"] is None
    (rep,) = reports.reconcile_report(tel, blob, NOW).collect()
    assert rep["status"] == "DEGRADED" and rep["media_breakdown"] == {}
    assert rep["linkage_pct"] == 0.0 and rep["linked_count"] == 0
    (q,) = reports.quality_report(tel, blob, NOW).collect()
    assert q["overall_severity"] == "CRITICAL"  # no data -> freshness NULL -> CRITICAL
    link = q["checks"]["completeness_linkage"]
    assert (link["severity"], link["linkage_pct"], link["linked"], link["total_telemetry"]) == ("CRITICAL", 0.0, 0, 0)


def test_property_unique_ids_rates_agree(spark):
    ids = [f"e{i}" for i in range(200)]
    tel = spark.createDataFrame(_t([(e, "r1", i) for i, e in enumerate(ids)]), T)
    blob = spark.createDataFrame(_b([(e, "audio") for e in ids]), B)
    (a,) = linkage.linkage_counts(tel, blob).collect()
    (b,) = linkage.linkage_rate_leftjoin(tel, blob).collect()
    assert a["linkage_pct"] == b["linkage_pct"] == 100.0
    assert a["linked_events"] + a["telemetry_unlinked"] == a["telemetry_total"]


def test_assign_link_status(spark):
    tel = spark.createDataFrame(_t([("a", "r1", 30), ("b", "r1", 601), ("c", "r1", 599), (None, "r1", 9999)]), T)
    blob = spark.createDataFrame(_b([("a", "audio")]), B)
    got = {r["event_id"]: r["ingest_status"] for r in linkage.assign_link_status(tel, blob, NOW, 10).collect()}
    assert got == {"a": "LINKED", "b": "ORPHANED", "c": "PENDING_BLOB_LINK", None: "ORPHANED"}


def test_tolerance_match_against_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    trows, brows = [], []
    for i in range(400):
        r = f"r{rnd.randint(1, 3)}"
        ts = base + dt.timedelta(milliseconds=rnd.randint(0, 200_000))
        trows.append((f"t{i:04d}", r, NOW, ts, "P", 20.0))
    for i in range(60):  # several telemetry rows at the same instant: smallest id must win
        r = f"r{rnd.randint(1, 3)}"
        ts = base + dt.timedelta(milliseconds=rnd.choice([1000, 50_000, 120_000]))
        trows.append((f"t9{i:03d}", r, NOW, ts, "P", 20.0))
    for i in range(150):
        r = f"r{rnd.randint(1, 3)}"
        ts = base + dt.timedelta(milliseconds=rnd.randint(0, 200_000))
        brows.append((f"b{i}", r, "audio", f"u{i}", NOW, ts))
    for i in range(30):  # blobs next to those instants, on either side
        r = f"r{rnd.randint(1, 3)}"
        ts = base + dt.timedelta(milliseconds=rnd.choice([1000, 50_000, 120_000]) + rnd.randint(-250, 250))
        brows.append((f"bt{i}", r, "audio", f"ut{i}", NOW, ts))
    tel = spark.createDataFrame(trows, T)
    blob = spark.createDataFrame(brows, B)
    for tolerance, span in ((300, 5_000), (20_000, 3_000), (90_000, None)):
        got = {r["blob_uri"]: (r["telemetry_event_id"], r["diff_ms"])
               for r in linkage.tolerance_match(tel, blob, tolerance, span_ms=span).collect()}
        want = {}
        for be, br, _, uri, _, bts in brows:
            c = [(abs((tts - bts) // dt.timedelta(milliseconds=1)), te) for te, tr, _, tts, _, _ in trows if tr == br]
            c = [x for x in c if x[0] <= tolerance]
            if c:
                d, te = min(c)
                want[uri] = (te, d)
        assert got == want


def test_tolerance_longer_than_the_span_reaches_across_spans(spark):
    base = dt.datetime(2024, 1, 1)
    tel = spark.createDataFrame([("t1", "r1", NOW, base, "P", 20.0)], T)
    blob = spark.createDataFrame([("b1", "r1", "audio", "u1", NOW, base + dt.timedelta(seconds=90))], B)
    (r,) = linkage.tolerance_match(tel, blob, 200_000, span_ms=60_000).collect()
    assert (r["telemetry_event_id"], r["diff_ms"]) == ("t1", 90_000)


def test_cross_layer_join_is_top_k(spark):
    tel = spark.createDataFrame(_t([(f"e{i}", "r1", i) for i in range(50)]), T)
    blob = spark.createDataFrame(_b([(f"e{i}", "audio") for i in range(50)]), B)
    out = linkage.cross_layer_join(tel, blob, 5, blob_cols=["media_type", "blob_uri"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert [r["event_id"] for r in out.collect()] == ["e0", "e1", "e2", "e3", "e4"]


def test_cross_layer_join_matches_full_join_with_hot_ids(spark):
    rnd = random.Random(11)
    trows = [(f"e{rnd.randint(0, 30)}", "r1", NOW - dt.timedelta(seconds=rnd.randint(0, 50)), NOW, "P", 1.0)
             for _ in range(300)]
    trows += [("hot", "r2", NOW - dt.timedelta(seconds=3), NOW, "P", 1.0)] * 100
    brows = [(f"e{rnd.randint(0, 40)}", "r1", "audio", f"u{i}", NOW, NOW) for i in range(200)]
    brows += [("hot", "r1", "audio", f"h{i}", NOW, NOW) for i in range(50)]
    tel = spark.createDataFrame(trows, T)
    blob = spark.createDataFrame(brows, B)
    got = [(r["event_id"], r["blob_uri"]) for r in
           linkage.cross_layer_join(tel, blob, 20, blob_cols=["blob_uri"], telemetry_cols=["event_id", "ingest_ts"]).collect()]
    pairs = sorted(((t[2], t[0], b[3]) for t in trows for b in brows if t[0] == b[0]),
                   key=lambda x: (-x[0].timestamp(), x[1], x[2]))[:20]
    assert sorted(got) == sorted((e, u) for _, e, u in pairs)
