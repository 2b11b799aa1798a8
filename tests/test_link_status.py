"""Link status as changes: any order of arrival, recall of ORPHANED, a bounded state."""

import datetime as dt
import os
import random
import time

from pyspark.sql import functions as F

from fleetlake.operators import linkage
from fleetlake.streaming import link_status as ls

T = "event_id string, device_id string, ingest_ts timestamp"
B = "event_id string, ingest_ts timestamp"


class Feed:
    """Two folders that are read as streams."""

    def __init__(self, spark, root, **bounds):
        self.spark, self.root, self.sent = spark, root, 0
        for name, schema in (("t", T), ("b", B)):
            os.makedirs(os.path.join(root, name))
        read = spark.readStream
        self.query = ls.start_link_status(
            read.schema(T).parquet(os.path.join(root, "t")), read.schema(B).parquet(os.path.join(root, "b")), os.path.join(root, "out"), os.path.join(root, "ckpt"), trigger={"processingTime": "1 second"}, **bounds
        )

    def put(self, tel=(), blobs=()):
        for name, schema, rows in (("t", T, tel), ("b", B, blobs)):
            if rows:
                self.spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(os.path.join(self.root, name))
        self.sent += len(tel) + len(blobs)
        # timers keep batches running, so there is no moment without work to wait for
        end = time.time() + 90
        while sum(p["numInputRows"] for p in self.query.recentProgress) < self.sent:
            if self.query.exception() is not None:
                raise self.query.exception()
            assert time.time() < end, self.query.lastProgress
            time.sleep(0.3)

    def changes(self):
        return self.spark.read.parquet(os.path.join(self.root, "out"))

    def wait_for(self, test, seconds=60):
        end = time.time() + seconds
        while time.time() < end:
            if self.query.exception() is not None:
                raise self.query.exception()
            if os.path.isdir(os.path.join(self.root, "out", "_spark_metadata")) and test(self.changes()):
                return True
            time.sleep(0.5)
        return False


def test_last_status_equals_the_batch_operator_in_any_order(spark, tmp_dir):
    rng = random.Random(3)
    now = dt.datetime.now().replace(microsecond=0)
    old, fresh = now - dt.timedelta(hours=2), now + dt.timedelta(hours=2)
    tel = [(f"e{i}", f"d{i % 3}", rng.choice([old, fresh]) + dt.timedelta(seconds=i)) for i in range(40)]
    tel += [tel[0], tel[0], (None, "d1", old), (None, "d1", fresh), ("e1", "d9", old)]
    blobs = [(f"e{i}", now) for i in range(0, 60, 2)] + [("e4", now), (None, now)]
    messages = [("t", r) for r in tel] + [("b", r) for r in blobs]
    rng.shuffle(messages)
    feed = Feed(spark, tmp_dir)
    try:
        third = len(messages) // 3 + 1
        for k in range(0, len(messages), third):
            part = messages[k : k + third]
            feed.put([r for kind, r in part if kind == "t"], [r for kind, r in part if kind == "b"])
        full = linkage.assign_link_status(spark.createDataFrame(tel, T).withColumn("ingest_status", F.lit("")), spark.createDataFrame(blobs, B), now)
        want = {(r.event_id, r.device_id, r.ingest_ts): (r.n, r.ingest_status) for r in full.groupBy("event_id", "device_id", "ingest_ts", "ingest_status").agg(F.count("*").alias("n")).collect()}
        got = {(r.event_id, r.device_id, r.ingest_ts): (r.n, r.ingest_status) for r in ls.last_status(feed.changes()).collect()}
        assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
        # n grows while a row is open; a row that comes after its manifest is counted in its own change
        assert got[(None, "d1", old)][0] == 1
        # an ORPHANED row is taken back when its manifest comes at last
        orphan = next(k for k, v in want.items() if v[1] == "ORPHANED" and k[0])
        feed.put(blobs=[(orphan[0], now)])
        (r,) = ls.last_status(feed.changes()).filter(F.col("event_id") == orphan[0]).filter(F.col("device_id") == orphan[1]).collect()
        assert r.ingest_status == "LINKED"
        said = [x.ingest_status for x in feed.changes().filter(F.col("event_id") == orphan[0]).orderBy("changed_at").collect()]
        assert said[-1] == "LINKED" and "ORPHANED" in said
    finally:
        feed.query.stop()


def test_timeout_fires_without_data_and_state_ends(spark, tmp_dir):
    feed = Feed(spark, tmp_dir, timeout_minutes=0.05, retain_minutes=0.1)  # 3 s, 6 s
    try:
        feed.put([("a", "d", dt.datetime.now())])
        assert feed.wait_for(lambda c: c.filter("event_id = 'a' and ingest_status = 'ORPHANED'").count() == 1)

        def rows_held():
            p = feed.query.lastProgress
            return None if p is None or not p["stateOperators"] else p["stateOperators"][0]["numRowsTotal"]

        end = time.time() + 60
        while rows_held() != 0 and time.time() < end:
            time.sleep(0.5)
        assert rows_held() == 0
    finally:
        feed.query.stop()
