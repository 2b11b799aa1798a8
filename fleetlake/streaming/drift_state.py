"""As-of drift for streams with bounded work per batch.

Heartbeats are kept in one bucket per (device slot, span of time).  A bucket holds its own points
(device, time, drift) and, for each device, the last point before the span (its *carry*).  So the drift
of any record is found in one bucket: that of the record's span, or the slot's newest one before
it.  A batch of records reads only the buckets of the spans that its times lie in; a batch of
heartbeats rewrites the buckets of its spans and, where heartbeats come late, the later ones whose
carry may change.  Nothing that a usual batch reads grows with the history but the manifest (a row of two
numbers per bucket).

All points are kept, not only changes of drift: a late heartbeat splits the interval that it falls into,
and the drift behind it is that of the next point, which may repeat the value before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.operators.drift import DEFAULT_DRIFT_MS
from fleetlake.streaming.bucket_state import BucketState

POINTS = "device_id string, from_ms long, session_id string, drift_ms long, is_carry boolean"
HEARTBEATS_MARK = "heartbeats"


class DriftState:
    def __init__(self, root: str, slots: int = 64, span_ms: int = 3_600_000):
        self.state = BucketState(root)
        self.slots, self.span_ms = slots, span_ms

    def _slot(self) -> Column:
        return F.pmod(F.hash("device_id"), F.lit(self.slots)).cast("long")

    def _span(self, ms: Column) -> Column:
        return F.floor(ms / F.lit(self.span_ms)).cast("long")

    def _bucket(self) -> Column:
        return (F.col("span") * F.lit(self.slots) + F.col("slot")).alias("bucket")

    def _held(self, spark: SparkSession, version: int | None) -> DataFrame:
        """(slot, span) of all buckets there are."""
        slot = F.pmod(F.col("bucket"), F.lit(self.slots))
        return self.state.manifest(spark, "points", version).select(slot.alias("slot"), ((F.col("bucket") - slot) / F.lit(self.slots)).cast("long").alias("span"))

    @staticmethod
    def _latest(rows: DataFrame, *keys: str) -> DataFrame:
        """One point per key, device and instant: the last by session and drift."""
        best = rows.groupBy(*keys, "device_id", "from_ms").agg(F.max(F.struct("session_id", "drift_ms")).alias("p"))
        return best.select(*keys, "device_id", "from_ms", "p.session_id", "p.drift_ms")

    def apply(self, spark: SparkSession, heartbeats: DataFrame, batch_id: int | None = None) -> int:
        """Fold heartbeats in; a batch that is already in is skipped.  Rows without device or time
        are left out.  Returns the version."""
        newest = self.state.newest(spark) or {}
        before = newest.get("version")
        if batch_id is not None and newest.get(HEARTBEATS_MARK, -1) >= batch_id:
            return before
        version = 0 if before is None else before + 1
        delta = heartbeats.filter(F.col("device_id").isNotNull() & F.col("server_ts_ms").isNotNull()).select(
            self._slot().alias("slot"),
            self._span(F.col("server_ts_ms")).alias("span"),
            "device_id",
            F.col("server_ts_ms").cast("long").alias("from_ms"),
            "session_id",
            F.coalesce(F.col("estimated_drift_ms"), F.lit(DEFAULT_DRIFT_MS)).cast("long").alias("drift_ms"),
        )
        delta = self.state.write_whole(self._latest(delta, "slot", "span"), "delta", version)
        first = delta.groupBy("slot").agg(F.min("span").alias("first"))
        held = self._held(spark, before).join(first, "slot")
        later = held.filter("span >= first").select("slot", "span")
        previous = held.filter("span < first").groupBy("slot").agg(F.max("span").alias("span"))
        affected = later.unionByName(delta.select("slot", "span")).distinct()
        old = self.state.read(spark, "points", POINTS, before, later.unionByName(previous).select(self._bucket()))
        slot = F.pmod(F.col("bucket"), F.lit(self.slots))
        old = old.withColumns({"slot": slot, "span": ((F.col("bucket") - slot) / F.lit(self.slots)).cast("long")})
        named = old.join(previous.select("slot", F.col("span").alias("previous")), "slot", "left")
        own = named.filter("not is_carry and (previous is null or span > previous)").select("slot", "span", "device_id", "from_ms", "session_id", "drift_ms")
        own = self._latest(own.unionByName(delta), "slot", "span")
        # what the devices bring from before: the previous bucket's points and its own carries
        brought = named.filter("span = previous").select("slot", "span", "device_id", "from_ms", "session_id", "drift_ms")
        point = F.struct("from_ms", "session_id", "drift_ms")
        lasts = own.unionByName(brought).groupBy("slot", "device_id", "span").agg(F.max(point).alias("last"))
        grid = lasts.select("slot", "device_id").distinct().join(affected, "slot").select("slot", "device_id", "span")
        along = grid.unionByName(lasts.select("slot", "device_id", "span")).distinct().join(lasts, ["slot", "device_id", "span"], "left")
        earlier = Window.partitionBy("slot", "device_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
        carries = along.withColumn("carry", F.last("last", ignorenulls=True).over(earlier)).filter("carry is not null").join(affected, ["slot", "span"], "left_semi")
        columns = [self._bucket(), "device_id"]
        new = own.select(*columns, "from_ms", "session_id", "drift_ms", F.lit(False).alias("is_carry")).unionByName(
            carries.select(*columns, "carry.from_ms", "carry.session_id", "carry.drift_ms", F.lit(True).alias("is_carry"))
        )
        self.state.write(new.select("device_id", "from_ms", "session_id", "drift_ms", "is_carry", "bucket"), "points", version, before)
        self.state.commit(spark, version, {HEARTBEATS_MARK: batch_id} if batch_id is not None else {})
        return version

    def buckets_of(self, spark: SparkSession, spans: DataFrame, version: int | None) -> DataFrame:
        """(slot, span, bucket): the bucket that tells the drift in each (slot, span) of ``spans``; null
        before a slot's first heartbeat."""
        asked = spans.select("slot", "span", F.lit(1).alias("kind"))
        rows = self._held(spark, version).select("slot", "span", F.lit(0).alias("kind")).unionByName(asked)
        held = F.last(F.when(F.col("kind") == 0, F.col("span")), ignorenulls=True).over(Window.partitionBy("slot").orderBy("span", "kind"))
        return rows.withColumn("in", held).filter("kind = 1").select("slot", "span", (F.col("in") * F.lit(self.slots) + F.col("slot")).alias("bucket"))

    def asof_drift(self, df: DataFrame, ts_col: str = "event_ts_edge_ms") -> DataFrame:
        """J8 over all heartbeats applied so far: ``df`` with ``drift_ms`` of the last heartbeat of the
        device at or before ``ts_col`` (null when none).  Rows without device or time skip the join."""
        spark = df.sparkSession
        version = (self.state.newest(spark) or {}).get("version")
        ts = F.col(ts_col)
        has_key = F.col("device_id").isNotNull() & ts.isNotNull()
        if version is None:
            return df.withColumn("drift_ms", F.lit(None).cast("long"))
        keyed = df.filter(has_key).withColumns({"_slot": self._slot(), "_span": self._span(ts)})
        spans = keyed.select(F.col("_slot").alias("slot"), F.col("_span").alias("span")).distinct()
        # a row per (slot, span) of the batch
        at = self.buckets_of(spark, spans, version)
        points = self.state.read(spark, "points", POINTS, version, at.filter("bucket is not null"))
        until = F.lead("from_ms").over(Window.partitionBy("bucket", "device_id").orderBy("from_ms"))
        found = points.select("bucket", F.col("device_id").alias("_device"), "from_ms", until.alias("until_ms"), "drift_ms")
        placed = keyed.join(at.select(F.col("slot").alias("_slot"), F.col("span").alias("_span"), F.col("bucket").alias("_bucket")), ["_slot", "_span"], "left")
        holds = (F.col("_bucket") == F.col("bucket")) & (F.col("device_id") == F.col("_device")) & (ts >= F.col("from_ms")) & (F.col("until_ms").isNull() | (ts < F.col("until_ms")))
        out = placed.join(found, holds, "left").select(*df.columns, "drift_ms")
        return out.unionByName(df.filter(~has_key).withColumn("drift_ms", F.lit(None).cast("long")))
