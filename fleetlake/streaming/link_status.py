"""Link status of telemetry as a stream of changes that can be taken back.

Telemetry and manifests meet in a state per event id.  A row is PENDING when it comes, ORPHANED when its
timeout passes without a manifest, and LINKED when the manifest is there, however late and in
whatever order.  A status only rises (PENDING, ORPHANED, LINKED), so the last status of a row is the
highest that was emitted for it (``last_status``), also after a batch is run again.

The clock is that of the processing: no row is late, and none is dropped.  The state of an id ends a
fixed time after its last message (``retain_minutes``), which bounds the state by the rate of ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlake.functions import rules

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "event_id string, device_id string, ingest_ts timestamp, n long, ingest_status string, changed_at timestamp"
#: Keys that rows without an id are dealt to; they never link.
NO_ID_KEYS = 1024
_RANK = {rules.STATUS_PENDING: 0, rules.STATUS_ORPHANED: 1, rules.STATUS_LINKED: 2}


def _processor(timeout_us: int, retain_us: int, pending: str, orphaned: str, linked: str):
    """The stateful processor; a local class, so that executors need not have this package."""
    import datetime as dt

    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)

    def micros(ts) -> int:
        return (ts.astimezone(dt.timezone.utc) - epoch) // dt.timedelta(microseconds=1)

    def stamp(us: int) -> dt.datetime:
        return (epoch + dt.timedelta(microseconds=us)).astimezone().replace(tzinfo=None)

    class LinkStatus(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.blob = handle.getValueState("blob", "has_blob boolean, last_us long")
            # the id's rows that are not linked, by device and ingest time: how many, and whether orphaned
            self.open = handle.getMapState("open", "device_id string, us long", "event_id string, n long, is_orphan boolean")

        def _emit(self, event_id, device, us, n, status, now):
            return Row(event_id=event_id, device_id=device, ingest_ts=None if us is None else stamp(us), n=n, ingest_status=status, changed_at=stamp(now))

        def handleInputRows(self, key, rows, timerValues):
            now = timerValues.getCurrentProcessingTimeInMs() * 1000
            has_blob = self.blob.exists() and self.blob.get()[0]
            arrived_blob, arrived = False, {}
            for r in rows:
                if r.is_blob:
                    arrived_blob = True
                else:
                    at = (r.device_id, None if r.ingest_ts is None else micros(r.ingest_ts))
                    event, n = arrived.get(at, (r.event_id, 0))
                    arrived[at] = (event, n + 1)
            self.blob.update((has_blob or arrived_blob, now))
            self.handle.registerTimer((now + retain_us) // 1000 + 1)
            if arrived_blob and not has_blob:
                for (device, us), (event, n, _) in list(self.open.iterator()):
                    yield self._emit(event, device, us, n, linked, now)
                self.open.clear()
            if has_blob or arrived_blob:
                for (device, us), (event, n) in arrived.items():
                    yield self._emit(event, device, us, n, linked, now)
                return
            for (device, us), (event, n) in arrived.items():
                late = us is not None and us < now - timeout_us
                held = self.open.getValue((device, us)) if self.open.containsKey((device, us)) else (event, 0, False)
                self.open.updateValue((device, us), (event, held[1] + n, held[2] or late))
                if us is not None and not late:
                    self.handle.registerTimer((us + timeout_us) // 1000 + 1)
                yield self._emit(event, device, us, held[1] + n, orphaned if late else pending, now)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = timerValues.getCurrentProcessingTimeInMs() * 1000
            if not self.blob.exists():
                return
            has_blob, last = self.blob.get()
            for (device, us), (event, n, is_orphan) in list(self.open.iterator()):
                if us is not None and us < now - timeout_us and not is_orphan:
                    self.open.updateValue((device, us), (event, n, True))
                    yield self._emit(event, device, us, n, orphaned, now)
            if last + retain_us < now:
                self.blob.clear()
                self.open.clear()

        def close(self) -> None:
            pass

    return LinkStatus()


def link_status_changes(
    telemetry: DataFrame,
    blobs: DataFrame,
    timeout_minutes: float = rules.ORPHAN_TIMEOUT_MINUTES,
    retain_minutes: float = 7 * 24 * 60,
) -> DataFrame:
    """Streaming (event_id, device_id, ingest_ts, n, ingest_status, changed_at): a row for each change of
    the status of the ``n`` telemetry rows of an id, device and ingest time.  Repeated rows raise
    ``n``.  Telemetry without an id is dealt over many keys and never links; manifests without one are
    left out.  Rows without an ingest time stay PENDING until they link.  A manifest that comes
    more than ``retain_minutes`` after the last message of its id finds no state; the batch
    ``assign_link_status`` then tells.  Needs the RocksDB state store (``start_link_status`` sets it)."""
    salt = F.concat(F.lit("\x00"), F.pmod(F.xxhash64("device_id", "ingest_ts"), F.lit(NO_ID_KEYS)).cast("string"))
    t = telemetry.select(
        F.coalesce(F.col("event_id"), salt).alias("key"), F.lit(False).alias("is_blob"), "event_id", F.col("device_id").cast("string").alias("device_id"), F.col("ingest_ts").cast("timestamp").alias("ingest_ts")
    )
    none = F.lit(None)
    b = blobs.filter(F.col("event_id").isNotNull()).select(
        F.col("event_id").alias("key"), F.lit(True).alias("is_blob"), "event_id", none.cast("string").alias("device_id"), none.cast("timestamp").alias("ingest_ts")
    )
    tool = _processor(int(timeout_minutes * 60e6), int(retain_minutes * 60e6), rules.STATUS_PENDING, rules.STATUS_ORPHANED, rules.STATUS_LINKED)
    return t.unionByName(b).groupBy("key").transformWithState(statefulProcessor=tool, outputStructType=CHANGES, outputMode="Append", timeMode="ProcessingTime")


def start_link_status(telemetry: DataFrame, blobs: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **bounds) -> StreamingQuery:
    """Append the changes to ``path`` (Parquet; each batch commits as a whole)."""
    telemetry.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    w = link_status_changes(telemetry, blobs, **bounds).writeStream.format("parquet").queryName("link_status").outputMode("append")
    w = w.option("path", path).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def last_status(changes: DataFrame) -> DataFrame:
    """(event_id, device_id, ingest_ts, n, ingest_status): the newest status of every row."""
    rank = F.create_map(*[x for s, r in _RANK.items() for x in (F.lit(s), F.lit(r))])
    top = F.max(F.struct(rank[F.col("ingest_status")].alias("r"), F.col("ingest_status").alias("ingest_status")))
    return (
        changes.groupBy("event_id", "device_id", "ingest_ts")
        .agg(F.max("n").alias("n"), top.alias("top"))
        .select("event_id", "device_id", "ingest_ts", "n", F.col("top.ingest_status").alias("ingest_status"))
    )
