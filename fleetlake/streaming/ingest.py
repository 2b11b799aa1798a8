"""Structured Streaming ingest: topics -> bronze tables.

Each topic is one streaming query with its own checkpoint (W3/W4).  A
micro-batch is decoded, validated, drift-corrected against the heartbeat
table *as it is when the batch runs* (W7 - heartbeats are data, read per
batch, not a driver-side dict), stamped with ingest columns and written
through the idempotent batch writer (accepted + rejected + batch log).

No watermark is applied on ingest (W6): a late event lands in its own old
hour partition and is compacted later; nothing is dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from fleetlake import sinks
from fleetlake.functions import rules
from fleetlake.operators import drift as drift_ops
from fleetlake.operators import validate
from fleetlake.schemas import (
    BLOB_INDEX_COLUMNS,
    BLOB_INDEX_SCHEMA,
    HEARTBEAT_SCHEMA,
    MANIFEST_SCHEMA,
    TELEMETRY_BRONZE_SCHEMA,
    TELEMETRY_COLUMNS,
    TELEMETRY_SCHEMA,
)
from fleetlake.sources.topics import decode_payload, heartbeat_source, read_topic_stream
from fleetlake.streaming.drift_state import DriftState


# ------------------------------------------------------------------ per-batch transforms
def add_ingest_columns(df: DataFrame, status: str | None = rules.STATUS_PENDING, clock: Column | None = None) -> DataFrame:
    """``ingest_ts`` (injectable clock, default ``current_timestamp()``) and status."""
    out = df.withColumn("ingest_ts", clock if clock is not None else F.current_timestamp())
    if status is not None:
        out = out.withColumn("ingest_status", F.lit(status))
    return out


def _to_bronze(decoded: DataFrame, drift: DataFrame | None, ts_col: str, out_col: str, status: str | None, columns: list[str],
               clock: Column | None) -> DataFrame:
    if "drift_ms" not in decoded.columns:
        decoded = decoded.join(drift, "device_id", "left") if drift is not None else decoded.withColumn("drift_ms", F.lit(None).cast("long"))
    out = add_ingest_columns(drift_ops.apply_drift(decoded, "drift_ms", ts_col, out_col), status, clock)
    return out.select(*columns, *[c for c in ("is_valid", "errors") if c in out.columns])


def to_bronze_telemetry(decoded: DataFrame, drift: DataFrame | None, clock: Column | None = None) -> DataFrame:
    """W1 transform: drift-correct, stamp, project bronze columns (+ check columns if present).

    ``drift``: the per-device table (device_id, drift_ms); rows that already
    carry ``drift_ms`` (as-of lookup) keep it.  ``drift_source`` tells a
    corrected row from one that got the default.
    """
    return _to_bronze(decoded, drift, "event_ts_edge_ms", "event_ts_corrected", rules.STATUS_PENDING, TELEMETRY_COLUMNS, clock)


def to_bronze_manifest(decoded: DataFrame, drift: DataFrame | None, clock: Column | None = None) -> DataFrame:
    """W2 transform: same for manifests, no status column."""
    return _to_bronze(decoded, drift, "blob_ts_edge_ms", "blob_ts_corrected", None, BLOB_INDEX_COLUMNS, clock)


# ------------------------------------------------------------------ queries
@dataclass
class IngestPaths:
    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def rejects(self, name: str) -> str:
        return f"{self.root}/rejects/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    @property
    def batch_log(self) -> str:
        return f"{self.root}/tables/_batch_log"

    @property
    def drift_points(self) -> str:
        return f"{self.root}/tables/drift_points"

    @property
    def drift_state(self) -> str:
        return f"{self.root}/tables/drift_state"


HEARTBEATS, DRIFT_STATE = "heartbeats", "drift_state"

# The tables as they are read: declared, so that a table without a row yet is an empty one.
_LAYOUT = [StructField("p_hour", TimestampType()), StructField("p_bucket", IntegerType()), StructField("commit_id", StringType())]
TABLE_SCHEMAS = {
    "telemetry_events": StructType(TELEMETRY_BRONZE_SCHEMA.fields + _LAYOUT),
    "blob_index": StructType(BLOB_INDEX_SCHEMA.fields + _LAYOUT),
    HEARTBEATS: StructType(HEARTBEAT_SCHEMA.fields + _LAYOUT[2:]),
}


def committed_heartbeats(spark: SparkSession, paths: IngestPaths) -> DataFrame | None:
    """All heartbeats the heartbeat stream has committed (None before the first)."""
    return sinks.read_committed(spark, paths.table(HEARTBEATS), paths.batch_log, HEARTBEATS, TABLE_SCHEMAS[HEARTBEATS])


def _batch_writer(kind: str, paths: IngestPaths, validated: bool, clock: Column | None, drift_mode: str | None):
    schema = TELEMETRY_SCHEMA if kind == "telemetry_events" else MANIFEST_SCHEMA
    to_bronze = to_bronze_telemetry if kind == "telemetry_events" else to_bronze_manifest
    check = validate.validate_telemetry if kind == "telemetry_events" else validate.validate_manifest
    layout = sinks.telemetry_layout if kind == "telemetry_events" else sinks.blob_layout
    parts = sinks.TELEMETRY_PARTITIONS if kind == "telemetry_events" else sinks.BLOB_PARTITIONS
    ts_col = "event_ts_edge_ms" if kind == "telemetry_events" else "blob_ts_edge_ms"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if validated:
            dec = check(batch)
        else:
            dec = decode_payload(batch, schema).withColumn("is_valid", F.lit(True)).withColumn("errors", F.array().cast("array<string>"))
        drift = None
        dec = dec.persist()
        try:
            tagged = dec
            if drift_mode == "asof":
                # J8 per batch, exact: only the spans of time that the batch's records lie in are read
                tagged = DriftState(paths.drift_points).asof_drift(dec, ts_col)
            elif drift_mode == "latest":
                drift = read_drift_state(spark, paths)
            rows = layout(to_bronze(tagged, drift, clock))
            sinks.write_batch_with_rejects(rows, batch_id, paths.table(kind), paths.rejects(kind), paths.batch_log, parts, kind)
        finally:
            dec.unpersist()

    return run


def dedup_stream(src: DataFrame, ts_field: str, delay: str) -> DataFrame:
    """Optional: drop messages whose event_id was already seen, with state
    bounded by a watermark on the edge time.  Messages without an id or a
    numeric time are passed through untouched (validation rejects them)."""
    eid = F.get_json_object(F.col("value").cast("string"), "$.event_id")
    ts = F.timestamp_millis(F.get_json_object(F.col("value").cast("string"), f"$.{ts_field}").try_cast("long"))
    keyed = src.select("value", eid.alias("_eid"), ts.alias("_ets"))
    ok = keyed.filter(F.col("_eid").isNotNull() & F.col("_ets").isNotNull())
    rest = keyed.filter(F.col("_eid").isNull() | F.col("_ets").isNull())
    deduped = ok.withWatermark("_ets", delay).dropDuplicatesWithinWatermark(["_eid"])
    return deduped.select("value").unionByName(rest.select("value"))


def start_table_stream(
    spark: SparkSession,
    kind: str,
    paths: IngestPaths,
    source_path: str | None = None,
    bootstrap: str | None = None,
    topic: str | None = None,
    drift_mode: str | None = "latest",
    validated: bool = True,
    trigger: dict | None = None,
    clock: Column | None = None,
    max_files_per_trigger: int | None = None,
    dedup_within: str | None = None,
) -> StreamingQuery:
    """W1 (kind='telemetry_events') / W2 (kind='blob_index'): one query, own checkpoint.

    The source is a directory of messages (``source_path``) or a topic of a
    broker (``bootstrap``; ``topic`` defaults to ``kind``).
    ``drift_mode='latest'`` applies the newest heartbeat per device committed
    when the batch runs (a live map); ``'asof'`` the heartbeat valid at each
    record's edge time (equal to the batch lookup over the same heartbeats);
    None no drift.  ``dedup_within`` (off by default: it leaves out rows that
    come later than that delay) drops repeated event ids."""
    src = read_topic_stream(spark, topic or kind, bootstrap=bootstrap, path=source_path, max_files_per_trigger=max_files_per_trigger)
    if dedup_within:
        src = dedup_stream(src, "event_ts_edge_ms" if kind == "telemetry_events" else "blob_ts_edge_ms", dedup_within)
    w = (
        src.writeStream.queryName(kind)
        .option("checkpointLocation", paths.checkpoint(kind))
        .foreachBatch(_batch_writer(kind, paths, validated, clock, drift_mode))
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


STATE_SCHEMA = "device_id string, hb struct<server_ts_ms:long,session_id:string,estimated_drift_ms:long>"


def read_drift_state(spark: SparkSession, paths: IngestPaths) -> DataFrame | None:
    """(device_id, drift_ms), one row per device, of the newest committed state;
    None before the first.  A committed state that cannot be read is an error."""
    newest = sinks.read_log(spark, paths.batch_log, DRIFT_STATE).agg(F.max("batch_id")).first()[0]
    if newest is None:
        return None
    state = spark.read.schema(STATE_SCHEMA).parquet(f"{paths.drift_state}/batch_id={newest}")
    return state.select("device_id", F.col("hb.estimated_drift_ms").alias("drift_ms"))


def _merge_drift_state(batch: DataFrame, batch_id: int, paths: IngestPaths) -> None:
    """Fold one heartbeat batch into the per-device state: newest heartbeat per
    device by (time, session, value).  The state of batch N is written to its
    own directory from the newest committed state before N and then logged, so
    a replayed batch gives the same state again."""
    spark = batch.sparkSession
    if sinks.batch_logged(spark, paths.batch_log, DRIFT_STATE, batch_id):
        return
    order = F.struct(
        "server_ts_ms", "session_id", F.coalesce(F.col("estimated_drift_ms"), F.lit(drift_ops.DEFAULT_DRIFT_MS)).alias("estimated_drift_ms")
    )
    new = batch.filter(F.col("device_id").isNotNull()).groupBy("device_id").agg(F.max(order).alias("hb"))
    before = sinks.read_log(spark, paths.batch_log, DRIFT_STATE).filter(F.col("batch_id") < batch_id).agg(F.max("batch_id")).first()[0]
    if before is not None:
        old = spark.read.schema(STATE_SCHEMA).parquet(f"{paths.drift_state}/batch_id={before}")
        new = old.unionByName(new).groupBy("device_id").agg(F.max("hb").alias("hb"))
    target = f"{paths.drift_state}/batch_id={batch_id}"
    new.write.mode("overwrite").parquet(target)
    counts = spark.read.schema(STATE_SCHEMA).parquet(target).agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("rejected"))
    sinks.log_commit(counts, paths.batch_log, DRIFT_STATE, batch_id, f"{batch_id:012d}")


def start_heartbeat_stream(
    spark: SparkSession,
    paths: IngestPaths,
    source_path: str | None = None,
    bootstrap: str | None = None,
    topic: str = "heartbeat",
    starting: str = "latest",
    trigger: dict | None = None,
) -> StreamingQuery:
    """S4 as a stream.  Each batch is committed to the heartbeat table and
    folded into the compact per-device drift state and the points by time span
    that telemetry batches read (W7).  A broker's topic is read from its latest offsets."""
    hb = heartbeat_source(read_topic_stream(spark, topic, starting=starting, bootstrap=bootstrap, path=source_path))

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("is_valid", F.lit(True)).withColumn("errors", F.array().cast("array<string>"))
        sinks.write_batch_with_rejects(rows, batch_id, paths.table(HEARTBEATS), paths.rejects(HEARTBEATS), paths.batch_log, None, HEARTBEATS)
        _merge_drift_state(batch, batch_id, paths)
        DriftState(paths.drift_points).apply(spark, batch, batch_id)

    w = hb.writeStream.queryName(HEARTBEATS).option("checkpointLocation", paths.checkpoint(HEARTBEATS)).foreachBatch(run)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_ingest(
    spark: SparkSession,
    root: str,
    telemetry_path: str | None = None,
    manifest_path: str | None = None,
    heartbeat_path: str | None = None,
    bootstrap: str | None = None,
    trigger: dict | None = None,
    validated: bool = True,
    drift_mode: str = "latest",
) -> dict[str, StreamingQuery]:
    """Independent queries (heartbeats, telemetry, manifests), no ordering
    between them.  Wait with ``spark.streams.awaitAnyTermination()`` so a
    failure of any one is noticed.  Without a path a kind is read from the
    broker's topic; heartbeats are left out when neither is given."""
    paths = IngestPaths(root)
    queries: dict[str, StreamingQuery] = {}
    if heartbeat_path is not None or bootstrap is not None:
        queries[HEARTBEATS] = start_heartbeat_stream(spark, paths, heartbeat_path, bootstrap, trigger=trigger)
    for kind, path in (("telemetry_events", telemetry_path), ("blob_index", manifest_path)):
        queries[kind] = start_table_stream(
            spark, kind, paths, path, bootstrap, drift_mode=drift_mode if queries.get(HEARTBEATS) else None, validated=validated, trigger=trigger
        )
    return queries


def read_committed(spark: SparkSession, paths: IngestPaths, kind: str) -> DataFrame:
    """Rows of committed batches only (semi join with the batch log)."""
    rows = sinks.read_committed(spark, paths.table(kind), paths.batch_log, kind, TABLE_SCHEMAS[kind])
    if rows is None:
        raise FileNotFoundError(paths.table(kind))
    return rows


def committed_since(spark: SparkSession, paths: IngestPaths, done: dict[str, int]) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Rows of the telemetry and blob batches that were committed after batch ``done[kind]``, and the
    newest batch of each kind among them.  Only the folders of these commits are read."""
    new, marks = {}, {}
    for kind in ("telemetry_events", "blob_index"):
        log = sinks.read_log(spark, paths.batch_log, kind).filter(F.col("batch_id") > done.get(kind, -1))
        todo = log.select("commit_id", "batch_id").collect()  # a row per batch since the last time
        if todo:
            found = spark.read.schema(TABLE_SCHEMAS[kind]).parquet(paths.table(kind))
            new[kind] = found.filter(F.col("commit_id").isin([r["commit_id"] for r in todo]))
            marks[kind] = max(r["batch_id"] for r in todo)
    return new, marks
