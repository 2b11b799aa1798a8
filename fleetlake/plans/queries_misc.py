"""Registered queries for identifiers, formats, schema evolution, replay,
as-of reads and late-arrival stamping (P15, P16, P24, P25, K7, S6, S11, J1')."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import sinks
from fleetlake.functions import ids, rules
from fleetlake.functions.formats import format_size
from fleetlake.operators import drift, maintenance, quality
from fleetlake.plans.queries_drift import _D_LATEST
from fleetlake.plans.queries_linkage import NOW_D, fixture_now
from fleetlake.plans.registry import register
from fleetlake.schemas import TELEMETRY_SCHEMA
from fleetlake.sources import tables
from fleetlake.sources.fixtures import Fixture, duckdb_with
from fleetlake.session import shared_path
from fleetlake.sources.topics import decode_payload

_D_SHARD = "printf('%02d', cast(split_part(device_id, '-', 2) AS integer) % 16)"


@register(
    "blob_key",
    duckdb_with(
        f"""
SELECT event_id, {_D_SHARD} AS device_shard,
  'blob/' || media_type || '/event_date=' || strftime(blob_ts_corrected, '%Y-%m-%d') || '/event_hour='
    || strftime(blob_ts_corrected, '%H') || '/{rules.BLOB_KEY_SHARD}' || {_D_SHARD} || '/{rules.BLOB_KEY_DEVICE}' || device_id || '/'
    || event_id || '.bin' AS blob_key
FROM blob
"""
    ),
)
def q_blob_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Fixture(spark, sf_dir).blobs
    return b.select(
        "event_id",
        ids.device_shard("device_id").alias("device_shard"),
        ids.blob_key("media_type", "blob_ts_corrected", "device_id", "event_id").alias("blob_key"),
    )


@register(
    "parse_event_id",
    duckdb_with(
        """
SELECT event_id, split_part(event_id, ':', 1) AS device_id, split_part(event_id, ':', 2) AS session_id,
  cast(split_part(event_id, ':', 3) AS bigint) AS counter,
  printf('%s:%s:%012d', split_part(event_id, ':', 1), split_part(event_id, ':', 2),
         cast(split_part(event_id, ':', 3) AS bigint)) = event_id AS round_trip
FROM telx
"""
    ),
)
def q_parse_event_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Fixture(spark, sf_dir).telemetry.select("event_id", ids.parse_event_id("event_id").alias("p"))
    return t.select(
        "event_id",
        "p.device_id",
        "p.session_id",
        "p.counter",
        (ids.make_event_id("p.device_id", "p.session_id", "p.counter") == F.col("event_id")).alias("round_trip"),
    )


def _d_fmt(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 1048576 THEN printf('%.1f MB', {x} / 1048576.0) "
        f"WHEN {x} >= 1024 THEN printf('%.1f KB', {x} / 1024.0) ELSE cast({x} AS varchar) || ' B' END"
    )


@register(
    "blob_volume_by_media",
    duckdb_with(
        f"""
SELECT media_type, total_bytes, {_d_fmt('total_bytes')} AS total_size, {_d_fmt('min_bytes')} AS min_size,
  {_d_fmt('max_bytes')} AS max_size
FROM (SELECT media_type, cast(sum(object_size) AS bigint) AS total_bytes, min(object_size) AS min_bytes,
        max(object_size) AS max_bytes FROM blob GROUP BY media_type)
"""
    ),
)
def q_blob_volume_by_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P24 over blob volumes per media type."""
    b = Fixture(spark, sf_dir).blobs
    agg = b.groupBy("media_type").agg(
        F.sum("object_size").cast("long").alias("total_bytes"),
        F.min("object_size").alias("min_bytes"),
        F.max("object_size").alias("max_bytes"),
    )
    return agg.select(
        "media_type",
        "total_bytes",
        format_size(F.col("total_bytes")).alias("total_size"),
        format_size(F.col("min_bytes")).alias("min_size"),
        format_size(F.col("max_bytes")).alias("max_size"),
    )


_CUTOVER = "2024-01-15 00:00:00"


@register(
    "schema_evolution",
    duckdb_with(
        f"""
SELECT firmware_version, count(*) AS n_rows, min(ingest_ts) AS first_ingest FROM (
  SELECT ingest_ts, CASE WHEN ingest_ts >= TIMESTAMP '{_CUTOVER}' THEN 'fw-' || cast(n % 3 AS varchar) END
    AS firmware_version
  FROM telx)
GROUP BY firmware_version
"""
    ),
)
def q_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: rows written before a column was added read NULL after the union."""
    t = Fixture(spark, sf_dir).telemetry_n
    cut = F.lit(_CUTOVER).cast("timestamp")
    old = t.filter(F.col("ingest_ts") < cut).drop("n")
    new = t.filter(F.col("ingest_ts") >= cut).withColumn(
        "firmware_version", F.concat(F.lit("fw-"), F.pmod(F.col("n"), F.lit(3)).cast("string"))
    ).drop("n")
    old = sinks.add_column_if_missing(old, "schema_note", "string")  # an added column nobody fills
    evolved = sinks.union_evolved([old, new])
    return evolved.groupBy("firmware_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ingest_ts").alias("first_ingest")
    )


@register(
    "read_as_of",
    duckdb_with(
        f"""
SELECT sensor_type, count(*) AS n_rows, max(ingest_ts) AS last_ingest FROM telx
WHERE ingest_ts <= {NOW_D} - INTERVAL 7 DAY GROUP BY sensor_type
"""
    ),
)
def q_read_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as of a week before the newest row."""
    f = Fixture(spark, sf_dir)
    snap = tables.read_as_of(f.telemetry, fixture_now(f) - F.expr("INTERVAL 7 DAYS"))
    return snap.groupBy("sensor_type").agg(F.count(F.lit(1)).alias("n_rows"), F.max("ingest_ts").alias("last_ingest"))


@register(
    "replay_window",
    duckdb_with(
        f"""
SELECT CASE WHEN t.n % 223 = 0 THEN NULL ELSE t.event_id END AS event_id, t.device_id, d.drift_ms,
  make_timestamp((t.event_ts_edge_ms - coalesce(d.drift_ms, 0)) * 1000) AS event_ts_corrected
FROM telx t LEFT JOIN hb_latest d ON t.device_id = d.device_id
WHERE t.n % 211 <> 0 AND t.n % 199 <> 0
  AND t.event_ts_edge_ms >= epoch_ms(TIMESTAMP '2024-01-10 00:00:00')
  AND t.event_ts_edge_ms < epoch_ms(TIMESTAMP '2024-01-11 00:00:00')
""",
        _D_LATEST,
    ),
)
def q_replay_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-ingest a half-open window of retained messages through the same transform."""
    f = Fixture(spark, sf_dir)
    decoded = decode_payload(f.telemetry_messages, TELEMETRY_SCHEMA)
    window = tables.replay_window(decoded, start="2024-01-10 00:00:00", end="2024-01-11 00:00:00")
    fixed = drift.correct_drift(window, f.heartbeats)
    return fixed.select("event_id", "device_id", "drift_ms", "event_ts_corrected")


@register(
    "late_arrivals",
    duckdb_with(
        """
SELECT CASE WHEN date_trunc('hour', event_ts_corrected) < date_trunc('hour', ingest_ts) THEN 'LATE'
            ELSE 'ON_TIME' END AS stamp_kind, count(*) AS n_rows
FROM telx GROUP BY 1
"""
    ),
)
def q_late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P25: rows whose event hour is earlier than their ingest hour."""
    t = Fixture(spark, sf_dir).telemetry
    return t.groupBy(quality.stamp_kind().alias("stamp_kind")).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "cross_layer_recent",
    duckdb_with(
        """
SELECT t.device_id, t.event_id, t.sensor_type, t.joint_angle, t.temperature, t.event_ts_corrected,
  b.media_type, b.blob_uri, b.checksum_sha256
FROM telx t JOIN blob b ON t.event_id = b.event_id
ORDER BY t.event_ts_corrected DESC, t.event_id, b.blob_uri LIMIT 10
"""
    ),
)
def q_cross_layer_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 variant: newest by corrected event time, with sensor values."""
    from fleetlake.operators import linkage

    f = Fixture(spark, sf_dir)
    return linkage.cross_layer_join(
        f.telemetry,
        f.blobs,
        10,
        order_col="event_ts_corrected",
        telemetry_cols=["device_id", "event_id", "sensor_type", "joint_angle", "temperature", "event_ts_corrected"],
        blob_cols=["media_type", "blob_uri", "checksum_sha256"],
    )


@register(
    "file_health_inputs",
    """
SELECT * FROM (SELECT 'events' AS "table", count(*) AS total_records FROM events
  UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem),
  (VALUES (true, true)) AS t(has_files, label_fits)
""",
)
def q_file_health_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, A19, P23 over the given tables' files.  File counts and sizes are not
    visible to SQL; the rows are, and the label must follow from the sizes."""
    out = None
    for t in ("events", "orders", "lineitem"):
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
        stats = maintenance.file_stats(df).select("file_count", "avg_bytes", "total_bytes")
        small = F.when(F.col("avg_bytes") < rules.SMALL_FILE_AVG_BYTES, "SMALL_FILES").when(F.col("avg_bytes") < rules.RECOMMEND_COMPACT_AVG_BYTES, "COMPACTION_RECOMMENDED")
        row = maintenance.file_health(df, t).crossJoin(stats).select(  # one row each
            "table",
            "total_records",
            ((F.col("files") > 0) & (F.col("total_bytes") > 0)).alias("has_files"),
            (F.col("assessment") == F.coalesce(small, F.lit("OK"))).alias("label_fits"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@register(
    "partition_stats_events",
    duckdb_with(
        """
SELECT date_trunc('day', event_ts_corrected) AS p_day, count(*) AS record_count, true AS one_place
FROM telx GROUP BY ALL
"""
    ),
)
def q_partition_stats_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 on bronze telemetry written by day: a partition's files and bytes are its own."""
    tel = Fixture(spark, sf_dir).telemetry.withColumn("p_day", F.date_trunc("day", "event_ts_corrected"))
    root = shared_path(spark, f"partition-stats-{uuid.uuid4().hex}")
    sinks.materialize(tel, path=root, partition_cols=["p_day"])
    table = spark.read.parquet(root)
    whole = maintenance.file_stats(table).select(F.col("total_bytes").alias("all_bytes"), F.col("file_count").alias("all_files"))
    stats = maintenance.partition_stats(table, ["p_day"])
    sums = stats.agg(F.sum("total_bytes").alias("b"), F.sum("file_count").alias("f")).crossJoin(whole)  # one row each
    fits = sums.select((F.col("b") == F.col("all_bytes")) & (F.col("f") == F.col("all_files"))).scalar()
    return stats.select("p_day", "record_count", ((F.col("file_count") > 0) & fits).alias("one_place"))
