"""Deterministic bronze-shaped tables derived from the driver's ``events`` table.

The reference ships no data: its producer is an unseeded random generator.
Instead, telemetry, blob manifests and heartbeats are derived from the
driver's ``events`` rows by plain column expressions, so every query's work
grows with the input table.  The same derivation is given in DuckDB SQL
(``duckdb_ctes``) for the oracle.  Both sides were checked equal row for
row (see FIXTURES.md).

Per event row (``n`` = events.event_id):
  * heartbeat: one per device (= user) and day, drift changing per day;
  * telemetry: one row, with violations the reference generator never makes;
  * blob index: 90 % coverage, 1 % duplicated manifests, 2 % orphans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import ids, rules
from fleetlake.functions.time import add_seconds

# --- fixed values of the fixture recipe (FIXTURES.md §3) ---
SENSOR_BY_EVENT_TYPE = {"view": "joint_state", "click": "imu", "error": "unknown"}
SENSOR_DEFAULT = "force_torque"
MEDIA_BY_MOD5 = ["camera_rgb", "camera_depth", "lidar_pointcloud", "audio", "raw_sensor_dump"]
# --- end of fixed values ---
DEVICE_ID = rules.DEVICE_ID_PREFIX + "%03d"


def spread(df: DataFrame) -> DataFrame:
    """A test table that comes as one or a few files, dealt over the cores (the
    recipe's work per row is large against the row); other tables as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))


def _day(ts: Column) -> Column:
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")


def _drift(user_id: Column, day: Column) -> Column:
    return F.pmod(user_id * 37 + day * 11, F.lit(1001)) - 500


def heartbeats(events: DataFrame) -> DataFrame:
    """device_id, session_id, server_ts_ms, estimated_drift_ms (distinct per device-day)."""
    ts = F.col("ts")
    day = _day(ts)
    return events.select(
        F.format_string(DEVICE_ID, F.col("user_id")).alias("device_id"),
        F.format_string("s-%d", day).alias("session_id"),
        F.unix_millis(F.date_trunc("day", ts.cast("timestamp"))).alias("server_ts_ms"),
        _drift(F.col("user_id"), day).cast("long").alias("estimated_drift_ms"),
    ).distinct()


def telemetry(events: DataFrame, keep_n: bool = True) -> DataFrame:
    """Bronze ``telemetry_events`` rows (plus helper key ``n``)."""
    ts = F.col("ts")
    eid = F.col("event_id")
    uid = F.col("user_id")
    day = _day(ts)
    ms = F.unix_millis(ts.cast("timestamp"))
    sensor = F.coalesce(
        *[F.when(F.col("event_type") == k, F.lit(v)) for k, v in SENSOR_BY_EVENT_TYPE.items()],
        F.lit(SENSOR_DEFAULT),
    )
    cols = [
        F.format_string(DEVICE_ID + ":s-%d:%012d", uid, day, eid).alias("event_id"),
        F.format_string(DEVICE_ID, uid).alias("device_id"),
        F.format_string("s-%d", day).alias("session_id"),
        (ms + _drift(uid, day) + F.pmod(eid * 7, F.lit(41)) - 20).alias("event_ts_edge_ms"),
        sensor.alias("sensor_type"),
        ((F.pmod(eid, F.lit(1300)) - 650) / F.lit(100.0)).cast("double").alias("joint_angle"),
        ((F.pmod(eid, F.lit(400)) - 200) / F.lit(100.0)).cast("double").alias("joint_velocity"),
        (F.pmod(eid * 13, F.lit(1100)) - 550).cast("double").alias("force_x"),
        (F.pmod(eid * 17, F.lit(1040)) - 520).cast("double").alias("force_z"),
        F.when(F.pmod(eid, F.lit(97)) == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value") * 1.25 - 5)
        .alias("torque"),
        (F.pmod(eid, F.lit(20)) - 10).cast("double").alias("accel_x"),
        (F.pmod(eid, F.lit(10)) - 5).cast("double").alias("gyro_z"),
        (F.col("value") - 45).alias("temperature"),
        F.timestamp_millis(ms).alias("event_ts_corrected"),
        add_seconds(ts, F.pmod(eid, F.lit(30))).alias("ingest_ts"),
        F.lit(rules.STATUS_PENDING).alias("ingest_status"),
    ]
    if keep_n:
        cols.append(eid.alias("n"))
    return events.select(*cols)


def _blob_base(telx: DataFrame) -> DataFrame:
    n = F.col("n")
    media = F.element_at(F.array(*[F.lit(m) for m in MEDIA_BY_MOD5]), (F.pmod(n, F.lit(5)) + 1).cast("int"))
    return telx.select(
        "event_id",
        "device_id",
        "session_id",
        media.alias("media_type"),
        F.col("event_ts_edge_ms").alias("blob_ts_edge_ms"),
        (F.lit(1024) + F.pmod(n * 31, F.lit(65536))).cast("long").alias("object_size"),
        F.sha2(F.col("event_id"), 256).alias("checksum_sha256"),
        F.lit(rules.QUALITY_STATE_INGESTED).alias("quality_state"),
        F.col("event_ts_corrected").alias("blob_ts_corrected"),
        add_seconds("ingest_ts", F.pmod(n, F.lit(7))).alias("ingest_ts"),
        n,
    )


def blob_index(telx: DataFrame, keep_n: bool = True) -> DataFrame:
    """Bronze ``blob_index`` rows derived from telemetry, in bronze column order."""
    base = _blob_base(telx)
    n = F.col("n")
    # One scan: each telemetry row yields 0-3 manifest rows (covered copy,
    # duplicated copy, orphan copy with a foreign id).
    copies = F.array(
        F.when(F.pmod(n, F.lit(10)) != 3, F.lit("")),
        F.when(F.pmod(n, F.lit(100)) == 11, F.lit("")),
        F.when(F.pmod(n, F.lit(50)) == 7, F.lit("x")),
    )
    blob = (
        base.withColumn("_sfx", F.explode(F.filter(copies, lambda c: c.isNotNull())))
        .withColumn("event_id", F.concat(F.col("event_id"), F.col("_sfx")))
        .drop("_sfx")
    )
    key = ids.blob_key("media_type", "blob_ts_corrected", "device_id", "event_id")
    cols = [
        "event_id",
        "device_id",
        "session_id",
        "media_type",
        ids.blob_uri(key).alias("blob_uri"),
        "blob_ts_edge_ms",
        "object_size",
        "checksum_sha256",
        F.substring("checksum_sha256", 1, 32).alias("etag"),
        "quality_state",
        "blob_ts_corrected",
        "ingest_ts",
    ]
    if keep_n:
        cols.append("n")
    return blob.select(*cols)


class Fixture:
    """Lazily built fixture tables for one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.events = read_events(spark, sf_dir)

    @property
    def telemetry(self) -> DataFrame:
        return telemetry(self.events, keep_n=False)

    @property
    def telemetry_n(self) -> DataFrame:
        return telemetry(self.events, keep_n=True)

    @property
    def blobs(self) -> DataFrame:
        return blob_index(telemetry(self.events, keep_n=True), keep_n=False)

    @property
    def heartbeats(self) -> DataFrame:
        return heartbeats(self.events)

    @property
    def telemetry_messages(self) -> DataFrame:
        return telemetry_messages(self.telemetry_n)

    @property
    def manifest_messages(self) -> DataFrame:
        return manifest_messages(blob_index(self.telemetry_n, keep_n=True))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# DuckDB dialect of the same recipe (used only by oracle SQL strings).
# ---------------------------------------------------------------------------
_D_DAY = "cast(date_diff('day', date '1970-01-01', cast(ts as date)) as bigint)"
_D_MS = "(epoch_us(ts) // 1000)"
_D_MS0 = "epoch_ms(date_trunc('day', ts))"
_D_SHARD = "printf('%02d', cast(split_part(device_id, '-', 2) as integer) % 16)"

DUCKDB_FIXTURE_CTES = f"""
hb AS (
  SELECT DISTINCT printf('{DEVICE_ID}', user_id) AS device_id, printf('s-%d', {_D_DAY}) AS session_id,
    {_D_MS0} AS server_ts_ms,
    cast((user_id*37 + {_D_DAY}*11) % 1001 - 500 AS bigint) AS estimated_drift_ms
  FROM events
),
telx AS (
  SELECT printf('{DEVICE_ID}:s-%d:%012d', user_id, {_D_DAY}, event_id) AS event_id,
    printf('{DEVICE_ID}', user_id) AS device_id, printf('s-%d', {_D_DAY}) AS session_id,
    {_D_MS} + (user_id*37 + {_D_DAY}*11) % 1001 - 500 + event_id*7 % 41 - 20 AS event_ts_edge_ms,
    CASE event_type WHEN 'view' THEN 'joint_state' WHEN 'click' THEN 'imu'
                    WHEN 'error' THEN 'unknown' ELSE 'force_torque' END AS sensor_type,
    cast((event_id % 1300 - 650) / 100.0 AS double) AS joint_angle,
    cast((event_id % 400 - 200) / 100.0 AS double) AS joint_velocity,
    cast(event_id*13 % 1100 - 550 AS double) AS force_x,
    cast(event_id*17 % 1040 - 520 AS double) AS force_z,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE value*1.25 - 5 END AS torque,
    cast(event_id % 20 - 10 AS double) AS accel_x,
    cast(event_id % 10 - 5 AS double) AS gyro_z,
    value - 45 AS temperature,
    make_timestamp({_D_MS} * 1000) AS event_ts_corrected,
    ts + to_seconds(event_id % 30) AS ingest_ts,
    'PENDING_BLOB_LINK' AS ingest_status,
    event_id AS n
  FROM events
),
blobbase AS (
  SELECT event_id, device_id, session_id,
    CASE n % 5 WHEN 0 THEN 'camera_rgb' WHEN 1 THEN 'camera_depth' WHEN 2 THEN 'lidar_pointcloud'
               WHEN 3 THEN 'audio' ELSE 'raw_sensor_dump' END AS media_type,
    event_ts_edge_ms AS blob_ts_edge_ms, cast(1024 + n*31 % 65536 AS bigint) AS object_size,
    sha256(event_id) AS checksum_sha256, 'INGESTED' AS quality_state,
    event_ts_corrected AS blob_ts_corrected, ingest_ts + to_seconds(n % 7) AS ingest_ts, n
  FROM telx
),
blob0 AS (
  SELECT * FROM blobbase WHERE n % 10 <> 3
  UNION ALL SELECT * FROM blobbase WHERE n % 100 = 11
  UNION ALL SELECT event_id || 'x', device_id, session_id, media_type, blob_ts_edge_ms, object_size,
    checksum_sha256, quality_state, blob_ts_corrected, ingest_ts, n FROM blobbase WHERE n % 50 = 7
),
blob AS (
  SELECT event_id, device_id, session_id, media_type,
    's3://raw-blobs/blob/' || media_type || '/event_date=' || strftime(blob_ts_corrected, '%Y-%m-%d')
      || '/event_hour=' || strftime(blob_ts_corrected, '%H') || '/{rules.BLOB_KEY_SHARD}' || {_D_SHARD}
      || '/{rules.BLOB_KEY_DEVICE}' || device_id || '/' || event_id || '.bin' AS blob_uri,
    blob_ts_edge_ms, object_size, checksum_sha256, substring(checksum_sha256, 1, 32) AS etag,
    quality_state, blob_ts_corrected, ingest_ts, n
  FROM blob0
)
"""


def duckdb_with(body: str, extra_ctes: str = "") -> str:
    """``WITH <fixture ctes>[, extra] <body>`` for an oracle query."""
    ctes = DUCKDB_FIXTURE_CTES.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


# ---------------------------------------------------------------------------
# Wire messages: the fixture rows serialised as JSON, as a topic would carry
# them, with structural faults the typed tables cannot hold.
# ---------------------------------------------------------------------------
def telemetry_messages(telx: DataFrame) -> DataFrame:
    """``value`` (JSON text) per telemetry row, plus helper ``n``.

    n % 223 == 0: event_id absent; n % 199 == 0: non-numeric edge time;
    n % 211 == 0: truncated (broken) JSON.
    """
    from fleetlake.schemas import TELEMETRY_SCHEMA, wire_name

    n = F.col("n")
    fields = [
        F.when(F.pmod(n, F.lit(223)) == 0, F.lit(None).cast("string")).otherwise(F.col("event_id")).alias("event_id")
        if f.name == "event_id"
        else F.col(f.name).alias(wire_name(f.name))
        for f in TELEMETRY_SCHEMA.fields
    ]
    # One projection per rewrite step: each step references the previous
    # text twice, and separate projections keep the plan linear in size.
    v = telx.select(F.to_json(F.struct(*fields)).alias("v"), n)
    v = v.select(
        F.when(
            F.pmod(n, F.lit(199)) == 0,
            F.regexp_replace("v", '"event_ts_edge_ms":-?[0-9]+', '"event_ts_edge_ms":"not-a-number"'),
        )
        .otherwise(F.col("v"))
        .alias("v"),
        n,
    )
    return v.select(F.when(F.pmod(n, F.lit(211)) == 0, F.substring("v", 1, 40)).otherwise(F.col("v")).alias("value"), n)


def manifest_messages(blob: DataFrame) -> DataFrame:
    """``value`` per blob-index row, plus ``n``.

    n % 13 == 0: unknown media type; n % 17 == 0: 63-char checksum;
    n % 19 == 0: http:// URI; n % 29 == 0: checksum absent.
    """
    from fleetlake.schemas import MANIFEST_SCHEMA, wire_name

    n = F.col("n")
    over = {
        "media_type": F.when(F.pmod(n, F.lit(13)) == 0, F.lit("thermal")).otherwise(F.col("media_type")),
        "checksum_sha256": F.when(F.pmod(n, F.lit(29)) == 0, F.lit(None).cast("string"))
        .when(F.pmod(n, F.lit(17)) == 0, F.substring("checksum_sha256", 1, 63))
        .otherwise(F.col("checksum_sha256")),
        "blob_uri": F.when(F.pmod(n, F.lit(19)) == 0, F.regexp_replace("blob_uri", "^s3://", "http://")).otherwise(
            F.col("blob_uri")
        ),
    }
    fields = [over.get(f.name, F.col(f.name)).alias(wire_name(f.name)) for f in MANIFEST_SCHEMA.fields]
    return blob.select(F.to_json(F.struct(*fields)).alias("value"), n)
