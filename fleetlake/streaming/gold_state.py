"""Hourly gold models kept up to date, late rows included.

A windowed stream drops a row behind its watermark.  Here each hour is kept as partial aggregates
that merge (count, sum, minimum, maximum), in one bucket per hour or day; a batch adds its own
partials and rewrites only the hours (days) that its rows fall into, whenever they arrive.  The models
read off the state equal the batch models over the same rows; averages to the last bits, since sums of
doubles depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.time import hour_bucket
from fleetlake.plans import gold, silver
from fleetlake.streaming import ingest
from fleetlake.streaming.bucket_state import BucketState

#: Columns of A2 that are averaged; a partial keeps their number and sum.
AVERAGED = ("torque", "temperature", "joint_angle")
STATS = (
    "device_id string, hour_bucket timestamp, sensor_type string, event_count long, "
    + ", ".join(f"n_{c} long, sum_{c} double" for c in AVERAGED)
    + ", max_torque double, max_temperature double, first_event timestamp, last_event timestamp"
)
STATUS_COUNTS = ("total_telemetry", "linked_count", "pending_count", "orphaned_count")
STATUS = "hour_bucket timestamp, " + ", ".join(f"{c} long" for c in STATUS_COUNTS)
VOLUME_COUNTS = ("total_blobs", "total_blob_bytes")
VOLUME = "hour_bucket timestamp, " + ", ".join(f"{c} long" for c in VOLUME_COUNTS)


def _bucket(hour: Column, hours: int) -> Column:
    """Number of a span of so many hours; rows without a time are a span of their own."""
    return F.coalesce(F.floor(F.unix_seconds(hour.cast("timestamp")) / F.lit(3600 * hours)), F.lit(-(2**40))).cast("long")


class GoldState:
    """``hours``: how many hours share a bucket of A2; those of A3 and A4 take 24 times as many."""

    def __init__(self, root: str, hours: int = 1):
        self.state, self.hours = BucketState(root), hours

    @staticmethod
    def _stats(telemetry: DataFrame) -> DataFrame:
        valid = silver.telemetry_validated(telemetry).filter(F.col("quality_flag") == "VALID")
        return valid.groupBy("device_id", hour_bucket("event_ts_corrected").cast("timestamp").alias("hour_bucket"), "sensor_type").agg(
            F.count(F.lit(1)).alias("event_count"),
            *[e for c in AVERAGED for e in (F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}"))],
            F.max("torque").alias("max_torque"),
            F.max("temperature").alias("max_temperature"),
            F.min("event_ts_corrected").cast("timestamp").alias("first_event"),
            F.max("event_ts_corrected").cast("timestamp").alias("last_event"),
        )

    @staticmethod
    def _merged_stats(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket", "device_id", "hour_bucket", "sensor_type").agg(
            F.sum("event_count").alias("event_count"),
            *[F.sum(f"{k}_{c}").alias(f"{k}_{c}") for c in AVERAGED for k in ("n", "sum")],
            F.max("max_torque").alias("max_torque"),
            F.max("max_temperature").alias("max_temperature"),
            F.min("first_event").alias("first_event"),
            F.max("last_event").alias("last_event"),
        )

    def _merge(self, spark: SparkSession, name: str, schema: str, delta: DataFrame, merged, hours: int, version: int, before: int | None) -> None:
        delta = self.state.write_whole(delta.withColumn("bucket", _bucket(F.col("hour_bucket"), hours)), f"{name}-delta", version)
        old = self.state.read(spark, name, schema, before, delta)
        self.state.write(merged(old.unionByName(delta)), name, version, before)

    def apply(self, spark: SparkSession, telemetry: DataFrame | None = None, blobs: DataFrame | None = None, marks: dict[str, int] | None = None) -> int:
        """Fold rows into the state; returns the new version."""
        newest = self.state.newest(spark) or {}
        before = newest.get("version")
        version = 0 if before is None else before + 1

        def sums(counts):
            return lambda rows: rows.groupBy("bucket", "hour_bucket").agg(*[F.sum(c).cast("long").alias(c) for c in counts])

        none = spark.createDataFrame([], ingest.TABLE_SCHEMAS["telemetry_events"]) if telemetry is None else telemetry
        self._merge(spark, "stats", STATS, self._stats(none), self._merged_stats, self.hours, version, before)
        self._merge(spark, "status", STATUS, gold.telemetry_hourly_status(none), sums(STATUS_COUNTS), 24 * self.hours, version, before)
        empty = spark.createDataFrame([], ingest.TABLE_SCHEMAS["blob_index"]) if blobs is None else blobs
        self._merge(spark, "volume", VOLUME, gold.blob_hourly_volume(empty), sums(VOLUME_COUNTS), 24 * self.hours, version, before)
        self.state.commit(spark, version, {k: v for k, v in newest.items() if k != "version"} | (marks or {}))
        return version

    def refresh(self, spark: SparkSession, paths: ingest.IngestPaths) -> int | None:
        """Apply what the ingest streams have committed since the last time."""
        newest = self.state.newest(spark) or {}
        new, marks = ingest.committed_since(spark, paths, newest)
        if new:
            return self.apply(spark, new.get("telemetry_events"), new.get("blob_index"), marks)
        return newest.get("version")

    def _read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        return self.state.read(spark, name, schema, (self.state.newest(spark) or {}).get("version")).drop("bucket")

    def device_hourly_stats(self, spark: SparkSession) -> DataFrame:
        """A2 as of the newest version."""
        rows = self._read(spark, "stats", STATS)
        return rows.select(
            "device_id",
            "hour_bucket",
            "sensor_type",
            "event_count",
            F.try_divide("sum_torque", "n_torque").alias("avg_torque"),
            "max_torque",
            F.try_divide("sum_temperature", "n_temperature").alias("avg_temperature"),
            "max_temperature",
            F.try_divide("sum_joint_angle", "n_joint_angle").alias("avg_joint_angle"),
            "first_event",
            "last_event",
        )

    def linkage_report(self, spark: SparkSession, ordered: bool = True) -> DataFrame:
        """A5 as of the newest version."""
        return gold.linkage_report_from(self._read(spark, "status", STATUS), self._read(spark, "volume", VOLUME), ordered)
