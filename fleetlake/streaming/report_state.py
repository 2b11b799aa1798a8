"""Linkage and quality reports kept up to date.

The reports over whole tables read everything each time.  Here a state is kept from which either
report is read off at a cost that does not depend on how much has been ingested:

* ``ids``: rows per event id (telemetry rows, blob rows by media, first ingest), in buckets.  The
  linked pairs of an id are nt * nb, so a batch changes them by nt * dnb + dnt * nb + dnt * dnb; the
  batch's ids are joined only to the buckets they lie in.  The bucket of an id is that of its device and
  session, so a batch touches the sessions that are live, not the history.
* ``summary``: each bucket's totals and pairs by media.  The oldest unlinked row cannot be undone by
  subtraction when its blob comes, so a touched bucket's summary is taken anew from its ids.
* ``devices``: newest ingest per device; ``recent``: rows per ingest time of the last while;
  ``totals``: rows, bad temperatures, newest ingest.

A report folds the summary (a few rows per bucket).  Batches are the commits that the ingest streams
have logged: ``refresh`` applies the ones not applied yet, so a report query is the one writer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.time import as_timestamp
from fleetlake.operators import linkage, quality
from fleetlake.plans import reports
from fleetlake.streaming import ingest
from fleetlake.streaming.bucket_state import BucketState

IDS = "event_id string, is_blob boolean, media_type string, n long, first_ingest timestamp"
SUMMARY = "bucket long, media_type string, is_total boolean, telemetry_total long, blob_total long, linked_count long, telemetry_unlinked long, blob_orphans long, oldest timestamp"
DEVICES = "device_id string, last_seen timestamp"
RECENT = "ingest_ts timestamp, n long"
TOTALS = "total_telemetry long, bad_temp_rows long, latest_ingest timestamp"

#: Rows without an id never link; they are one bucket of their own.
NO_ID = -1


def session_of(event_id: Column) -> Column:
    """The id up to its last colon (device and session); an id without one as it is."""
    return F.when(event_id.contains(":"), F.regexp_replace(event_id, ":[^:]*$", "")).otherwise(event_id)


class ReportState:
    """The kept state below ``root``.  ``group`` gives the part of an id that decides its bucket;
    ``keep_minutes``: how far behind the newest ingest a report's ``now`` may ask for recent rows."""

    def __init__(self, root: str, buckets: int = 4096, group: Callable[[Column], Column] = session_of, keep_minutes: int = 120):
        self.state = BucketState(root)
        self.buckets, self.group, self.keep_minutes = buckets, group, keep_minutes

    def _bucket(self) -> Column:
        eid = F.col("event_id")
        return F.when(eid.isNull(), F.lit(NO_ID)).otherwise(F.pmod(F.xxhash64(self.group(eid)), F.lit(self.buckets))).cast("long")

    def _delta(self, telemetry: DataFrame | None, blobs: DataFrame | None) -> DataFrame | None:
        parts = []
        if telemetry is not None:
            parts.append(telemetry.select("event_id", F.lit(False).alias("is_blob"), F.lit(None).cast("string").alias("media_type"), F.lit(1).cast("long").alias("n"), F.col("ingest_ts").cast("timestamp").alias("first_ingest")))
        if blobs is not None:
            parts.append(blobs.select("event_id", F.lit(True).alias("is_blob"), "media_type", F.lit(1).cast("long").alias("n"), F.lit(None).cast("timestamp").alias("first_ingest")))
        return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket", "event_id", "is_blob", "media_type").agg(F.sum("n").alias("n"), F.min("first_ingest").alias("first_ingest"))

    @staticmethod
    def _summary(ids: DataFrame) -> DataFrame:
        """One total row per bucket and one row per bucket and media with pairs."""
        per_id = ids.groupBy("bucket", "event_id").agg(
            F.sum(F.when(~F.col("is_blob"), F.col("n"))).alias("nt"),
            F.sum(F.when(F.col("is_blob"), F.col("n"))).alias("nb"),
            F.min("first_ingest").alias("first_ingest"),
            F.collect_list(F.when(F.col("is_blob"), F.struct("media_type", "n"))).alias("media"),  # an entry per kind of media
        )
        linked = F.col("event_id").isNotNull() & F.col("nt").isNotNull() & F.col("nb").isNotNull()
        unlinked = F.col("nt").isNotNull() & ~linked
        orphan = F.col("nb").isNotNull() & ~linked
        zero = F.lit(0).cast("long")
        none = F.lit(None)

        def entry(media, total, pairs, *, whole: bool):
            pick = (lambda c: c) if whole else (lambda c: zero)
            return F.struct(
                media.cast("string").alias("media_type"),
                total.alias("is_total"),
                pick(F.coalesce(F.col("nt"), zero)).alias("telemetry_total"),
                pick(F.coalesce(F.col("nb"), zero)).alias("blob_total"),
                pairs.cast("long").alias("linked_count"),
                pick(F.when(unlinked, F.col("nt")).otherwise(zero)).alias("telemetry_unlinked"),
                pick(F.when(orphan, F.col("nb")).otherwise(zero)).alias("blob_orphans"),
                (F.when(unlinked, F.col("first_ingest")) if whole else none.cast("timestamp")).alias("oldest"),
            )

        total = entry(none, F.lit(True), F.when(linked, F.col("nt") * F.col("nb")).otherwise(zero), whole=True)
        by_media = F.transform("media", lambda m: entry(m["media_type"], F.lit(False), F.when(linked, F.col("nt") * m["n"]).otherwise(zero), whole=False))
        flat = per_id.select("bucket", F.explode(F.concat(F.array(total), by_media)).alias("e")).select("bucket", "e.*")
        sums = [F.sum(c).alias(c) for c in ("telemetry_total", "blob_total", "linked_count", "telemetry_unlinked", "blob_orphans")]
        return flat.groupBy("bucket", "media_type", "is_total").agg(*sums, F.min("oldest").alias("oldest"))

    def apply(self, spark: SparkSession, telemetry: DataFrame | None = None, blobs: DataFrame | None = None, marks: dict[str, int] | None = None) -> int:
        """Fold rows into the state; returns the new version.  ``marks`` are kept with it."""
        newest = self.state.newest(spark) or {}
        before = newest.get("version")
        version = 0 if before is None else before + 1
        marks = {k: v for k, v in newest.items() if k != "version"} | (marks or {})
        if telemetry is None and blobs is None:
            return before if before is not None else -1
        delta = self._merged(self._delta(telemetry, blobs).withColumn("bucket", self._bucket()))
        delta = self.state.write_whole(delta, "delta", version)
        touched = delta.select("bucket").distinct()
        old = self.state.read(spark, "ids", IDS, before, touched)
        ids = self.state.write(self._merged(old.unionByName(delta)), "ids", version, before)
        kept = self.state.read_whole(spark, "summary", SUMMARY, before).join(touched, "bucket", "left_anti")
        summary = kept.unionByName(self._summary(ids)).select(*[c.split()[0] for c in SUMMARY.split(", ")])
        self.state.write_whole(summary.coalesce(1), "summary", version)
        self._apply_quality(spark, telemetry, version, before)
        self.state.commit(spark, version, marks)
        return version

    def _apply_quality(self, spark: SparkSession, telemetry: DataFrame | None, version: int, before: int | None) -> None:
        devices = self.state.read_whole(spark, "devices", DEVICES, before)
        recent = self.state.read_whole(spark, "recent", RECENT, before)
        totals = self.state.read_whole(spark, "totals", TOTALS, before)
        if telemetry is not None:
            ts = F.col("ingest_ts").cast("timestamp")
            seen = telemetry.groupBy("device_id").agg(F.max(ts).alias("last_seen"))
            devices = devices.unionByName(seen).groupBy("device_id").agg(F.max("last_seen").alias("last_seen"))
            times = telemetry.where("ingest_ts is not null").groupBy(ts.alias("ingest_ts")).agg(F.count(F.lit(1)).alias("n"))
            recent = recent.unionByName(times).groupBy("ingest_ts").agg(F.sum("n").alias("n"))
            one = telemetry.agg(F.count(F.lit(1)).alias("total_telemetry"), F.count(F.when(quality.temperature_out_of_range(), 1)).alias("bad_temp_rows"), F.max(ts).alias("latest_ingest"))
            totals = totals.unionByName(one).agg(F.sum("total_telemetry").alias("total_telemetry"), F.sum("bad_temp_rows").alias("bad_temp_rows"), F.max("latest_ingest").alias("latest_ingest"))
        totals = self.state.write_whole(totals.coalesce(1), "totals", version)
        horizon = totals.agg(F.max("latest_ingest") - F.expr(f"INTERVAL {int(self.keep_minutes)} MINUTES")).scalar()
        self.state.write_whole(recent.where(F.col("ingest_ts") > horizon).coalesce(1), "recent", version)
        self.state.write_whole(devices, "devices", version)

    def refresh(self, spark: SparkSession, paths: ingest.IngestPaths) -> int | None:
        """Apply what the ingest streams have committed since the last time; the version, or None
        where nothing has ever been committed.  Only rows of the new commits are read."""
        newest = self.state.newest(spark) or {}
        new, marks = ingest.committed_since(spark, paths, newest)
        if new:
            return self.apply(spark, new.get("telemetry_events"), new.get("blob_index"), marks)
        return newest.get("version")

    # -- reports
    def linkage(self, spark: SparkSession) -> DataFrame:
        """The one row of ``reports.linkage_measures``, from the summary."""
        s = self.state.read_whole(spark, "summary", SUMMARY, (self.state.newest(spark) or {}).get("version"))
        r = s.groupBy("media_type", "is_total").agg(
            *[F.sum(c).alias(c) for c in ("telemetry_total", "blob_total", "linked_count", "telemetry_unlinked", "blob_orphans")], F.min("oldest").alias("_oldest")
        )
        return reports.fold_measures(r, F.col("is_total"))

    def reconcile_report(self, spark: SparkSession, now=None, **thresholds) -> DataFrame:
        """A17 from the state."""
        return reports.reconcile_from(self.linkage(spark), now, **thresholds)

    def quality_report(self, spark: SparkSession, now=None, **thresholds) -> DataFrame:
        """A18 from the state.  A ``now`` that reaches behind ``keep_minutes`` before the newest
        ingest has no count of recent rows (NULL, so a WARNING)."""
        version = (self.state.newest(spark) or {}).get("version")
        now_c = as_timestamp(now) if now is not None else F.current_timestamp()
        totals = self.state.read_whole(spark, "totals", TOTALS, version)
        recent = self.state.read_whole(spark, "recent", RECENT, version)
        since = now_c - F.expr("INTERVAL 5 MINUTES")
        in_window = recent.agg(F.coalesce(F.sum(F.when(F.col("ingest_ts") > since, F.col("n"))), F.lit(0)).alias("n")).scalar()
        one = totals.agg(F.max("latest_ingest").alias("latest_ingest"), linkage.total_of(F.col("total_telemetry")).alias("total_telemetry"), linkage.total_of(F.col("bad_temp_rows")).alias("bad_temp_rows"))
        reaches = F.col("latest_ingest").isNull() | (since >= F.col("latest_ingest") - F.expr(f"INTERVAL {int(self.keep_minutes)} MINUTES"))
        one = one.withColumn("events_last_5m", F.when(reaches, in_window)).withColumn("linked", self.linkage(spark).select("linked_count").scalar())
        devices = self.state.read_whole(spark, "devices", DEVICES, version).withColumnRenamed("last_seen", "ingest_ts")
        return reports.quality_from(one, reports.stale_devices(devices, now_c, 5), now_c, **thresholds)


def kept_reports(state: ReportState, paths: ingest.IngestPaths, now=None) -> dict[str, Callable[[SparkSession], DataFrame]]:
    """Builders for ``monitor.start_periodic_report``: each first applies what is newly committed."""

    def build(report):
        def run(spark: SparkSession) -> DataFrame:
            state.refresh(spark, paths)
            return report(spark, now)

        return run

    return {"reconcile": build(state.reconcile_report), "quality": build(state.quality_report)}
