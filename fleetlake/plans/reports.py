"""One-row operational reports: reconciliation (A17) and quality SLA.

The reference sends 7 (reconcile) or 5 (quality) separate SQL statements,
each its own scan and join, possibly on different snapshots.  Here each
report is one Spark job over one snapshot:

* telemetry and blobs are each reduced to one row per ``event_id`` before
  they are joined, and the join is folded into a single row (the per-media
  breakdown comes out of the same pass via ``rollup``),
* measures that need no join come from one flat aggregate,
* small bounded side results (stalest devices: top 5) enter as scalar
  subqueries, never through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import rules
from fleetlake.functions.time import as_timestamp, seconds_between
from fleetlake.operators import linkage, quality


def linkage_rollup(telemetry: DataFrame, blobs: DataFrame, now: Column) -> DataFrame:
    """All reconcile measures and the per-media pair counts from one pass.

    Telemetry is reduced to one row per id, blobs to one row per
    (id, media_type); a single full outer join on ``event_id`` gives rows
    (id, media, n, nt).  Telemetry-side measures are counted once per id,
    on the (id, media) row flagged first by a window that runs on the blob
    keys' join partitioning (no extra exchange); ``rollup(media_type)`` yields the
    global totals and the per-media pair counts in one aggregation, and a
    final fold over those few rows (one per media type, plus one) builds
    the report row with its media map.
    """
    from pyspark.sql import Window

    tk = linkage.telemetry_keys(telemetry)
    bm = blobs.groupBy("event_id", "media_type").agg(F.count(F.lit(1)).alias("n"))
    # Flag one (id, media) row per id.  The window needs the blob keys
    # clustered by event_id, which the join needs too: the one exchange
    # serves both.
    first = Window.partitionBy("event_id").orderBy("media_type")
    bm = bm.withColumn("_first", F.row_number().over(first) == 1)
    j = tk.join(bm, "event_id", "full_outer")
    nt, n = F.coalesce(F.col("nt"), F.lit(0)), F.coalesce(F.col("n"), F.lit(0))
    has_t, has_b = F.col("nt").isNotNull(), F.col("n").isNotNull()
    t_once = has_t & (~has_b | F.col("_first"))
    unlinked = t_once & ~has_b
    r = j.rollup("media_type").agg(
        F.grouping_id().alias("_g"),
        linkage.total_of(F.when(t_once, nt)).alias("telemetry_total"),
        linkage.total_of(n).alias("blob_total"),
        linkage.total_of(F.when(has_t & has_b, nt * n)).alias("linked_count"),
        linkage.total_of(F.when(unlinked, nt)).alias("telemetry_unlinked"),
        linkage.total_of(F.when(~has_t, n)).alias("blob_orphans"),
        F.min(F.when(unlinked, F.col("first_ingest"))).alias("_oldest"),
    )
    one = fold_measures(r, F.col("_g") == 1)
    return measures_row(one, now)


def fold_measures(r: DataFrame, is_total: Column) -> DataFrame:
    """One row of measures from total rows and rows per media_type."""
    per_media = F.when(~is_total & F.col("media_type").isNotNull() & (F.col("linked_count") > 0),
                       F.struct((-F.col("linked_count")).alias("k"), "media_type", F.col("linked_count").alias("cnt")))
    entries = F.array_sort(F.collect_list(per_media))
    return r.agg(
        *[F.coalesce(F.max(F.when(is_total, F.col(c))), F.lit(0)).alias(c) for c in
          ("telemetry_total", "blob_total", "linked_count", "telemetry_unlinked", "blob_orphans")],
        F.max(F.when(is_total, F.col("_oldest"))).alias("_oldest"),
        F.map_from_entries(F.transform(entries, lambda e: F.struct(e["media_type"], e["cnt"]))).alias(
            "media_breakdown"),
    )


def measures_row(one: DataFrame, now: Column) -> DataFrame:
    """The reported form of folded measures."""
    pct = F.round(F.col("linked_count").cast("double") / F.greatest(F.col("telemetry_total"), F.lit(1)) * 100, 2)
    age = seconds_between(now, F.col("_oldest"))
    return one.select(
        "telemetry_total",
        "blob_total",
        "linked_count",
        "telemetry_unlinked",
        "blob_orphans",
        pct.alias("linkage_pct"),
        "media_breakdown",
        F.nullif(F.round(age, 1), F.lit(0.0)).alias("oldest_unlinked_sec"),
    )


def reconcile_report(telemetry: DataFrame, blobs: DataFrame, now=None,
                     healthy_pct: float = rules.RECONCILE_HEALTHY_PCT) -> DataFrame:
    """timestamp_utc, totals, linked pairs, unlinked, orphans, pct,
    media breakdown map, oldest unlinked age and HEALTHY/DEGRADED status."""
    now_c = as_timestamp(now) if now is not None else F.current_timestamp()
    return _reconcile_row(linkage_rollup(telemetry, blobs, now_c), now_c, healthy_pct)


def reconcile_from(measures: DataFrame, now=None, healthy_pct: float = rules.RECONCILE_HEALTHY_PCT) -> DataFrame:
    """A17 from the one row of ``fold_measures``."""
    now_c = as_timestamp(now) if now is not None else F.current_timestamp()
    return _reconcile_row(measures_row(measures, now_c), now_c, healthy_pct)


def _reconcile_row(one: DataFrame, now_c: Column, healthy_pct: float) -> DataFrame:
    return one.select(
        now_c.alias("timestamp_utc"),
        "telemetry_total",
        "blob_total",
        "linked_count",
        "telemetry_unlinked",
        "blob_orphans",
        "linkage_pct",
        "media_breakdown",
        "oldest_unlinked_sec",
        linkage.link_health(F.col("linkage_pct"), healthy_pct).alias("status"),
    )


def stale_devices(telemetry: DataFrame, now, top: int = 5) -> Column:
    """Scalar-subquery column: top ``top`` stalest devices as array<struct>."""
    top_df = quality.per_device_freshness(telemetry, now, limit=top)
    items = F.array_sort(
        F.collect_list(F.struct((-F.col("stale_sec")).alias("k"), F.col("device_id"), F.col("stale_sec")))
    )
    return top_df.agg(F.transform(items, lambda e: F.struct(e["device_id"].alias("device_id"), e["stale_sec"].alias("stale_sec")))).scalar()


def quality_report(
    telemetry: DataFrame,
    blobs: DataFrame,
    now=None,
    freshness_warn: int = rules.FRESHNESS_WARN_SEC,
    freshness_crit: int = rules.FRESHNESS_CRIT_SEC,
    min_events_5m: int = rules.MIN_EVENTS_LAST_5M,
    linkage_warn: float = rules.LINKAGE_WARN_PCT,
    linkage_crit: float = rules.LINKAGE_CRIT_PCT,
    max_bad_temp: int = rules.MAX_BAD_TEMP_ROWS,
) -> DataFrame:
    """Overall severity, four check structs and the top-5 stale devices."""
    now_c = as_timestamp(now) if now is not None else F.current_timestamp()
    # per-row measures in one flat pass; only the linked pairs need the ids
    pairs = linkage.telemetry_keys(telemetry).join(linkage.blob_keys(blobs), "event_id").agg(linkage.total_of(F.col("nt") * F.col("nb")))
    one = quality.check_aggregates(telemetry, now_c, 5).withColumn("linked", pairs.scalar())
    return quality_from(one, stale_devices(telemetry, now_c, 5), now_c, freshness_warn, freshness_crit, min_events_5m, linkage_warn, linkage_crit, max_bad_temp)


def quality_from(
    one: DataFrame,
    stale: Column,
    now_c: Column,
    freshness_warn: int = rules.FRESHNESS_WARN_SEC,
    freshness_crit: int = rules.FRESHNESS_CRIT_SEC,
    min_events_5m: int = rules.MIN_EVENTS_LAST_5M,
    linkage_warn: float = rules.LINKAGE_WARN_PCT,
    linkage_crit: float = rules.LINKAGE_CRIT_PCT,
    max_bad_temp: int = rules.MAX_BAD_TEMP_ROWS,
) -> DataFrame:
    """A18 from its measures: latest_ingest, events_last_5m, total_telemetry, bad_temp_rows, linked."""
    lag = seconds_between(now_c, F.col("latest_ingest"))
    fresh = F.when(F.col("latest_ingest").isNull(), F.lit(None)).otherwise(F.greatest(F.lit(0), lag.cast("long")))
    one = one.withColumn("freshness_sec", fresh).withColumn(
        "linkage_pct", F.round(F.col("linked").cast("double") / F.greatest(F.col("total_telemetry"), F.lit(1)) * 100, 2)
    )
    sev_f = quality.classify_freshness(F.col("freshness_sec"), freshness_warn, freshness_crit)
    sev_v = quality.classify_volume(F.col("events_last_5m"), min_events_5m)
    sev_l = quality.classify_linkage(F.col("linkage_pct"), linkage_warn, linkage_crit)
    sev_a = quality.classify_accuracy(F.col("bad_temp_rows"), max_bad_temp)
    checks = F.struct(
        F.struct(
            sev_f.alias("severity"),
            F.col("freshness_sec").alias("value_sec"),
            F.lit(freshness_warn).alias("threshold_warn"),
            F.lit(freshness_crit).alias("threshold_crit"),
        ).alias("freshness"),
        F.struct(
            sev_v.alias("severity"),
            F.col("events_last_5m").alias("events_last_5m"),
            F.lit(min_events_5m).alias("threshold_min"),
        ).alias("completeness_volume"),
        F.struct(
            sev_l.alias("severity"),
            F.col("linkage_pct").alias("linkage_pct"),
            F.col("linked").alias("linked"),
            F.col("total_telemetry").alias("total_telemetry"),
        ).alias("completeness_linkage"),
        F.struct(sev_a.alias("severity"), F.col("bad_temp_rows").alias("bad_temp_rows")).alias("accuracy"),
    )
    return one.select(
        now_c.alias("timestamp_utc"),
        quality.worst_severity(sev_f, sev_v, sev_l, sev_a).alias("overall_severity"),
        checks.alias("checks"),
        stale.alias("stale_devices_top5"),
    )


def report_json(report: DataFrame) -> DataFrame:
    """K6: one JSON line per report row."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("value"))
