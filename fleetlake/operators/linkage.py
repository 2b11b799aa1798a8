"""Cross-layer linkage between telemetry rows and blob-index rows.

Scale notes
-----------
* Counting operators never materialise join pairs.  Each side is first
  reduced to one row per ``event_id`` (``groupBy`` with map-side partial
  aggregation, so a hot id costs one row per map task), then the two key
  tables are joined.  Both are hash partitioned on ``event_id`` by their
  aggregation, so the join adds no further exchange.
  ``pairs = sum(nt * nb)`` reproduces the inner-join row count exactly,
  including duplicated manifests.
* NULL ids (broken messages) never match, exactly as in an SQL join; they
  stay "unlinked" / "orphaned".
* Row-level joins (``blob_linked``) are plain equi joins: Catalyst drops
  NULL keys before the shuffle and AQE splits hot keys (skew join) or
  broadcasts a side that turns out small at run time.  The top-k join
  (``cross_layer_join``) only ever joins its k candidate rows.
* Anti joins and the status assignment route NULL ids around the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import rules
from fleetlake.functions.time import as_timestamp, minus_interval, seconds_between


def _pct(num: Column, den: Column) -> Column:
    return F.round(num.cast("double") / den * 100, 2)


# ------------------------------------------------------------------ key tables
def telemetry_keys(telemetry: DataFrame) -> DataFrame:
    """event_id, nt (rows), first_ingest (min ingest_ts) per telemetry id."""
    return telemetry.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("nt"),
        F.min("ingest_ts").alias("first_ingest"),
    )


def blob_keys(blobs: DataFrame) -> DataFrame:
    """event_id, nb (rows) per blob-index id."""
    return blobs.groupBy("event_id").agg(F.count(F.lit(1)).alias("nb"))


def total_of(c: Column) -> Column:
    """Sum as a long; 0 over no rows."""
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def key_join(telemetry: DataFrame, blobs: DataFrame) -> DataFrame:
    """Full outer join of the two key tables (one row per distinct id per side)."""
    return telemetry_keys(telemetry).join(blob_keys(blobs), "event_id", "full_outer")


# ------------------------------------------------------------------ counts
def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """A1: ``count(*)``."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def linkage_counts(telemetry: DataFrame, blobs: DataFrame, now=None) -> DataFrame:
    """One row: totals, join pairs, unlinked telemetry, orphan blobs, pct and
    oldest unlinked age, all from a single pass over the key join.

    Columns: telemetry_total, blob_total, linked_count (J2 pairs),
    telemetry_unlinked (J3), blob_orphans (J4), linked_events (distinct ids
    with a blob), linkage_pct (A6), oldest_unlinked_sec (A12).
    """
    k = key_join(telemetry, blobs)
    nt = F.coalesce(F.col("nt"), F.lit(0))
    nb = F.coalesce(F.col("nb"), F.lit(0))
    matched = F.col("nt").isNotNull() & F.col("nb").isNotNull()
    unlinked = F.col("nt").isNotNull() & F.col("nb").isNull()
    aggs = [
        total_of(nt).alias("telemetry_total"),
        total_of(nb).alias("blob_total"),
        total_of(F.when(matched, nt * nb)).alias("linked_count"),
        total_of(F.when(unlinked, nt)).alias("telemetry_unlinked"),
        total_of(F.when(F.col("nt").isNull(), nb)).alias("blob_orphans"),
        total_of(F.when(matched, nt)).alias("linked_events"),
        F.min(F.when(unlinked, F.col("first_ingest"))).alias("_oldest_unlinked_ingest"),
    ]
    out = k.agg(*aggs)
    out = out.withColumn(
        "linkage_pct",
        _pct(F.col("linked_count"), F.greatest(F.col("telemetry_total"), F.lit(1))),
    )
    if now is not None:
        age = seconds_between(as_timestamp(now), F.col("_oldest_unlinked_ingest"))
        out = out.withColumn("oldest_unlinked_sec", F.nullif(F.round(age, 1), F.lit(0.0)))
    return out.drop("_oldest_unlinked_ingest")


def linked_count(telemetry: DataFrame, blobs: DataFrame) -> DataFrame:
    """Number of inner-join pairs on event_id."""
    return linkage_counts(telemetry, blobs).select("linked_count")


def _anti(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` whose event_id has no row in ``right`` (SQL semantics:
    a NULL id never matches).  NULL ids bypass the join, so a flood of
    broken messages is not shuffled into one task; the right side is
    reduced to distinct ids first (partial aggregation)."""
    ids = right.filter(F.col("event_id").isNotNull()).select("event_id").distinct()
    keyed = left.filter(F.col("event_id").isNotNull()).join(ids, "event_id", "left_anti")
    return keyed.unionByName(left.filter(F.col("event_id").isNull()))


def unlinked_telemetry(telemetry: DataFrame, blobs: DataFrame) -> DataFrame:
    """J3 (rows): telemetry rows without any blob row of the same id."""
    return _anti(telemetry, blobs)


def orphan_blobs(blobs: DataFrame, telemetry: DataFrame) -> DataFrame:
    """J4 (rows): blob rows without any telemetry row of the same id."""
    return _anti(blobs, telemetry)


def linkage_rate_leftjoin(telemetry: DataFrame, blobs: DataFrame) -> DataFrame:
    """``count(b.event_id) / count(*)`` over the telemetry LEFT JOIN blobs.

    Evaluated on key tables: the left join has ``nt * max(nb, 1)`` rows per
    id, ``nt * nb`` of them with a non-NULL blob id.  NULL on empty input.
    """
    k = key_join(telemetry, blobs).filter(F.col("nt").isNotNull())
    rows = F.col("nt") * F.greatest(F.coalesce(F.col("nb"), F.lit(0)), F.lit(1))
    linked = F.col("nt") * F.coalesce(F.col("nb"), F.lit(0))
    out = k.agg(F.sum(rows).cast("long").alias("total_telemetry"), F.sum(linked).cast("long").alias("linked"))
    return out.withColumn(
        "linkage_pct",
        F.round(F.try_divide(F.col("linked").cast("double"), F.col("total_telemetry").cast("double")) * 100, 2),
    ).select(
        F.coalesce(F.col("total_telemetry"), F.lit(0)).alias("total_telemetry"),
        F.coalesce(F.col("linked"), F.lit(0)).alias("linked"),
        "linkage_pct",
    )


def media_breakdown(telemetry: DataFrame, blobs: DataFrame) -> DataFrame:
    """Linked pairs per media_type, descending (tie: media_type).

    Blobs are pre-aggregated per (event_id, media_type) and joined to the
    telemetry key counts; ``sum(nt * n)`` equals the pair count.
    """
    bm = blobs.groupBy("event_id", "media_type").agg(F.count(F.lit(1)).alias("n"))
    tk = telemetry.groupBy("event_id").agg(F.count(F.lit(1)).alias("nt"))
    return (
        bm.join(tk, "event_id", "inner")
        .groupBy("media_type")
        .agg(F.sum(F.col("n") * F.col("nt")).cast("long").alias("cnt"))
        .orderBy(F.col("cnt").desc(), F.col("media_type"))
    )


def blobs_per_media(blobs: DataFrame) -> DataFrame:
    """All blobs per media_type, descending."""
    return (
        blobs.groupBy("media_type")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.col("cnt").desc(), F.col("media_type"))
    )


_J1_TELEMETRY = ["device_id", "event_id", "event_ts_corrected", "ingest_status"]
_J1_BLOB = ["media_type", "blob_uri", "checksum_sha256", "quality_state"]


def cross_layer_join(
    telemetry: DataFrame,
    blobs: DataFrame,
    limit: int = 20,
    order_col: str = "ingest_ts",
    telemetry_cols: list[str] | None = None,
    blob_cols: list[str] | None = None,
) -> DataFrame:
    """J1 + T1: newest linked rows (by telemetry ``order_col``, descending).

    The top ``limit`` pairs involve at most ``limit`` telemetry rows, and
    those are among the newest ``limit`` telemetry rows that have a blob.
    So telemetry is semi-joined to the distinct blob ids, reduced to its
    top ``limit`` rows (TakeOrderedAndProject: each task keeps its own top
    n), and only those rows are joined to the blobs - a broadcast bounded
    by ``limit``.  No pair outside the answer is ever built, even for an id
    repeated on both sides.  Ties are broken by event_id, then blob_uri.
    """
    tcols = telemetry_cols or _J1_TELEMETRY
    bcols = blob_cols or _J1_BLOB
    t_sel = list(dict.fromkeys(tcols + ["event_id", order_col]))
    ids = blobs.filter(F.col("event_id").isNotNull()).select("event_id").distinct()
    cand = (
        telemetry.select(*t_sel)
        .join(ids, "event_id", "left_semi")
        .orderBy(F.col(order_col).desc(), F.col("event_id"))
        .limit(limit)
    )
    t = cand.select(*[F.col(c).alias(f"t_{c}") for c in t_sel])
    b_sel = list(dict.fromkeys(bcols + ["event_id", "blob_uri"]))
    b = blobs.select(*[F.col(c).alias(f"b_{c}") for c in b_sel])
    return (
        b.join(F.broadcast(t), F.col("t_event_id") == F.col("b_event_id"), "inner")
        .orderBy(F.col(f"t_{order_col}").desc(), F.col("t_event_id"), F.col("b_blob_uri"))
        .limit(limit)
        .select(*[F.col(f"t_{c}").alias(c) for c in tcols], *[F.col(f"b_{c}").alias(c) for c in bcols])
    )


def unlinked_by_device(telemetry: DataFrame, blobs: DataFrame, limit: int = 10) -> DataFrame:
    """Devices with most unlinked telemetry rows (top ``limit``)."""
    return (
        unlinked_telemetry(telemetry, blobs)
        .groupBy("device_id")
        .agg(F.count(F.lit(1)).alias("unlinked"))
        .orderBy(F.col("unlinked").desc(), F.col("device_id"))
        .limit(limit)
    )


def oldest_unlinked(telemetry: DataFrame, blobs: DataFrame, now) -> DataFrame:
    """min(ingest_ts) over unlinked telemetry and its age in seconds."""
    oldest = unlinked_telemetry(telemetry, blobs).agg(F.min("ingest_ts").alias("oldest_unlinked_ts"))
    return oldest.select(
        "oldest_unlinked_ts",
        seconds_between(as_timestamp(now), F.col("oldest_unlinked_ts")).alias("age_sec"),
    )


def recent_linkage(telemetry: DataFrame, blobs: DataFrame, now, minutes: int = 10) -> DataFrame:
    """Linkage over telemetry ingested in the last ``minutes`` (strict >).

    The time filter is applied to telemetry before the join (and pushed to
    the scan); the blob side is reduced to distinct ids of any age.
    """
    since = minus_interval(as_timestamp(now), minutes, "MINUTE")
    recent = telemetry.filter(F.col("ingest_ts") > since)
    return linkage_rate_leftjoin(recent, blobs)


def assign_link_status(
    telemetry: DataFrame,
    blobs: DataFrame,
    now,
    timeout_minutes: int = rules.ORPHAN_TIMEOUT_MINUTES,
) -> DataFrame:
    """W8 (batch): PENDING -> LINKED when a manifest with the id exists, else
    ORPHANED once older than the timeout, else still PENDING.

    The blob side is reduced to distinct ids (partial aggregation); rows
    with a NULL id are routed around the join (they can never link), so
    they are not shuffled to one hot partition.
    """
    cutoff = minus_interval(as_timestamp(now), timeout_minutes, "MINUTE")
    keys = blobs.filter(F.col("event_id").isNotNull()).select("event_id").distinct().withColumn("_linked", F.lit(True))
    with_id = telemetry.filter(F.col("event_id").isNotNull()).join(keys, "event_id", "left")
    without_id = telemetry.filter(F.col("event_id").isNull()).withColumn("_linked", F.lit(None).cast("boolean"))
    both = with_id.unionByName(without_id)
    status = (
        F.when(F.col("_linked"), F.lit(rules.STATUS_LINKED))
        .when(F.col("ingest_ts") < cutoff, F.lit(rules.STATUS_ORPHANED))
        .otherwise(F.lit(rules.STATUS_PENDING))
    )
    cols = [status.alias(c) if c == "ingest_status" else F.col(c) for c in telemetry.columns]
    return both.select(*cols)


def link_health(pct: Column, healthy_pct: float = rules.RECONCILE_HEALTHY_PCT) -> Column:
    """HEALTHY when pct >= threshold, else DEGRADED."""
    return F.when(pct >= healthy_pct, F.lit("HEALTHY")).otherwise(F.lit("DEGRADED"))


def tolerance_match(
    telemetry: DataFrame,
    blobs: DataFrame,
    tolerance_ms: int = rules.MATCH_TOLERANCE_MS,
    span_ms: int | None = None,
) -> DataFrame:
    """Pair each blob with the nearest telemetry row of the same device
    whose corrected time is within ``tolerance_ms`` (ties: smaller
    telemetry event_id).  Blobs with no such row are not returned.

    Nearest-neighbour by sorting, not by pairing: telemetry is unioned
    with the blobs; per (device, span)
    one running ``last`` over time gives the closest telemetry at or before
    each blob and one over reversed time the closest after it.  Telemetry is
    copied to every span that its tolerance reaches, so partitions stay
    bounded by the span length (a hot device is cut into spans) and no
    candidate pairs are generated.  ``span_ms``: a minute by default, or the
    tolerance if that is longer (a row is then in three spans at most).
    """
    from pyspark.sql import Window

    w = int(tolerance_ms)
    span = int(span_ms or max(60_000, w))
    t = telemetry.select(
        "device_id",
        F.unix_millis(F.col("event_ts_corrected").cast("timestamp")).alias("ms"),
        F.col("event_id").alias("tel_id"),
    ).filter(F.col("ms").isNotNull() & F.col("device_id").isNotNull())
    # every span that a blob within the tolerance can lie in
    t = t.withColumn("span", F.explode(F.sequence(F.floor((F.col("ms") - w) / span), F.floor((F.col("ms") + w) / span))))
    tel = F.struct(F.col("ms").alias("t_ms"), F.col("tel_id"))
    t = t.select("device_id", "span", "ms", F.lit(0).alias("kind"), F.col("tel_id").alias("_tie"), tel.alias("tel"),
                 *[F.lit(None).cast(c).alias(n) for n, c in (("blob_event_id", "string"), ("blob_uri", "string"))])
    b = blobs.select(
        "device_id",
        F.unix_millis(F.col("blob_ts_corrected").cast("timestamp")).alias("ms"),
        F.col("event_id").alias("blob_event_id"),
        "blob_uri",
    ).filter(F.col("ms").isNotNull() & F.col("device_id").isNotNull())
    b = b.select(
        "device_id",
        F.floor(F.col("ms") / span).alias("span"),
        "ms",
        F.lit(1).alias("kind"),
        F.lit(None).cast(t.schema["_tie"].dataType).alias("_tie"),
        F.lit(None).cast(t.schema["tel"].dataType).alias("tel"),
        "blob_event_id",
        "blob_uri",
    )
    u = t.unionByName(b)
    # Telemetry before blobs at equal ms going forward (at-or-before), after
    # them going backward (strictly later); among telemetry rows at the same
    # ms the smallest id is visited last, so ``last`` returns it.
    fwd = (
        Window.partitionBy("device_id", "span")
        .orderBy("ms", "kind", F.col("_tie").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    bwd = (
        Window.partitionBy("device_id", "span")
        .orderBy(F.col("ms").desc(), F.col("kind").desc(), F.col("_tie").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    u = u.withColumn("prev", F.last("tel", ignorenulls=True).over(fwd))
    u = u.withColumn("next", F.last("tel", ignorenulls=True).over(bwd))
    u = u.filter(F.col("kind") == 1)
    dp = F.col("ms") - F.col("prev.t_ms")
    dn = F.col("next.t_ms") - F.col("ms")
    cands = F.array(
        F.when(dp <= w, F.struct(dp.alias("d"), F.col("prev.tel_id").alias("id"))),
        F.when(dn <= w, F.struct(dn.alias("d"), F.col("next.tel_id").alias("id"))),
    )
    best = F.array_min(F.filter(cands, lambda c: c.isNotNull()))
    return (
        u.withColumn("best", best)
        .filter(F.col("best").isNotNull())
        .select(
            "device_id",
            "blob_event_id",
            "blob_uri",
            F.col("best.id").alias("telemetry_event_id"),
            F.col("best.d").alias("diff_ms"),
        )
    )
