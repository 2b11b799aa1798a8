"""Per-device clock-drift correction from heartbeat data.

Heartbeats are data joined to events, not a driver-side dict read by a
Python UDF: the lookup is a Catalyst join, its result is reproducible, and
a failed heartbeat feed is visible (``drift_source = 'DEFAULT'``) instead
of silently becoming 0.

Two lookups:
* ``latest_drift``  - the newest heartbeat per device (what a live map
  holds once every heartbeat has been seen);
* ``asof_drift``    - the last heartbeat at or before each event's edge
  time (what the map held when the event was stamped).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.time import ms_to_timestamp

DEFAULT_DRIFT_MS = 0


def heartbeat_order() -> Column:
    """Total order of heartbeats of a device: time, then session, then value."""
    return F.struct("server_ts_ms", "session_id", "estimated_drift_ms")


def latest_drift(heartbeats: DataFrame) -> DataFrame:
    """device_id -> drift_ms of its newest heartbeat (ties: session, value).

    ``max_by`` is a partial aggregate, so a device with many heartbeats costs
    one row per map task in the shuffle.
    """
    hb = heartbeats.filter(F.col("device_id").isNotNull()).select(
        "device_id",
        "server_ts_ms",
        "session_id",
        F.coalesce(F.col("estimated_drift_ms"), F.lit(DEFAULT_DRIFT_MS)).alias("estimated_drift_ms"),
    )
    return hb.groupBy("device_id").agg(F.max_by("estimated_drift_ms", heartbeat_order()).alias("drift_ms"))


def corrected_ms(ts_ms: Column, drift_ms: Column) -> Column:
    """``ts - drift`` (drift defaults to 0); NULL for a NULL or 0 timestamp."""
    return F.when(ts_ms.isNotNull() & (ts_ms != 0), ts_ms - F.coalesce(drift_ms, F.lit(DEFAULT_DRIFT_MS)))


def apply_drift(
    df: DataFrame,
    drift_ms_col: str = "drift_ms",
    ts_col: str = "event_ts_edge_ms",
    out_col: str = "event_ts_corrected",
) -> DataFrame:
    """P1 + P2 + P4 on a frame that already carries a (nullable) drift column."""
    fixed = corrected_ms(F.col(ts_col), F.col(drift_ms_col))
    return df.withColumn(out_col, ms_to_timestamp(fixed)).withColumn(
        "drift_source", F.when(F.col(drift_ms_col).isNotNull(), F.lit("HEARTBEAT")).otherwise(F.lit("DEFAULT"))
    )


def correct_drift(
    df: DataFrame,
    heartbeats: DataFrame,
    ts_col: str = "event_ts_edge_ms",
    out_col: str = "event_ts_corrected",
) -> DataFrame:
    """Latest-drift correction: left join with the per-device drift table
    (one row per device; the size known at run time decides between a
    broadcast and a shuffled join).  Output: input columns + drift_ms,
    ``out_col``, drift_source.
    """
    return apply_drift(df.join(latest_drift(heartbeats), "device_id", "left"), "drift_ms", ts_col, out_col)


def change_points(heartbeats: DataFrame, span_ms: int = 3_600_000) -> DataFrame:
    """(device_id, from_ms, drift_ms): the heartbeats at which a device's drift
    changes, the first one included.  Of several at one instant the last in
    ``heartbeat_order`` counts.

    Two steps, so that no task sees all heartbeats of a device: first within
    each (device, span), then over what is left of the device (a row per span
    at most, besides the changes).
    """
    drift = F.coalesce(F.col("estimated_drift_ms"), F.lit(DEFAULT_DRIFT_MS)).alias("drift")
    at_once = (
        heartbeats.filter(F.col("device_id").isNotNull() & F.col("server_ts_ms").isNotNull())
        .groupBy("device_id", F.col("server_ts_ms").alias("from_ms"))
        .agg(F.max(F.struct("session_id", drift))["drift"].alias("drift_ms"))
    )

    def changes(rows: DataFrame, *keys) -> DataFrame:
        before = F.lag("drift_ms").over(Window.partitionBy("device_id", *keys).orderBy("from_ms"))
        kept = rows.withColumn("_before", before).filter(F.col("_before").isNull() | (F.col("_before") != F.col("drift_ms")))
        return kept.drop("_before")

    return changes(changes(at_once, F.floor(F.col("from_ms") / F.lit(span_ms))))


def drift_intervals(heartbeats: DataFrame, span_ms: int = 3_600_000) -> DataFrame:
    """(device_id, from_ms, until_ms, drift_ms): when which drift holds; the last interval is open."""
    until = F.lead("from_ms").over(Window.partitionBy("device_id").orderBy("from_ms"))
    return change_points(heartbeats, span_ms).withColumn("until_ms", until).select("device_id", "from_ms", "until_ms", "drift_ms")


def asof_drift(
    df: DataFrame,
    heartbeats: DataFrame,
    ts_col: str = "event_ts_edge_ms",
    span_ms: int = 3_600_000,
) -> DataFrame:
    """Attach ``drift_ms`` of the last heartbeat with
    ``server_ts_ms <= ts_col`` of the same device (NULL when none).

    A device's intervals do not overlap, so the join finds at most one per
    row.  There is one interval per change of drift, far fewer than
    heartbeats: where the table is small the events are not shuffled at all,
    and otherwise a hot device's rows are split by the skew join.  Rows
    without device or time skip the join.
    """
    ts = F.col(ts_col)
    has_key = F.col("device_id").isNotNull() & ts.isNotNull()
    found = drift_intervals(heartbeats, span_ms).withColumnRenamed("device_id", "_device")
    holds = (F.col("device_id") == F.col("_device")) & (ts >= F.col("from_ms")) & (F.col("until_ms").isNull() | (ts < F.col("until_ms")))
    out = df.filter(has_key).join(found, holds, "left").select(*df.columns, "drift_ms")
    return out.unionByName(df.filter(~has_key).withColumn("drift_ms", F.lit(None).cast("long")))


def correct_drift_asof(
    df: DataFrame,
    heartbeats: DataFrame,
    ts_col: str = "event_ts_edge_ms",
    out_col: str = "event_ts_corrected",
    span_ms: int = 3_600_000,
) -> DataFrame:
    """As-of drift correction (J8 + P1 + P2)."""
    return apply_drift(asof_drift(df, heartbeats, ts_col, span_ms), "drift_ms", ts_col, out_col)


def drift_applied_sec(ts_ms_col: str = "event_ts_edge_ms", corrected_col: str = "event_ts_corrected") -> Column:
    """``edge_ms / 1000.0 - to_unixtime(corrected)`` in seconds."""
    return F.col(ts_ms_col).cast("double") / 1000.0 - F.unix_micros(F.col(corrected_col).cast("timestamp")) / 1e6
