"""Stream monitoring, the streaming link-status join and periodic reports
(W5, W8 stream form, W9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlake import sinks
from fleetlake.functions import rules


def stream_progress(spark: SparkSession, queries: dict[str, StreamingQuery]) -> DataFrame:
    """One row per query: name, batch id, input rows, rows/s (from ``lastProgress``).

    This is query metadata (one small record per query), not data."""
    rows = []
    for name, q in queries.items():
        p = q.lastProgress or {}
        rows.append(
            (
                name,
                bool(q.isActive),
                p.get("batchId"),
                p.get("numInputRows"),
                float(p.get("processedRowsPerSecond") or 0.0),
            )
        )
    return spark.createDataFrame(
        rows, "query_name string, is_active boolean, batch_id long, num_input_rows long, rows_per_sec double"
    )


def link_status_stream(
    telemetry: DataFrame,
    blobs: DataFrame,
    timeout_minutes: int = rules.ORPHAN_TIMEOUT_MINUTES,
    blob_lead_minutes: int | None = None,
) -> DataFrame:
    """W8 (stream): stream-stream LEFT OUTER join telemetry -> blobs on
    event_id within ``[ingest_ts - lead, ingest_ts + timeout]``; a blob may lead
    by as much as it may lag unless ``blob_lead_minutes`` says otherwise.

    Matched rows are emitted as LINKED as soon as both sides arrived;
    telemetry with no blob inside the bound is emitted as ORPHANED once the
    watermark passes the bound.  State is bounded by the watermarks: it
    holds only rows younger than the timeout.  The batch
    ``assign_link_status`` stays authoritative (an emitted ORPHANED row
    cannot be recalled if a blob arrives later).
    """
    lead = timeout_minutes if blob_lead_minutes is None else blob_lead_minutes
    t = telemetry.select(
        F.col("event_id").alias("t_event_id"), "device_id", F.col("ingest_ts").alias("t_ingest_ts")
    ).withWatermark("t_ingest_ts", f"{timeout_minutes} minutes")
    b = blobs.select(F.col("event_id").alias("b_event_id"), F.col("ingest_ts").alias("b_ingest_ts")).withWatermark(
        "b_ingest_ts", f"{timeout_minutes} minutes"
    )
    cond = (
        (F.col("t_event_id") == F.col("b_event_id"))
        & (F.col("b_ingest_ts") >= F.col("t_ingest_ts") - F.expr(f"INTERVAL {lead} MINUTES"))
        & (F.col("b_ingest_ts") <= F.col("t_ingest_ts") + F.expr(f"INTERVAL {timeout_minutes} MINUTES"))
    )
    j = t.join(b, cond, "leftOuter")
    return j.select(
        F.col("t_event_id").alias("event_id"),
        "device_id",
        F.col("t_ingest_ts").alias("ingest_ts"),
        F.when(F.col("b_event_id").isNotNull(), F.lit(rules.STATUS_LINKED))
        .otherwise(F.lit(rules.STATUS_ORPHANED))
        .alias("ingest_status"),
    )


def report_or_error(spark: SparkSession, build_report: Callable[[SparkSession], DataFrame], sink_path: str) -> None:
    """Append the report; a report that fails is itself reported, as one line
    with severity ERROR and the reason, and the next tick tries again.  A sink
    that cannot be written to still raises."""
    try:
        # a report is one row or a few
        lines = [(r["value"],) for r in build_report(spark).select(F.to_json(F.struct("*")).alias("value")).collect()]
    except Exception as exc:  # noqa: BLE001 - any failure of the check is its result
        reason = f"{type(exc).__name__}: {str(exc)[:2000]}"
        error = spark.range(1).select(
            F.current_timestamp().alias("timestamp_utc"), F.lit("ERROR").alias("overall_severity"), F.lit(reason).alias("error")
        )
        sinks.report_sink(error, sink_path)
        return
    spark.createDataFrame(lines, "value string").write.mode("append").text(sink_path)


def start_periodic_report(
    spark: SparkSession,
    build_report: Callable[[SparkSession], DataFrame],
    sink_path: str,
    checkpoint: str,
    interval_sec: int = 120,
    once: bool = False,
) -> StreamingQuery | None:
    """Run ``build_report`` over the current tables every ``interval_sec``
    and append its JSON line(s) to ``sink_path``.

    Scheduling is a Structured Streaming trigger over the built-in ``rate``
    source (one tick per batch); each batch runs the report as a normal
    batch job.  ``once=True`` runs a single report now and returns None.
    """
    if once:
        report_or_error(spark, build_report, sink_path)
        return None
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def run(_batch: DataFrame, _batch_id: int) -> None:
        report_or_error(spark, build_report, sink_path)

    w = ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return w.trigger(processingTime=f"{int(interval_sec)} seconds").start()
