"""Registered queries over state that is kept batch by batch: whole tables, applied as the rows up to the
middle of the ingest times and the rows after it.  Buckets are few, as for tables of this size; the state's
defaults are for a fleet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators import drift
from fleetlake.plans import queries_drift, queries_linkage, registry
from fleetlake.plans.registry import register
from fleetlake.session import shared_path
from fleetlake.sources.fixtures import Fixture
from fleetlake.streaming.drift_state import DriftState
from fleetlake.streaming.gold_state import GoldState
from fleetlake.streaming.report_state import ReportState


def _in_two_batches(spark: SparkSession, f: Fixture, state) -> None:
    ends = f.telemetry.agg(F.min(F.unix_micros(F.col("ingest_ts").cast("timestamp"))).alias("a"), F.max(F.unix_micros(F.col("ingest_ts").cast("timestamp"))).alias("b")).first()
    early = F.unix_micros(F.col("ingest_ts").cast("timestamp")) <= F.lit(((ends["a"] or 0) + (ends["b"] or 0)) // 2)
    for part in (early, ~early):
        state.apply(spark, f.telemetry.filter(part), f.blobs.filter(part))


def _scratch(spark: SparkSession, name: str) -> str:
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("reconcile_report_kept", registry.ORACLES["reconcile_report"])
def q_reconcile_report_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17 from the kept state; equal to the report over whole tables."""
    f = Fixture(spark, sf_dir)
    state = ReportState(_scratch(spark, "kept-report"), buckets=8)
    _in_two_batches(spark, f, state)
    return state.reconcile_report(spark, queries_linkage.fixture_now(f)).withColumn("media_breakdown", F.to_json("media_breakdown"))


@register("quality_report_kept", registry.ORACLES["quality_report"])
def q_quality_report_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A18 from the kept state; equal to the report over whole tables."""
    f = Fixture(spark, sf_dir)
    state = ReportState(_scratch(spark, "kept-report"), buckets=8)
    _in_two_batches(spark, f, state)
    return queries_linkage.quality_columns(state.quality_report(spark, queries_linkage.fixture_now(f)))


@register("linkage_report_kept", registry.ORACLES["linkage_report"])
def q_linkage_report_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 from hourly partials that take late rows."""
    f = Fixture(spark, sf_dir)
    state = GoldState(_scratch(spark, "kept-gold"), hours=168)
    _in_two_batches(spark, f, state)
    return state.linkage_report(spark)


@register("correct_drift_asof_kept", registry.ORACLES["correct_drift_asof"])
def q_correct_drift_asof_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of drift from kept points: the later half of the heartbeats first, then the earlier, late ones."""
    f = Fixture(spark, sf_dir)
    state = DriftState(_scratch(spark, "kept-drift"), slots=4, span_ms=7 * 86_400_000)
    ends = f.heartbeats.agg(F.min("server_ts_ms").alias("a"), F.max("server_ts_ms").alias("b")).first()
    late = F.col("server_ts_ms") <= F.lit(((ends["a"] or 0) + (ends["b"] or 0)) // 2)
    for k, part in enumerate((~late, late)):
        state.apply(spark, f.heartbeats.filter(part), k)
    tagged = state.asof_drift(f.telemetry.drop("event_ts_corrected"))
    return drift.apply_drift(tagged).select(*queries_drift._OUT)
