"""Model build: bronze -> silver -> gold as written tables, then data tests.

The reference builds its models with a SQL templating tool; here the model
DAG is function composition (``silver`` and ``gold`` builders) and
``run_models`` writes each model once, in dependency order, reading the
*written* upstream model (so each model's lineage is cut at a table in the
shared folder, and a lost executor only recomputes its own stage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlake import sinks
from fleetlake.operators import datatests
from fleetlake.plans import gold, silver


def run_models(
    spark: SparkSession,
    telemetry: DataFrame,
    blobs: DataFrame,
    out_root: str,
) -> dict[str, str]:
    """K5: materialise telemetry_validated, blob_linked, device_hourly_stats and
    linkage_report under ``out_root``; returns model name -> path."""
    out_root = out_root.rstrip("/")
    paths = {
        name: f"{out_root}/{name}"
        for name in ("telemetry_validated", "blob_linked", "device_hourly_stats", "linkage_report")
    }
    sinks.materialize(silver.telemetry_validated(telemetry), path=paths["telemetry_validated"])
    validated = spark.read.parquet(paths["telemetry_validated"])
    sinks.materialize(silver.blob_linked(blobs, telemetry), path=paths["blob_linked"])
    sinks.materialize(gold.device_hourly_stats(validated), path=paths["device_hourly_stats"])
    sinks.materialize(gold.linkage_report(telemetry, blobs, ordered=False), path=paths["linkage_report"])
    return paths


def check_models(
    spark: SparkSession,
    telemetry: DataFrame,
    blobs: DataFrame,
    paths: dict[str, str],
) -> DataFrame:
    """D4 over the bronze sources and the written models."""
    tables = {
        "telemetry_events": telemetry,
        "blob_index": blobs,
        "telemetry_validated": spark.read.parquet(paths["telemetry_validated"]),
        "blob_linked": spark.read.parquet(paths["blob_linked"]),
    }
    return datatests.run_data_tests(tables)
