"""The training-data pipeline over ``documents``; each stage is one of the operators of ``fleetlake.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm import stages
from fleetlake.llm.common import scratch_path

#: (name, function(spark, docs, sf_dir) -> DataFrame), in order.
STAGES = stages.STAGES

#: Language models, near-duplicate search and tokenisation are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``; what a stage returns is written and read
    again, so each stage starts from files."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
