"""Physical-plan shape: pushdown, pruning, partial aggregation, exchanges."""

import os
import re

import pytest

from fleetlake.operators import linkage
from fleetlake.plans import gold, silver
from fleetlake.sources.fixtures import Fixture
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    f = Fixture(spark, SF_SMALL)
    f.telemetry.write.parquet(os.path.join(root, "t"))
    f.blobs.write.parquet(os.path.join(root, "b"))
    return spark.read.parquet(os.path.join(root, "t")), spark.read.parquet(os.path.join(root, "b"))


def test_silver_filter_pushed_to_scan(bronze):
    tel, _ = bronze
    plan = _plan(silver.telemetry_validated(tel))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    for frag in ("GreaterThanOrEqual(temperature,-40.0)", "LessThanOrEqual(torque,300.0)",
                 "IsNotNull(event_ts_corrected)"):
        assert frag in pushed


def test_count_reads_only_needed_columns(bronze):
    tel, blobs = bronze
    plan = _plan(linkage.linkage_counts(tel, blobs))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        cols = {c.split(":")[0] for c in schema.split(",")}
        assert cols <= {"event_id", "ingest_ts"}


def test_partial_aggregation_before_shuffle(bronze):
    tel, _ = bronze
    plan = _plan(gold.device_hourly_stats(silver.telemetry_validated(tel)))
    assert plan.count("HashAggregate") >= 2 and "partial_" in plan


def test_key_join_adds_no_exchange(spark, bronze):
    tel, blobs = bronze
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(linkage.linkage_counts(tel, blobs))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one hash exchange per side (the key aggregations) + the final single-partition one
    assert len(re.findall(r"Exchange hashpartitioning\(event_id", plan)) == 2
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_no_python_udfs_anywhere(spark, bronze):
    from fleetlake.plans import registry

    registry.load_all()
    for name, fn in registry.QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        assert not re.search("BatchEvalPython|ArrowEvalPython|MapInArrow|FlatMap", plan), name
