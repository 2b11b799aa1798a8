"""Generations of files, Bloom filters and page bounds, uniqueness by fingerprints, progress history."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlake import sinks
from fleetlake.operators import datatests
from fleetlake.operators import maintenance as m
from fleetlake.sources.fixtures import Fixture
from fleetlake.sources.generations import generations, merged_schema, read_generations
from fleetlake.streaming import progress
from fleetlake.streaming.unique_state import UniqueState

SF = "/root/testdata/sf0.001"


# --- K7 ---------------------------------------------------------------------------------------------
def test_three_generations_read_as_one_table(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    spark.sql("select 1 a, cast(1.5 as float) b, named_struct('x', 1) s, array(1, 2) l, cast(3 as short) q, cast(1.25 as decimal(4,2)) d").write.parquet(f"{root}/g=1")
    spark.sql("select 5000000000 a, cast(2.5 as float) b, named_struct('x', 2, 'y', 'k') s, array(1L) l, 7 q, 'new' z").write.parquet(f"{root}/g=2")
    spark.sql("select 6 a, 3.25d b, named_struct('y', 'm', 'x', 3L) s, 4.5d q, cast(12345.678 as decimal(8,3)) d").write.parquet(f"{root}/g=3")
    assert generations(spark, root).agg(F.sum("files")).first()[0] == 3
    df = read_generations(spark, root)
    kinds = dict(df.dtypes)
    assert {k: kinds[k] for k in "abslqzd"} == {"a": "bigint", "b": "double", "s": "struct<x:bigint,y:string>", "l": "array<bigint>", "q": "double", "z": "string", "d": "decimal(8,3)"}
    got = {r.g: r for r in df.collect()}
    assert (got[1].a, got[1].b, tuple(got[1].s), got[1].l, got[1].q, got[1].z, str(got[1].d)) == (1, 1.5, (1, None), [1, 2], 3.0, None, "1.250")
    assert (got[2].a, got[2].b, tuple(got[2].s), got[2].l, got[2].q, got[2].z, got[2].d) == (5_000_000_000, 2.5, (2, "k"), [1], 7.0, "new", None)
    assert (got[3].a, got[3].b, tuple(got[3].s), got[3].l, got[3].q, str(got[3].d)) == (6, 3.25, (3, "m"), None, 4.5, "12345.678")
    assert df.filter("a > 4 and b > 2.4").count() == 2
    assert "PushedFilters: [IsNotNull(a), GreaterThan(a,4)" in df.filter("a > 4")._jdf.queryExecution().toString()


def test_types_without_a_wider_one(spark, tmp_dir):
    kinds = [StructType.fromDDL("s struct<x: string>"), StructType.fromDDL("s struct<x: int>")]
    with pytest.raises(ValueError, match="s.x: string and int"):
        merged_schema(kinds)
    with pytest.raises(ValueError, match="bigint and double"):
        merged_schema([StructType.fromDDL("a bigint"), StructType.fromDDL("a double")])
    assert merged_schema([]).fields == []


# --- P12, J1 ----------------------------------------------------------------------------------------
def _row_groups(spark, root):
    """(row group, Bloom filter of event_id, column) of every file, and a hash function."""
    j = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for path in [r[0] for r in spark.read.parquet(root).select("_metadata.file_path").distinct().collect()]:
        source = j.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(j.org.apache.hadoop.fs.Path(j.java.net.URI(path)), conf)
        reader = j.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        for block in reader.getFooter().getBlocks():
            columns = {c.getPath().toDotString(): c for c in block.getColumns()}
            bloom = reader.getBloomFilterDataReader(block).readBloomFilter(columns["event_id"])
            yield reader, block, columns, bloom
        reader.close()


def _rows_scanned(df):
    """Rows that the scans of a query gave to its filter."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_absent_id_reads_no_data_page(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tel")
    f = Fixture(spark, SF)
    sinks.append_commit(sinks.telemetry_layout(f.telemetry).withColumn("p_bucket", F.col("p_bucket") % 2).withColumn("p_hour", F.date_trunc("month", "p_hour")), root, "c1", ["p_hour", "p_bucket"])
    ids = [r.event_id for r in f.telemetry.select("event_id").limit(3).collect()]
    absent = ids[0][:-1] + "x"  # within the bounds of the column
    j = spark._jvm
    groups = hits = 0
    for _, _, _, bloom in _row_groups(spark, root):
        assert bloom is not None
        groups += 1
        assert not bloom.findHash(bloom.hash(j.org.apache.parquet.io.api.Binary.fromString(absent)))
        hits += bloom.findHash(bloom.hash(j.org.apache.parquet.io.api.Binary.fromString(ids[1])))
    assert groups >= 2 and 1 <= hits < groups + 1
    table = spark.read.parquet(root)
    assert _rows_scanned(table.filter(F.col("event_id") == absent)) == 0
    assert table.filter(F.col("event_id") == ids[1]).count() == 1
    # sorted compaction keeps the filters and gives every page its bounds on (device, time)
    assert m.sort_compact(spark, root, ["p_hour", "p_bucket", "commit_id"])["verified"] in (True,)
    bounds = 0
    for reader, _, columns, bloom in _row_groups(spark, root):
        assert bloom is not None
        for name in ("device_id", "event_ts_corrected"):
            bounds += reader.readColumnIndex(columns[name]) is not None
    assert bounds >= 2
    assert _rows_scanned(spark.read.parquet(root).filter(F.col("event_id") == absent)) == 0


# --- D3 ---------------------------------------------------------------------------------------------
def test_unique_by_fingerprints_and_kept(spark, tmp_dir):
    batches = [["device-1:s-1:1", "device-1:s-1:2", None, "x"], ["device-1:s-1:2", "device-2:s-1:1", None], ["x", "x", "y"]]
    state = UniqueState(os.path.join(tmp_dir, "u"), "event_id", buckets=64)
    assert state.summary(spark).first().asDict() == {"keys": 0, "repeated": 0}
    held = []
    for k, keys in enumerate(batches):
        held += keys
        state.apply(spark, spark.createDataFrame([(x,) for x in keys], "event_id string"))
        table = spark.createDataFrame([(x,) for x in held], "event_id string")
        want = {r[0]: r[1] for r in table.filter("event_id is not null").groupBy("event_id").count().filter("count > 1").collect()}
        assert {r[0]: r[1] for r in datatests.check_unique(table, "event_id").collect()} == want
        assert {r[0]: r[1] for r in state.failing_keys(spark, table).collect()} == want
        assert state.summary(spark).first().repeated == len(want)
        at = [r.at for r in state.state.manifest(spark, "keys", k).collect()]
        assert at.count(k) <= len({x.rsplit(":", 1)[0] for x in keys if x})


def test_unique_shuffles_fingerprints(spark):
    plan = datatests.check_unique(Fixture(spark, SF).telemetry, "event_id")._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning(_fingerprint" in plan


# --- W5 ---------------------------------------------------------------------------------------------
def test_progress_history_adds_up(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "history")
    assert progress.progress_history(spark, root).count() == 0
    for k in range(3):
        spark.range(10 * (k + 1)).write.mode("append").parquet(src)
    listener = progress.start_history(spark, root)
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 4).parquet(src)
        q = stream.writeStream.queryName("counted").format("noop").option("checkpointLocation", os.path.join(tmp_dir, "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        end = time.time() + 30
        while time.time() < end and not (os.path.isdir(root) and progress.progress_history(spark, root).filter("kind = 'terminated'").count()):
            time.sleep(0.3)
    finally:
        spark.streams.removeListener(listener)
    history = progress.progress_history(spark, root)
    batches = history.filter("kind = 'progress' and numInputRows > 0").collect()
    assert len(batches) > 2 and sum(r.numInputRows for r in batches) == 60
    assert len({r.batchId for r in batches}) == len(batches)
    (total,) = progress.batch_totals(history).collect()
    assert (total.name, total.input_rows, total.batches) == ("counted", 60, len(batches))
    assert history.filter("kind = 'terminated'").first().exception is None
