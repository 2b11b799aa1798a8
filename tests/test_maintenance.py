"""Table maintenance: file health, compaction swap, partition stats, unreferenced files."""

import os

from pyspark.sql import functions as F

from fleetlake import sinks
from fleetlake.functions.formats import file_health_label, format_size
from fleetlake.operators import maintenance as m
from fleetlake.sources.fixtures import Fixture
from tests.conftest import SF_SMALL


def _small_table(spark, root):
    tel = sinks.telemetry_layout(Fixture(spark, SF_SMALL).telemetry)
    # many tiny files: one per (task, partition)
    tel.repartition(16).write.partitionBy("p_bucket").parquet(root)
    return spark.read.parquet(root)


def test_format_size_and_label(spark):
    df = spark.createDataFrame([(0,), (900,), (1024,), (1280,), (1536,), (5 * 1024 * 1024 + 1,)], "b long")
    got = [r[0] for r in df.select(format_size(F.col("b"))).collect()]
    want = []
    for b in [0, 900, 1024, 1280, 1536, 5 * 1024 * 1024 + 1]:
        if b >= 1024 * 1024:
            want.append(f"{b / (1024 * 1024):.1f} MB")
        elif b >= 1024:
            want.append(f"{b / 1024:.1f} KB")
        else:
            want.append(f"{b} B")
    assert got == want
    lab = spark.createDataFrame([(0, 0.0), (3, 1000.0), (3, 100_000.0), (3, 2e6)], "f long, a double")
    assert [r[0] for r in lab.select(file_health_label(F.col("f"), F.col("a"))).collect()] == [
        "OK", "SMALL_FILES", "COMPACTION_RECOMMENDED", "OK"]


def _files(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_file_health_and_compaction(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tel")
    df = _small_table(spark, root)
    n = df.count()
    (before,) = m.file_health(df, "telemetry_events").collect()
    assert before["total_records"] == n and before["files"] > 50
    assert before["assessment"] == "SMALL_FILES"
    content = m.content_fingerprint(df).first()
    res = m.compact_small_files(spark, root, ["p_bucket"], target_bytes=1 << 20)
    assert res["verified"] and res["rows"] == n
    cur = spark.read.parquet(root)
    assert m.content_fingerprint(cur).first() == content
    (after,) = m.file_health(cur, "telemetry_events").collect()
    assert after["files"] == res["partitions"] < before["files"]
    # nothing left to do; large files are never touched
    assert m.compact_small_files(spark, root, ["p_bucket"])["partitions"] == 0
    # the second write may be repeated from the staged rows
    m.publish(spark, res["staging"], root, ["p_bucket"])
    assert m.content_fingerprint(spark.read.parquet(root)).first() == content


def test_compaction_leaves_partitions_of_large_files(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tel")
    df = _small_table(spark, root)
    smallest = df.select("_metadata.file_size").agg(F.min("file_size")).first()[0]
    files = _files(df)
    assert m.compact_small_files(spark, root, ["p_bucket"], threshold_bytes=smallest)["partitions"] == 0
    assert _files(spark.read.parquet(root)) == files


def test_sorted_compaction_gives_files_of_distinct_ranges(spark, tmp_dir):
    root = os.path.join(tmp_dir, "sorted")
    tel = Fixture(spark, SF_SMALL).telemetry.withColumn("p_all", F.lit(1))
    tel.repartition(12).write.partitionBy("p_all").parquet(root)
    total = spark.read.parquet(root).agg(F.sum("_metadata.file_size")).first()[0]
    size = m.file_stats(spark.read.parquet(root)).first()["total_bytes"]
    assert size <= total
    assert m.sort_compact(spark, root, ["p_all"], target_bytes=size // 4)["verified"]
    spans = spark.read.parquet(root).groupBy("_metadata.file_path").agg(F.min("device_id").alias("a"), F.max("device_id").alias("b")).orderBy("a", "b").collect()
    assert len(spans) > 2
    assert all(x["b"] <= y["a"] for x, y in zip(spans[:-1], spans[1:], strict=True))


def test_unreferenced_files_are_those_of_failed_attempts(spark, tmp_dir):
    root, rej, log = (os.path.join(tmp_dir, d) for d in ("t", "r", "l"))
    tel = Fixture(spark, SF_SMALL).telemetry.withColumn("is_valid", F.lit(True)).withColumn("errors", F.array().cast("array<string>"))
    rows = sinks.telemetry_layout(tel).withColumn("p_bucket", F.col("p_bucket") % 2).filter("p_hour < timestamp '2024-01-05 00:00:00'")
    parts = ["p_hour", "p_bucket"]
    sinks.write_batch_with_rejects(rows, 0, root, rej, log, parts)
    committed = {p.split("commit_id=")[1].split("/")[0] for p in _files(spark.read.parquet(root))}
    found = m.find_unreferenced_files(spark, root, sinks.read_log(spark, log, "telemetry_events"), 0, now="2999-01-01")
    assert found.count() == 0  # every file is live, hours and all
    sinks.write_batch_with_rejects(rows.limit(40), 1, root, rej, None, parts)  # an attempt that was never logged
    found = m.find_unreferenced_files(spark, root, sinks.read_log(spark, log, "telemetry_events"), 0, now="2999-01-01")
    got = {r["commit_id"] for r in found.collect()}
    assert len(got) == 1 and not got & committed
    assert m.find_unreferenced_files(spark, root, sinks.read_log(spark, log, "telemetry_events"), 7).count() == 0


def test_file_health_counts_commits(spark, tmp_dir):
    root, rej, log = (os.path.join(tmp_dir, d) for d in ("t", "r", "l"))
    df = spark.createDataFrame([(1, True, [])], "x int, is_valid boolean, errors array<string>")
    for i in range(3):
        sinks.write_batch_with_rejects(df, i, root, rej, log)
    rows = spark.read.parquet(root)
    assert m.file_health(rows, "telemetry_events", sinks.read_log(spark, log, "telemetry_events")).first()["snapshots"] == 3
    assert m.file_health(rows, "telemetry_events").first()["snapshots"] is None


def test_partition_stats(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tel")
    df = _small_table(spark, root)
    stats = m.partition_stats(df, ["p_bucket"])
    total = stats.agg(F.sum("record_count")).collect()[0][0]
    assert total == df.count()
    assert stats.filter(F.col("file_count") < 1).count() == 0


def test_commit_log_order(spark, tmp_dir):
    import datetime as dt

    path = os.path.join(tmp_dir, "log")
    rows = [(i, 10, 0, dt.datetime(2024, 1, 1, 0, i)) for i in range(8)]
    spark.createDataFrame(rows, "batch_id long, rows long, rejected long, committed_at timestamp").write.parquet(
        f"{path}/table_name=telemetry_events"
    )
    got = [r["batch_id"] for r in m.commit_log(spark, path, "telemetry_events").collect()]
    assert got == [7, 6, 5, 4, 3]


def test_device_hour_filter_prunes_partitions(spark, tmp_dir):
    root = os.path.join(tmp_dir, "lay")
    tel = sinks.telemetry_layout(Fixture(spark, SF_SMALL).telemetry)
    sinks.materialize(tel, path=root, partition_cols=["p_hour", "p_bucket"])
    df = spark.read.parquet(root)
    cond = sinks.device_hour_filter("device-042", "2024-01-01 00:00:00", "2024-01-31 00:00:00")
    plan = df.filter(cond)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "p_bucket" in plan
    want = Fixture(spark, SF_SMALL).telemetry.filter(
        (F.col("device_id") == "device-042")
        & (F.col("event_ts_corrected") > F.lit("2024-01-01 00:00:00").cast("timestamp"))
        & (F.col("event_ts_corrected") <= F.lit("2024-01-31 00:00:00").cast("timestamp"))
    ).count()
    assert df.filter(cond).count() == want


def test_schema_evolution_ddl(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS fl_test")
    sinks.create_bronze_tables(spark, "fl_test", location=os.path.join(tmp_dir, "wh"))
    assert "telemetry_events" in {r["tableName"] for r in spark.sql("SHOW TABLES IN fl_test").collect()}
    assert sinks.evolve_table(spark, "fl_test.telemetry_events", "firmware_version", "STRING")
    assert not sinks.evolve_table(spark, "fl_test.telemetry_events", "firmware_version", "STRING")
    cols = [c.name for c in spark.catalog.listColumns("fl_test.telemetry_events")]
    assert "firmware_version" in cols
    spark.sql("DROP TABLE fl_test.telemetry_events")
    spark.sql("DROP TABLE fl_test.blob_index")


def test_compact_closed_hours_of_a_streamed_table(spark, tmp_dir):
    import datetime as dt

    root, rej, log, compact = (os.path.join(tmp_dir, d) for d in ("t", "r", "l", "c"))
    tel = Fixture(spark, SF_SMALL).telemetry.withColumn("is_valid", F.lit(True)).withColumn("errors", F.array().cast("array<string>"))
    rows = sinks.telemetry_layout(tel).withColumn("p_bucket", F.lit(0)).filter("p_hour < timestamp '2024-01-04 00:00:00'")
    for i, part in enumerate(rows.randomSplit([1.0] * 4, seed=3)):
        sinks.write_batch_with_rejects(part, i, root, rej, log, ["p_hour", "p_bucket"])
    sinks.write_batch_with_rejects(rows.limit(25), 4, root, rej, None, ["p_hour", "p_bucket"])  # failed before its log row

    def committed():
        return sinks.read_committed(spark, root, log, "telemetry_events")

    cut = dt.datetime(2024, 1, 3)
    m.compact_hours(committed(), compact, dt.datetime(2024, 1, 1), cut, ["p_hour", "p_bucket"])
    table = spark.read.parquet(compact)
    assert len(_files(table)) == table.select("p_hour").distinct().count()
    assert m.read_hours(table, committed(), cut).count() == rows.count()
    # the failed batch is replayed: its rows are taken up, old hours included
    sinks.write_batch_with_rejects(rows.limit(25), 4, root, rej, log, ["p_hour", "p_bucket"])
    for _ in range(2):  # repeating it changes nothing
        m.compact_hours(committed(), compact, dt.datetime(2024, 1, 1), cut, ["p_hour", "p_bucket"])
        assert m.read_hours(spark.read.parquet(compact), committed(), cut).count() == rows.count() + 25


def test_bins_rewrite_small_files_only(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tel")
    df = _small_table(spark, root)
    spark.range(20_000).select(F.lit(0).alias("p_bucket"), *[(F.lit(None) if c not in ("n",) else F.col("id")).cast(t).alias(c) for c, t in df.drop("p_bucket").dtypes]).coalesce(1).write.mode("append").partitionBy("p_bucket").parquet(root)
    src = spark.read.parquet(root)
    listing = {r["file_path"]: r["file_size"] for r in m.file_listing(src).collect()}
    content = m.content_fingerprint(src).first()
    largest = max(listing.values())
    threshold = sorted(listing.values())[-2] + 1
    assert largest > threshold
    target = 3 * threshold
    res = m.compact_bins(spark, root, ["p_bucket"], target_bytes=target, threshold_bytes=threshold)
    assert res["verified"] and res["bytes"] <= sum(n for n in listing.values() if n < threshold)
    cur = spark.read.parquet(root)
    assert m.content_fingerprint(cur).first() == content
    after = {r["file_path"]: r["file_size"] for r in m.file_listing(cur).collect()}
    (big,) = [p for p, n in listing.items() if n == largest]
    assert after[big] == largest  # untouched
    by_folder = {}
    for p, n in listing.items():
        by_folder.setdefault(os.path.dirname(p), []).append(n)
    for folder, sizes in by_folder.items():
        now = [p for p in after if os.path.dirname(p) == folder]
        small = sum(n for n in sizes if n < threshold)
        assert len(now) <= -(-small // target) + 1 + len([n for n in sizes if n >= threshold])
    assert res["bins"] == len([p for p in after if p not in listing])
    # put in place again: nothing changes
    m.replace_staged(spark, res["staging"], "other")
    spark.catalog.refreshByPath(root)
    assert m.content_fingerprint(spark.read.parquet(root)).first() == content


def test_bins_of_an_empty_plan(spark, tmp_dir):
    root = os.path.join(tmp_dir, "one")
    spark.range(5).withColumn("p", F.lit(1)).coalesce(1).write.partitionBy("p").parquet(root)
    assert m.compact_bins(spark, root, ["p"])["bins"] == 0
