"""Table maintenance for plain-Parquet tables.

Metadata comes from Spark itself: ``_metadata.file_path`` /
``_metadata.file_size`` of a scan give per-file statistics, computed by
the executors (no driver-side listing loop).

Compaction is a Spark rewrite of whole partitions: the rows are first
written to a staging folder under the shared checkpoint folder and compared
with the source, then written over their partitions.  If the second write is
interrupted, ``publish`` repeats it from the staging folder.  A table with a
catalog format's own rewrite procedure should use that instead.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.functions import rules
from fleetlake.functions.formats import file_health_label, format_size
from fleetlake.functions.time import as_timestamp
from fleetlake.session import shared_path
from fleetlake.sinks import LOOKUP_OPTIONS
from fleetlake.sources.tables import read_if_exists


# ------------------------------------------------------------------ M1 / A19
def file_listing(df: DataFrame) -> DataFrame:
    """One row per data file of a scan: file_path, file_size, record_count."""
    return df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size").agg(
        F.count(F.lit(1)).alias("record_count")
    )


def file_stats(df: DataFrame) -> DataFrame:
    """Count, total/avg/min/max size, total records (0 on empty)."""
    files = file_listing(df)
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("total_bytes"),
        F.coalesce(F.avg("file_size"), F.lit(0.0)).alias("avg_bytes"),
        F.coalesce(F.min("file_size"), F.lit(0)).cast("long").alias("min_bytes"),
        F.coalesce(F.max("file_size"), F.lit(0)).cast("long").alias("max_bytes"),
        F.coalesce(F.sum("record_count"), F.lit(0)).cast("long").alias("total_records"),
    )


def file_health(df: DataFrame, table: str, log: DataFrame | None = None) -> DataFrame:
    """M1: A19 + P23 + P24 as one report row for ``table``; ``snapshots`` is the
    number of its commits in the batch log (NULL without a log)."""
    s = file_stats(df)
    commits = F.lit(None).cast("long") if log is None else log.filter(F.col("table_name") == table).agg(F.count(F.lit(1))).scalar()
    return s.select(
        F.lit(table).alias("table"),
        commits.alias("snapshots"),
        F.col("file_count").alias("files"),
        format_size(F.col("total_bytes")).alias("total_size"),
        format_size(F.col("avg_bytes")).alias("avg_file_size"),
        format_size(F.col("min_bytes")).alias("min_file_size"),
        format_size(F.col("max_bytes")).alias("max_file_size"),
        F.col("total_records"),
        file_health_label(F.col("file_count"), F.col("avg_bytes")).alias("assessment"),
    )


# ------------------------------------------------------------------ M4
def partition_stats(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """M4: rows, files and bytes per partition of a table laid out by
    ``partition_cols`` (a file then lies in one partition; over columns that
    are not the layout a file counts in every group it has rows of)."""
    per_file = df.groupBy(*partition_cols, "_metadata.file_path", "_metadata.file_size").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_file.groupBy(*partition_cols).agg(
        F.sum("n").cast("long").alias("record_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.sum("file_size").cast("long").alias("total_bytes"),
    )


# ------------------------------------------------------------------ M2 / M5
def content_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-independent hash of all rows (partial aggregates)."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"))


def fragmented(df: DataFrame, partition_cols: list[str], threshold_bytes: int = rules.COMPACT_THRESHOLD_BYTES) -> DataFrame:
    """Partitions that hold two or more files below the threshold, with their bytes."""
    per_file = df.groupBy(*partition_cols, "_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    small = F.count(F.when(F.col("file_size") < threshold_bytes, 1))
    return per_file.groupBy(*partition_cols).agg(small.alias("small_files"), F.sum("file_size").alias("bytes")).filter(F.col("small_files") > 1)


def publish(spark: SparkSession, staging: str, root: str, partition_cols: list[str], sorted_by: list[str] | None = None) -> None:
    """Write the staged rows over their partitions of ``root``; other partitions
    stay as they are.  May be repeated."""
    rows = spark.read.parquet(staging)
    if not sorted_by:
        rows = rows.hint("rebalance", *partition_cols)
    rows.write.mode("overwrite").options(**LOOKUP_OPTIONS).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(root)


def compact_small_files(
    spark: SparkSession,
    root: str,
    partition_cols: list[str],
    target_bytes: int = rules.COMPACT_TARGET_BYTES,
    threshold_bytes: int = rules.COMPACT_THRESHOLD_BYTES,
    sort_cols: list[str] | None = None,
) -> dict:
    """M2 (+ M5 with ``sort_cols``): rewrite the partitions of ``root`` that hold
    two or more files below ``threshold_bytes``; partitions of large files are
    not touched.  Do not run it on a partition that is still written to: the
    closed hours of a stream go through ``compact_hours``.

    With ``sort_cols`` rows are dealt by ranges of (partition, sort columns)
    into pieces of about ``target_bytes``, so each file covers a range and can
    be pruned, and within a file each page has its own bounds; otherwise by partition, large ones over several tasks.
    """
    src = spark.read.parquet(root)
    todo = fragmented(src, partition_cols, threshold_bytes)
    found = todo.agg(F.count(F.lit(1)).alias("partitions"), F.sum("bytes").alias("bytes")).first()
    if not found["partitions"]:
        return {"partitions": 0, "rows": 0, "verified": True}
    rows = src.join(todo.select(*partition_cols), partition_cols, "left_semi").select(*src.columns)
    staging = shared_path(spark, f"compact-{uuid.uuid4().hex}")
    if sort_cols:
        pieces = max(found["partitions"], math.ceil(found["bytes"] / target_bytes))
        staged = rows.repartitionByRange(pieces, *partition_cols, *sort_cols).sortWithinPartitions(*partition_cols, *sort_cols)
    else:
        staged = rows.hint("rebalance", *partition_cols)
    staged.write.parquet(staging)
    before, after = (content_fingerprint(x).first() for x in (rows, spark.read.parquet(staging)))
    if before != after:
        return {"partitions": found["partitions"], "rows": after["rows"], "verified": False, "staging": staging}
    publish(spark, staging, root, partition_cols, sort_cols)
    return {"partitions": found["partitions"], "rows": after["rows"], "verified": True, "staging": staging}


def bins_of(df: DataFrame, target_bytes: int, threshold_bytes: int) -> DataFrame:
    """(file_path, folder, bin_id, file_size) of the files below the threshold that share a folder with
    another one: bins are filled in the order of the paths until they reach ``target_bytes``, so a bin
    holds less than target + threshold, and a folder gets at most ceil(bytes / target) of them.
    Bins of a single file are left out: rewriting it would gain nothing."""
    small = df.filter(F.col("_metadata.file_size") < F.lit(threshold_bytes))  # other files are not opened
    files = small.select("_metadata.file_path", "_metadata.file_size").distinct().withColumn("folder", F.regexp_replace("file_path", "/[^/]*$", ""))
    before = F.sum("file_size").over(Window.partitionBy("folder").orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1))
    binned = files.withColumn("bin_id", F.concat(F.md5("folder"), F.lit("-"), F.floor(F.coalesce(before, F.lit(0)) / F.lit(target_bytes)).cast("string")))
    several = F.count(F.lit(1)).over(Window.partitionBy("bin_id")) > 1
    return binned.withColumn("_several", several).filter("_several").drop("_several")


def _replace_files(batches):
    """Move each bin's staged file beside the files that it replaces, then delete those.  Every step
    may be run again."""
    import pyarrow as pa
    from pyarrow import fs

    def opened(path):
        if path.startswith("file:"):
            from urllib.parse import unquote

            return fs.LocalFileSystem(), "/" + unquote(path.split(":", 1)[1]).lstrip("/")
        return fs.FileSystem.from_uri(path)

    for batch in batches:
        names, counts = [], []
        for row in batch.to_pylist():
            system, staged = opened(row["staged"])
            _, folder = opened(row["folder"])
            target = f"{folder}/part-{row['bin_id']}-{row['run']}.parquet"
            if system.get_file_info(target).type == fs.FileType.NotFound:
                system.move(staged, target)
            gone = 0
            for old in row["old"]:
                _, name = opened(old)
                if system.get_file_info(name).type != fs.FileType.NotFound:
                    system.delete_file(name)
                    gone += 1
                crc = "/".join([*name.split("/")[:-1], f".{name.split('/')[-1]}.crc"])
                if system.get_file_info(crc).type != fs.FileType.NotFound:
                    system.delete_file(crc)
            names.append(target)
            counts.append(gone)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["file_path", "replaced"])


def compact_bins(
    spark: SparkSession,
    root: str,
    partition_cols: list[str],
    target_bytes: int = rules.COMPACT_TARGET_BYTES,
    threshold_bytes: int = rules.COMPACT_THRESHOLD_BYTES,
    sort_cols: list[str] | None = None,
) -> dict:
    """M2 by bin packing: in each folder of ``root`` the files below ``threshold_bytes`` are packed into
    bins of about ``target_bytes``, and every bin becomes one file, written by one task.  Other files
    are neither read nor rewritten.

    The bins are staged and compared with their source first; then each staged file is moved into its
    folder and the files that it replaces are deleted, by tasks.  A run that is lost in between is
    finished by ``replace_staged`` on its staging folder; until then a reader may see rows of a bin
    twice, so closed partitions only (hours a stream still writes go through ``compact_hours``).
    """
    src = spark.read.parquet(root)
    run = uuid.uuid4().hex
    staging = shared_path(spark, f"bins-{run}")
    bins_of(src, target_bytes, threshold_bytes).write.parquet(f"{staging}/plan")
    plan = spark.read.parquet(f"{staging}/plan")
    found = plan.agg(F.count_distinct("bin_id").alias("bins"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")).first()
    result = {"bins": found["bins"], "files": found["files"], "bytes": found["bytes"], "rows": 0, "verified": True, "staging": staging}
    if not found["bins"]:
        return result
    small = src.filter(F.col("_metadata.file_size") < F.lit(threshold_bytes)).select("*", F.col("_metadata.file_path").alias("_path"))
    data = [c for c in src.columns if c not in partition_cols]
    rows = small.join(plan.select(F.col("file_path").alias("_path"), "bin_id"), "_path").select(*data, "bin_id")
    dealt = rows.repartition(found["bins"], "bin_id").sortWithinPartitions("bin_id", *(sort_cols or []))
    dealt.write.options(**LOOKUP_OPTIONS).partitionBy("bin_id").parquet(f"{staging}/data")
    staged = spark.read.schema(rows.schema).parquet(f"{staging}/data")
    before, after = (content_fingerprint(x).first() for x in (rows, staged))
    if before != after:
        return result | {"rows": after["rows"], "verified": False}
    replace_staged(spark, staging, run)
    spark.catalog.refreshByPath(root)
    return result | {"rows": after["rows"]}


def replace_staged(spark: SparkSession, staging: str, run: str) -> DataFrame:
    """(file_path, replaced) of the bins of a staged compaction put in place; may be repeated."""
    plan = spark.read.parquet(f"{staging}/plan").groupBy("bin_id").agg(F.first("folder").alias("folder"), F.collect_list("file_path").alias("old"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{staging}/data")
    staged = files.select(F.col("path").alias("staged"), F.regexp_extract("path", "bin_id=([^/]+)/", 1).alias("bin_id"))
    # written first, so that no step depends on a listing that the moves change
    todo = plan.join(staged, "bin_id").withColumn("run", F.lit(run))
    path = f"{staging}/moves"
    if read_if_exists(spark, path) is None:
        todo.write.parquet(path)
    done = spark.read.parquet(path).mapInArrow(_replace_files, "file_path string, replaced long")
    done.write.mode("overwrite").parquet(f"{staging}/done")
    return spark.read.parquet(f"{staging}/done")


def sort_compact(spark: SparkSession, root: str, partition_cols: list[str],
                 sort_cols: tuple[str, ...] = ("device_id", "event_ts_corrected"), **kw) -> dict:
    """M5: compaction that also sorts each partition by (device, time)."""
    return compact_small_files(spark, root, partition_cols, sort_cols=list(sort_cols), **kw)


def compact_hours(
    committed: DataFrame,
    target_root: str,
    start,
    end,
    partition_cols: list[str],
    sort_cols: list[str] | None = None,
) -> None:
    """M2 for a table a stream still appends to: the committed rows of the closed
    hours [start, end) as partitions of the compact table ``target_root``.

    ``committed`` comes from ``read_committed``, so rows of failed attempts are
    never taken up.  An hour is written whole and replaces its earlier version;
    after late rows, run it again for their hours.  Read closed hours from
    the compact table and open ones from the stream's (``read_hours``).
    """
    rows = committed.filter((F.col("p_hour") >= as_timestamp(start)) & (F.col("p_hour") < as_timestamp(end)))
    if sort_cols:
        rows = rows.repartitionByRange(*partition_cols, *sort_cols).sortWithinPartitions(*partition_cols, *sort_cols)
    else:
        rows = rows.hint("rebalance", *partition_cols)
    rows.write.mode("overwrite").options(**LOOKUP_OPTIONS).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(target_root)


def read_hours(compact: DataFrame, committed: DataFrame, open_from) -> DataFrame:
    """Hours before ``open_from`` from the compact table, the others from the stream's table."""
    cut = as_timestamp(open_from)
    return compact.filter(F.col("p_hour") < cut).unionByName(committed.filter(F.col("p_hour") >= cut))


# ------------------------------------------------------------------ M3 / T5
def commit_log(spark: SparkSession, log_path: str, table: str | None = None, limit: int = 5) -> DataFrame:
    """M3 + T5: most recent batch commits."""
    log = spark.read.parquet(log_path)
    if table:
        log = log.filter(F.col("table_name") == table)
    return log.orderBy(F.col("committed_at").desc(), F.col("batch_id").desc()).limit(limit)


# ------------------------------------------------------------------ M6
def find_unreferenced_files(spark: SparkSession, root: str, log: DataFrame, older_than_days: int = 7, now=None) -> DataFrame:
    """M6: data files below ``root`` whose attempt (``commit_id=...`` in their
    path) is in no row of ``log`` and that are older than ``older_than_days``:
    what failed attempts left.  Report only; deletion is left to the storage's
    lifecycle rules.  The listing reads file metadata only (``content`` is
    never selected); attempt ids hold no character that a path encodes.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(F.col("path").alias("file_path"), "modificationTime", "length", F.regexp_extract("path", "commit_id=([^/]+)/", 1).alias("commit_id"))
    )
    cutoff = (as_timestamp(now) if now is not None else F.current_timestamp()) - F.expr(f"INTERVAL {int(older_than_days)} DAYS")
    return listing.join(log.select("commit_id"), "commit_id", "left_anti").filter(F.col("modificationTime") < cutoff)
