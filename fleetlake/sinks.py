"""Table writes: streaming append, DDL, partition columns, materialisation,
report lines, additive schema evolution, reject side-output (K1-K8).

Plain Parquet directories are the default storage (no table-format jar is
needed); every function that takes a ``path`` also works with a catalog
table through ``table=``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructType

from fleetlake.functions import rules
from fleetlake.functions.time import hour_bucket
from fleetlake.sources.tables import read_if_exists


# ---------------------------------------------------------------- K4 layout
def bucket_of(col: str, buckets: int) -> Column:
    """Stable bucket number ``pmod(hash(col), buckets)``."""
    return F.pmod(F.hash(F.col(col)), F.lit(buckets)).cast("int")


def add_partition_columns(
    df: DataFrame,
    ts_col: str,
    buckets: int,
    key_col: str = "device_id",
) -> DataFrame:
    """K4: ``p_hour = date_trunc('hour', ts)``, ``p_bucket = hash(key) mod N``.

    Plain Parquet prunes only on stored partition columns, so the hidden
    transforms of a table format become explicit derived columns; the
    ``device_hour_filter`` helper adds the matching predicates.
    """
    return df.withColumn("p_hour", hour_bucket(ts_col)).withColumn("p_bucket", bucket_of(key_col, buckets))


#: Parquet options of the bronze writers: a Bloom filter per row group on the id that point lookups use,
#: of the size that its distinct values need.
LOOKUP_OPTIONS = {"parquet.bloom.filter.enabled#event_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}

TELEMETRY_PARTITIONS = ["p_hour", "p_bucket"]
BLOB_PARTITIONS = ["p_hour", "media_type", "p_bucket"]


def telemetry_layout(df: DataFrame) -> DataFrame:
    return add_partition_columns(df, "event_ts_corrected", rules.TELEMETRY_BUCKETS)


def blob_layout(df: DataFrame) -> DataFrame:
    return add_partition_columns(df, "blob_ts_corrected", rules.BLOB_BUCKETS)


def device_hour_filter(device_id: str, start, end=None, ts_col: str = "event_ts_corrected",
                      buckets: int = rules.TELEMETRY_BUCKETS) -> Column:
    """Device + time-range predicate plus the implied partition predicates
    (``p_bucket`` of the device, ``p_hour`` range) so the scan is pruned."""
    from fleetlake.functions.time import as_timestamp

    s = as_timestamp(start)
    cond = (F.col("device_id") == device_id) & (F.col(ts_col) > s) & (F.col("p_hour") >= F.date_trunc("hour", s))
    if end is not None:
        e = as_timestamp(end)
        cond = cond & (F.col(ts_col) <= e) & (F.col("p_hour") <= F.date_trunc("hour", e))
    bucket = F.pmod(F.hash(F.lit(device_id)), F.lit(buckets)).cast("int")
    return cond & (F.col("p_bucket") == bucket)


# ---------------------------------------------------------------- K2 / K3 DDL
def create_namespace(spark: SparkSession, name: str) -> None:
    """K2."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def _ddl_columns(schema: StructType) -> str:
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def create_table(spark: SparkSession, name: str, schema: StructType, partition_cols: list[str],
                 location: str | None = None) -> None:
    """K3: ``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY (...)``."""
    loc = f"\nLOCATION '{location}'" if location else ""
    parts = ", ".join(partition_cols)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (\n  {_ddl_columns(schema)}\n) USING parquet\n"
        f"PARTITIONED BY ({parts}){loc}"
    )


def create_bronze_tables(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """K3: bronze ``telemetry_events`` and ``blob_index`` with their layouts."""
    from pyspark.sql.types import IntegerType, StructField, TimestampType

    from fleetlake.schemas import BLOB_INDEX_SCHEMA, TELEMETRY_BRONZE_SCHEMA

    create_namespace(spark, namespace)
    extra = [StructField("p_hour", TimestampType()), StructField("p_bucket", IntegerType())]
    tel = StructType(TELEMETRY_BRONZE_SCHEMA.fields + extra)
    blob_fields = [f for f in BLOB_INDEX_SCHEMA.fields if f.name != "media_type"]
    blob = StructType(blob_fields + [extra[0], BLOB_INDEX_SCHEMA["media_type"], extra[1]])
    create_table(spark, f"{namespace}.telemetry_events", tel, TELEMETRY_PARTITIONS,
                 f"{location}/telemetry_events" if location else None)
    create_table(spark, f"{namespace}.blob_index", blob, BLOB_PARTITIONS,
                 f"{location}/blob_index" if location else None)


# ---------------------------------------------------------------- K1 stream append
def append_stream(
    df: DataFrame,
    path: str | None,
    checkpoint: str,
    partition_cols: list[str] | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """K1: append micro-batches with their own checkpoint.

    To a path (Parquet file sink: each batch commits atomically through
    ``_spark_metadata``) or, with ``table``, to a catalog table via
    ``toTable`` (e.g. ``fmt="iceberg"`` when that catalog is configured).
    Restart resumes from the checkpoint.
    """
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.toTable(table) if table else w.start(path)


def create_transform_partitioned_table(
    df: DataFrame,
    table: str,
    ts_col: str,
    buckets: int,
    key_col: str = "device_id",
    extra_cols: list[str] | None = None,
    provider: str = "iceberg",
) -> None:
    """K3/K4 for a v2 table format: hidden partitioning by ``hours(ts)`` and
    ``bucket(N, key)`` through DataFrameWriterV2 (requires that format's
    catalog; plain Parquet uses ``add_partition_columns`` instead)."""
    parts = [F.partitioning.hours(F.col(ts_col))]
    parts += [F.col(c) for c in (extra_cols or [])]
    parts.append(F.partitioning.bucket(buckets, F.col(key_col)))
    df.writeTo(table).using(provider).partitionedBy(*parts).createOrReplace()


# ---------------------------------------------------------------- K5 materialise
def materialize(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    partition_cols: list[str] | None = None,
    mode: str = "overwrite",
    dynamic: bool = False,
    cluster: bool = True,
) -> None:
    """K5: write a model as a table.

    ``cluster=True`` clusters rows on the partition columns with a
    REBALANCE hint: each output directory gets few files instead of one
    per input task, and AQE splits a hot partition (one hour-bucket
    holding a third of the rows) across several tasks instead of one.
    ``dynamic=True`` replaces only the partitions present in ``df``.
    """
    out = df
    if partition_cols and cluster:
        out = out.hint("rebalance", *partition_cols)
    w = out.write.mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if table:
        w.format("parquet").saveAsTable(table)
    elif path:
        w.parquet(path)
    else:
        raise ValueError("path or table required")


# ---------------------------------------------------------------- K6 reports
def report_sink(report: DataFrame, path: str) -> None:
    """K6: append one JSON line per report row."""
    report.select(F.to_json(F.struct(*report.columns)).alias("value")).write.mode("append").text(path)


# ---------------------------------------------------------------- K7 evolution
def add_column_if_missing(df: DataFrame, name: str, dtype: DataType | str) -> DataFrame:
    """K7: add ``name`` as a NULL column when absent (old rows read NULL)."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


def evolve_table(spark: SparkSession, table: str, name: str, dtype: str) -> bool:
    """K7: ``ALTER TABLE ... ADD COLUMNS`` when the column is missing.

    Returns True when the column was added."""
    cols = [c.name for c in spark.catalog.listColumns(table)]
    if name in cols:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {dtype})")
    return True


def union_evolved(frames: list[DataFrame]) -> DataFrame:
    """K7 read side: union of generations, missing columns as NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- K8 + M3 batch writer
LOG_SCHEMA = "rows long, rejected long, commit_id string, committed_at timestamp, table_name string, batch_id long"


def write_batch_with_rejects(
    batch: DataFrame,
    batch_id: int,
    accepted_path: str,
    rejected_path: str,
    log_path: str | None = None,
    partition_cols: list[str] | None = None,
    table_name: str = "telemetry_events",
) -> None:
    """K8 + M3 inside ``foreachBatch``: accepted rows to the table, rejected
    rows (with their error list) to the reject table, one log row per batch.

    The table's own partition columns come first, so an hour is found under
    its own directory; the attempt's ``commit_id`` is the last level.  The log
    row names the attempt and is written last: an attempt that failed is in
    no log row and is never read (``read_committed``), and a batch that is
    already logged is skipped, so replays and lost executors neither lose
    nor repeat rows.  The batch is persisted once for the two writes; lost
    cached blocks are recomputed from the replayable source.
    """
    spark = batch.sparkSession
    if log_path is not None and batch_logged(spark, log_path, table_name, batch_id):
        return
    commit_id = f"{batch_id:012d}-{uuid.uuid4().hex}"
    b = batch.persist()
    try:
        parts = list(partition_cols or [])
        ok = b.filter(F.col("is_valid")).drop("is_valid", "errors")
        bad = b.filter(~F.col("is_valid")).drop("is_valid")
        append_commit(ok, accepted_path, commit_id, parts)
        append_commit(bad, rejected_path, commit_id)
        if log_path is not None:
            counts = b.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(~F.col("is_valid"), 1)).alias("rejected"))
            log_commit(counts, log_path, table_name, batch_id, commit_id)
    finally:
        b.unpersist()


def append_commit(rows: DataFrame, path: str, commit_id: str, partition_cols: list[str] | None = None) -> None:
    """Append rows below ``<partition columns>/commit_id=...``."""
    if partition_cols:
        rows = rows.hint("rebalance", *partition_cols)
    rows.withColumn("commit_id", F.lit(commit_id)).write.mode("append").options(**LOOKUP_OPTIONS).partitionBy(*(partition_cols or []), "commit_id").parquet(path)


def log_commit(counts: DataFrame, log_path: str, table_name: str, batch_id: int, commit_id: str) -> None:
    """The log row of a batch, in a directory of its own: concurrent streams
    never share an output path, and the check for one batch lists that
    directory alone."""
    row = counts.select("rows", "rejected", F.lit(commit_id).alias("commit_id"), F.current_timestamp().alias("committed_at"))
    row.write.mode("overwrite").parquet(_log_dir(log_path, table_name, batch_id))


def _log_dir(log_path: str, table_name: str, batch_id: int) -> str:
    return f"{log_path}/table_name={table_name}/batch_id={batch_id}"


def batch_logged(spark: SparkSession, log_path: str, table_name: str, batch_id: int) -> bool:
    """Whether the batch is committed; a log that cannot be read is an error."""
    row = read_if_exists(spark, _log_dir(log_path, table_name, batch_id), "rows long")
    return row is not None and row.limit(1).count() > 0


def read_log(spark: SparkSession, log_path: str, table_name: str) -> DataFrame:
    """The log rows of one table; none before its first batch."""
    log = read_if_exists(spark, log_path, LOG_SCHEMA)
    return (spark.createDataFrame([], LOG_SCHEMA) if log is None else log).filter(F.col("table_name") == table_name)


def read_committed(spark: SparkSession, path: str, log_path: str, table_name: str, schema=None) -> DataFrame | None:
    """Rows of the table's committed attempts (None before the first write)."""
    rows = read_if_exists(spark, path, schema)
    if rows is None:
        return None
    return rows.join(read_log(spark, log_path, table_name).select("commit_id"), "commit_id", "left_semi").drop("commit_id")
