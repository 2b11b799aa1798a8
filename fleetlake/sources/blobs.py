"""Stored blob objects: listing/reading and checksum verification.

Blobs of any size are hashed in pieces: a task opens each of its blobs through the file system and feeds
chunks to a running SHA-256, so its memory does not depend on a blob's size.  Blobs are dealt to tasks by
bytes, not by number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.functions import rules


def scan_blobs(spark: SparkSession, root: str, with_content: bool = False, glob: str = "*.bin") -> DataFrame:
    """Stored blobs under the partitioned key layout.

    ``binaryFile`` lists files on the executors; without ``with_content``
    only path/size/mtime are produced (the bytes are never read).
    Columns: path, key (path below ``root``), length, modificationTime[, content].
    """
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
    )
    root_uri = root.rstrip("/")
    key = F.regexp_replace(F.col("path"), r"^.*?" + _re_escape(root_uri.split("://")[-1]) + "/", "")
    cols = [F.col("path"), key.alias("key"), F.col("length"), F.col("modificationTime")]
    if with_content:
        cols.append(F.col("content"))
    return df.select(*cols)


def _re_escape(s: str) -> str:
    import re

    return re.escape(s)


def deal_by_bytes(files: DataFrame, target_bytes: int, slots: int = 256) -> DataFrame:
    """``files`` (path, length, ...) in partitions of about ``target_bytes`` (a larger file alone).

    Running sums are taken within ``slots`` that paths are hashed to, so no task sees all files; the
    pieces of all slots are then numbered through."""
    slot = F.pmod(F.xxhash64("path"), F.lit(slots))
    within = Window.partitionBy("_slot").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    cut = files.withColumn("_slot", slot).withColumn("_piece", F.floor(F.coalesce(F.sum("length").over(within), F.lit(0)) / F.lit(target_bytes)).cast("long"))
    sizes = cut.groupBy("_slot").agg((F.max("_piece") + 1).alias("_pieces"))
    pieces = sizes.agg(F.sum("_pieces")).first()[0]
    if not pieces:
        return files
    # a row per slot
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_pieces").over(Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = cut.join(starts.select("_slot", "_start"), "_slot").withColumn("_at", F.col("_start") + F.col("_piece"))
    return numbered.repartitionByRange(int(pieces), "_at").select(*files.columns)


def _digests(chunk_bytes: int):
    """Arrow function (path) -> (path, sha256, bytes_read); local, so that executors need not have
    this package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        from urllib.parse import unquote

        import pyarrow
        from pyarrow import fs

        for batch in batches:
            paths = batch.column(0).to_pylist()
            digests, sizes = [], []
            for path in paths:
                if path.startswith("file:"):
                    system, name = fs.LocalFileSystem(), unquote(path.split(":", 1)[1])
                    name = "/" + name.lstrip("/")
                else:
                    system, name = fs.FileSystem.from_uri(path)
                h, n = hashlib.sha256(), 0
                try:
                    with system.open_input_stream(name, buffer_size=0) as stream:
                        while chunk := stream.read(chunk_bytes):
                            h.update(chunk)
                            n += len(chunk)
                    digests.append(h.hexdigest())
                    sizes.append(n)
                except FileNotFoundError:  # gone since it was listed
                    digests.append(None)
                    sizes.append(None)
            yield pyarrow.RecordBatch.from_arrays([pyarrow.array(paths, pyarrow.string()), pyarrow.array(digests, pyarrow.string()), pyarrow.array(sizes, pyarrow.int64())], names=["path", "sha256", "bytes_read"])

    return run


def hash_blobs(files: DataFrame, target_bytes: int = 4 << 30, chunk_bytes: int = 8 << 20) -> DataFrame:
    """(path, sha256, bytes_read) of the files of a listing (path, length), of any size.  A file that
    is gone by the time it is read has nulls; any other failure is raised, and the task tried again."""
    return deal_by_bytes(files, target_bytes).select("path").mapInArrow(_digests(chunk_bytes), "path string, sha256 string, bytes_read long")


def verify_blobs(
    spark: SparkSession,
    manifests: DataFrame,
    root: str,
    bucket: str = rules.RAW_BUCKET,
) -> DataFrame:
    """Recompute SHA-256 and size of stored bytes and compare with the index.

    ``blob_uri = s3://<bucket>/<key>`` maps to ``<root>/<key>``.  One row per
    URI from either side with ``verify_status``: MATCH, MISMATCH (checksum or
    size differ), MISSING (indexed, not stored), UNINDEXED (stored, not
    indexed).  Blobs are read in chunks by tasks of about equal bytes
    (``hash_blobs``); only hash and length travel to the join.
    """
    prefix = f"{rules.BLOB_URI_SCHEME}{bucket}/"
    listing = scan_blobs(spark, root).select("path", "key", "length")
    stored = listing.join(hash_blobs(listing), "path").select(
        "key",
        F.col("sha256").alias("stored_sha256"),
        F.col("bytes_read").alias("stored_size"),
    )
    idx = manifests.select(
        F.when(F.col("blob_uri").startswith(prefix), F.expr(f"substring(blob_uri, {len(prefix) + 1})")).alias("key"),
        "blob_uri",
        "event_id",
        "checksum_sha256",
        "object_size",
    )
    j = idx.join(stored, "key", "full_outer")
    status = (
        F.when(F.col("blob_uri").isNull(), F.lit("UNINDEXED"))
        .when(F.col("stored_sha256").isNull(), F.lit("MISSING"))
        .when(
            (F.col("stored_sha256") == F.lower(F.col("checksum_sha256")))
            & (F.col("stored_size") == F.col("object_size")),
            F.lit("MATCH"),
        )
        .otherwise(F.lit("MISMATCH"))
    )
    return j.withColumn("verify_status", status)
