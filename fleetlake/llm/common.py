"""Shared helpers: written tables that cut lineage, Arrow batch limits, whitespace words, components."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import shared_path


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per Spark context (``addPyFile``), so
    that task functions import there whatever the executors' own search path is."""
    sc = spark.sparkContext
    if getattr(sc, "_fleetlake_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.dirname(top)
    target = os.path.join(tempfile.mkdtemp(prefix="fleetlake-src-"), "fleetlake_src.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(target)
    sc._fleetlake_shipped = True


def configure(spark: SparkSession) -> None:
    """Small Arrow batches, so that a batch of very long texts still fits a Python worker."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: computed once, and its
    lineage ends there, so a lost executor costs only re-reading files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_uri(path: str) -> str:
    """``file:/x`` and ``/x`` as ``file:///x``; other URIs unchanged."""
    if path.startswith("/"):
        return "file://" + path
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:") :]
    return path


def open_filesystem(uri: str):
    """(pyarrow filesystem, path) of a shared-storage URI; works inside executor tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(as_uri(uri))


def text_bytes(text: str = "text"):
    """The text as UTF-8 bytes; null as empty."""
    return F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit(b""))


def batches_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


#: What a Python worker keeps from one task to the next (a compiled model with its cache of words).
KEPT: dict = {}


def release_memory() -> None:
    """What this process has freed goes back to the system; the allocators would hold on to it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def drop_kept() -> None:
    KEPT.clear()
    release_memory()


def lean(run: Callable) -> Callable:
    """``run`` (for mapInArrow) in a worker that first drops what tasks of other operators left in
    ``KEPT`` and at the end gives its free memory back: Spark keeps idle workers, and theirs counts
    beside the executor's heap in every later stage."""

    def leaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        try:
            yield from run(batches)
        finally:
            release_memory()

    return leaner


class WordHashes(dict):
    """word bytes -> 64-bit hash, filled on demand and emptied when it holds ``limit`` words
    (it is only a cache)."""

    limit = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def lower_words(raw: bytes) -> list[bytes]:
    """A-Z lower-cased, then maximal runs without the bytes 0x20 and 0x09-0x0D (``bytes.lower``
    and ``bytes.split`` touch ASCII only)."""
    return raw.lower().split()


def shingle_hashes(raw: bytes, width: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; with fewer words the whole
    sequence is one shingle; no words, no shingle."""
    words = lower_words(raw)
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([cache[w] for w in words], dtype=np.uint64)
    if len(h) < width:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))], dtype=np.uint64)
    n = len(h) - width + 1
    acc = h[:n].copy()
    for j in range(1, width):
        acc ^= acc >> np.uint64(31)
        acc *= np.uint64(0x9E3779B97F4A7C15)
        acc += h[j : j + n]
    acc ^= acc >> np.uint64(33)
    acc *= np.uint64(0xFF51AFD7ED558CCD)
    acc ^= acc >> np.uint64(29)
    return np.unique(acc)


def groups_in(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` in batches that arrive sorted by it, one table per run."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(batch.schema.get_field_index(key)))
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over the members of one group inside a task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(id, component): the smallest id reachable over ``edges`` (u, v), for every id in an edge.

    Alternating large-star and small-star steps; each pass is a shuffle whose result is written,
    so neither links nor components ever reach the driver and the lineage stays short.  A node
    with very many links is only ever aggregated with map-side combining or joined (AQE splits it).
    """
    cur = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    cur = written(cur, name)
    seen = None
    while True:
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        cur = written(small, name)
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
