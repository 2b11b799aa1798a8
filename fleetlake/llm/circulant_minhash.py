"""Near-duplicate documents by circulant MinHash.

Two permutations generate every signature coordinate: the first scatters a shingle over the 2**32
positions of a ring (an avalanche hash of its words), the second is one fixed bijection of the
ring; coordinate ``k`` is the smallest value of that bijection over the set shifted by ``k``
places.  Bands of coordinates name candidates, and every link is confirmed on the full shingle
sets.

The work per step:

* one narrow pass over the texts gives a set digest and the band keys of each document;
* documents with equal sets become one class (map-side combined, so a group of any size is a row);
* in each bucket of classes all members are first compared with one hub (a number of pairs linear
  in the bucket) and the links found are contracted to components;
* what is left, pairs of one bucket in different components, is compared block by block inside
  tasks; only links that join two components leave a task, never the pairs.  A bucket is cut into
  blocks by its bytes, so a task holds a bounded part of a bucket of any size.

With 32 bands of 6 coordinates a pair at similarity 0.85 is missed with probability 3e-7; with 32
bands of 5, one at 0.8 with 3e-6.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm import common

#: Bytes of text in a block of a bucket; a task holds two blocks at a time.
BLOCK_BYTES = 3 << 20


def second_permutation(x: np.ndarray) -> np.ndarray:
    """A bijection of uint32 (xor-shifts and odd multipliers), in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a set of 64-bit shingle hashes (not empty)."""
    ring = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    for a in range(0, len(ring), 2048):
        np.minimum(out, second_permutation(ring[None, a : a + 2048] + shifts).min(axis=1), out=out)
    return out


def band_keys(sig: np.ndarray, rows: int) -> list[int]:
    """One signed 64-bit key per band; the band number is part of the key."""
    return [xxhash.xxh3_64_intdigest(sig[a : a + rows].tobytes(), seed=a + 1) - (1 << 63) for a in range(0, len(sig), rows)]


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den * |a & b| >= num * |a | b|, on sorted distinct arrays."""
    total = len(a) + len(b)
    if den * min(len(a), len(b)) < num * max(len(a), len(b)):
        return False
    inter = total - len(np.union1d(a, b))
    return den * inter >= num * (total - inter)


def _describe(width: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = common.WordHashes()
        for batch in batches:
            ids, raws = common.batches_of(batch, "doc_id", "raw")
            n, digest, keys = [], [], []
            for raw in raws:
                s = common.shingle_hashes(raw, width, cache)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(band_keys(signature(s, rows * bands), rows) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([len(r) for r in raws], pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "n_bytes", "digest", "bands"],
            )

    return run


def _verify_stars(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = common.WordHashes()
        last, hub_set = None, None
        for batch in batches:
            us, vs, hubs, raws = common.batches_of(batch, "hub", "rep", "hub_raw", "raw")
            keep = []
            for i, (u, hub, raw) in enumerate(zip(us, hubs, raws, strict=True)):
                if hub != last:
                    last, hub_set = hub, common.shingle_hashes(hub, width, cache)
                if similar(hub_set, common.shingle_hashes(raw, width, cache), num, den):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([us[i] for i in keep], pa.int64()), pa.array([vs[i] for i in keep], pa.int64())], names=["u", "v"])

    return run


def _verify_blocks(width: int, num: int, den: int, rows: int, bands: int):
    """Links between different components inside one pair of blocks of one bucket."""
    size = rows * bands
    # A pair at the threshold agrees in so few coordinates with probability below 1e-9.
    t = num / den
    least = math.floor(size * t - 6.2 * math.sqrt(size * t * (1 - t)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = common.WordHashes()
        for group in common.groups_in(batches, "part"):
            ids = group.column("rep").to_pylist()
            comps = group.column("component").to_pylist()
            sides = np.array(group.column("side").to_pylist(), dtype=np.int8)
            sets = [common.shingle_hashes(r, width, cache) for r in group.column("raw").to_pylist()]
            sigs = np.stack([signature(s, size) for s in sets])
            band = group.column("h")[0].as_py()
            at = band_keys(sigs[0], rows).index(band)
            index: dict[int, int] = {}
            forest = common.Forest(len(ids))
            for i, c in enumerate(comps):
                forest.join(index.setdefault(c, i), i)
            out = []
            lens = np.array([len(s) for s in sets])
            first = np.flatnonzero(sides != 1)
            for i in first.tolist():
                # side 2: a block against itself; else side 0 against side 1
                others = np.arange(i + 1, len(ids)) if sides[i] == 2 else np.flatnonzero(sides == 1)
                others = others[(den * np.minimum(lens[others], lens[i]) >= num * np.maximum(lens[others], lens[i]))]
                if not len(others):
                    continue
                same = sigs[others] == sigs[i]
                ok = same.sum(axis=1) >= least
                if at:  # a pair is looked at in the first band that it shares
                    ok &= ~same[:, : at * rows].reshape(len(others), at, rows).all(axis=2).any(axis=1)
                for j in others[ok].tolist():
                    if forest.find(i) != forest.find(j) and similar(sets[i], sets[j], num, den):
                        forest.join(i, j)
                        out.append((ids[i], ids[j]))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["u", "v"])

    return run


def near_duplicates(docs: DataFrame, width: int = 3, num: int = 85, den: int = 100, rows: int = 6, bands: int = 32) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Two documents are linked when ``den * |A & B| >= num * |A | B|`` on their sets of ``width``-word
    shingles.  Null, empty and blank texts have the empty set and link with nothing.  A null
    doc_id links with nothing, has a null component and is kept.  Rows that repeat a doc_id are
    one node (each row is returned).  Other columns are ignored.  No rows in, no rows out.
    """
    spark = docs.sparkSession
    common.configure(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_bytes().alias("raw"))
    facts = common.written(
        docs.mapInArrow(common.lean(_describe(width, rows, bands)), "doc_id long, n_shingles long, n_bytes long, digest binary, bands array<long>"),
        "minhash-facts",
    )
    classes = common.written(
        facts.where("doc_id is not null and n_shingles > 0")
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "n_bytes", "bands")).alias("m"))
        .select("digest", F.col("m.doc_id").alias("rep"), "m.n_bytes", "m.bands"),
        "minhash-classes",
    )
    entries = classes.select("rep", "n_bytes", F.explode("bands").alias("h"))
    # written, so that the joins below are between plain shuffles, whose hot keys Spark can split
    buckets = common.written(
        entries.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("hub"), F.sum("n_bytes").alias("total")).where("n > 1").drop("n"),
        "minhash-buckets",
    )
    members = common.written(entries.join(buckets, "h"), "minhash-members")
    texts = common.written(
        docs.withColumnRenamed("doc_id", "rep").join(members.select("rep").distinct(), "rep", "left_semi").dropDuplicates(["rep", "raw"]),
        "minhash-texts",
    )
    # 1. every member against the hub of its bucket
    stars = members.where("rep <> hub").select("hub", "rep").distinct()
    pairs = stars.join(texts, "rep").join(texts.select(F.col("rep").alias("hub"), F.col("raw").alias("hub_raw")), "hub").sortWithinPartitions("hub")
    links = common.written(pairs.mapInArrow(common.lean(_verify_stars(width, num, den)), "u long, v long"), "minhash-stars")
    comps = common.written(common.connected_components(links, "minhash-cc"), "minhash-comps")
    # 2. what the hubs left open
    placed = members.join(comps.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = common.written(placed.groupBy("h").agg((F.min("component") != F.max("component")).alias("open")).where("open").select("h"), "minhash-open")
    open_ = placed.join(mixed, "h").withColumn("blocks", F.ceil(F.col("total") / BLOCK_BYTES)).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    tiles = open_.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "rep",
        "component",
        "h",
        F.xxhash64("h", F.least("block", "other"), F.greatest("block", "other")).alias("part"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    work = tiles.join(texts, "rep").repartition("part").sortWithinPartitions("part", "side", "rep")
    more = common.written(work.mapInArrow(common.lean(_verify_blocks(width, num, den, rows, bands)), "u long, v long"), "minhash-blocks")
    comps = common.connected_components(links.unionByName(more), "minhash-cc").withColumnRenamed("id", "rep")
    of_class = classes.select("digest", "rep").join(comps, "rep", "left").select("digest", F.coalesce("component", "rep").alias("by_class"))
    return facts.join(of_class, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("by_class", "doc_id")).alias("component_id"),
        F.col("doc_id").eqNullSafe(F.when(F.col("doc_id").isNotNull(), F.coalesce("by_class", "doc_id"))).alias("kept"),
    )
