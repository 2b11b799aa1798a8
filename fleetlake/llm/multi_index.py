"""Near-duplicate vectors by an inverted multi-index.

A vector is normalised and cut into two halves; each half has its own codebook, and the product of
the two codebooks is a grid of cells.  Every vector is stored in the cell of its nearest centroids
and visits the cells around it in the order of their distance (multi-sequence traversal: a heap over the
frontier of the two sorted lists of half-distances) until the target recall is reached; vectors that
meet in a cell are verified by cosine in double precision.

Distance of a vector to a cell: in each half, the distance to the bisecting plane between its own
centroid and the cell's.  For a pair at distance ``d`` the two such distances add up to at most the
pair's displacement across the plane, so one of the two vectors needs to look no further than half
of it; with a displacement of no preferred direction that is normal with deviation
``d / sqrt(dim)``, which turns the target recall into a radius.  Where pairs of the sample, turned
towards each other, need a larger one to be met as often, the larger one is taken.

Bounds: the codebooks are fitted on at most ``FIT_ROWS`` vectors (those with the smallest id
hashes) and have at most ``MAX_CENTROIDS`` entries each, so what every task receives is bounded;
every vector is indexed.  Equal vectors are one class with a weight.  A cell is cut into tiles of
bounded size; a tile returns link counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm import common

FIT_ROWS = 20_000
MAX_CENTROIDS = 1024
#: Vectors per cell aimed at when the size of the codebooks is chosen.
PER_CELL = 128
TILE = 2048


def fit_codebook(points: np.ndarray, size: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Centroids of ``points`` (rows) by Lloyd iterations; at least one, at most ``size``."""
    points = np.unique(points, axis=0)
    size = max(1, min(size, len(points)))
    centroids = points[np.random.default_rng(seed).choice(len(points), size, replace=False)].copy()
    for _ in range(rounds):
        near = squared_distances(points, centroids).argmin(axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, near, points)
        n = np.bincount(near, minlength=size)
        centroids[n > 0] = total[n > 0] / n[n > 0, None]
    return np.unique(centroids, axis=0)


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1), 0)


def plane_distances(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid of each row, its distance to the plane before each centroid's cell)."""
    d = squared_distances(x, centroids)
    own = d.argmin(axis=1)
    apart = 2 * np.sqrt(squared_distances(centroids, centroids))[own]
    rows = np.arange(len(x))
    gap = d - d[rows, own][:, None]
    apart[rows, own] = 1
    return own, np.maximum(gap, 0) / np.maximum(apart, 1e-300)


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(squared distance, i, j) of the cells of the grid in ascending order of
    first[i]**2 + second[j]**2, one by one, as far as the caller asks.

    The heap holds the frontier of the two sorted lists: a cell enters it once the cells before it
    in its row and in its column have left, so that it never holds more than one cell of a row."""
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    sa, sb = (first[a] ** 2).tolist(), (second[b] ** 2).tolist()
    width = [0] * len(a)  # cells of each row that have left
    heap = [(sa[0] + sb[0], 0, 0)] if a and b else []
    while heap:
        d, i, j = heapq.heappop(heap)
        yield d, a[i], b[j]
        width[i] = j + 1
        if i + 1 < len(a) and width[i + 1] == j:
            heapq.heappush(heap, (sa[i + 1] + sb[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or width[i - 1] > j + 1):
            heapq.heappush(heap, (sa[i] + sb[j + 1], i, j + 1))


def cells_within(first: np.ndarray, second: np.ndarray, radius: float) -> list[tuple[int, int]]:
    """The nearest cells up to the first one beyond the radius."""
    return [(i, j) for _, i, j in itertools.takewhile(lambda x: x[0] <= radius * radius, multi_sequence(first, second))]


def search_radius(threshold: float, dim: int, target_recall: float) -> float:
    """Radius at which a pair at the threshold is met with at least ``target_recall``; no more than
    distance / sqrt(2), at which every such pair is met whatever its direction."""
    distance = math.sqrt(max(0.0, 2 - 2 * threshold))
    if target_recall >= 1:
        return distance / math.sqrt(2) + 1e-12
    planes = 100.0
    return min(distance / math.sqrt(2), distance / math.sqrt(dim) * math.sqrt(math.log(planes / (1 - target_recall)) / 2)) + 1e-12


def measured_radius(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], threshold: float, target_recall: float, seed: int = 11) -> float:
    """The radius at which the wanted part of probe pairs is met.  A probe is a vector of the sample
    and itself turned, until their cosine is the threshold, towards another vector: one at random
    and one of the same or a neighbouring cell, so along the directions in which these vectors
    differ, which need not be as even as ``search_radius`` assumes."""
    half = books[0].shape[1]
    homes = [squared_distances(part, book).argmin(axis=1) for part, book in zip((x[:, :half], x[:, half:]), books, strict=True)]
    near = np.empty(len(x), np.int64)
    order = np.lexsort((homes[1], homes[0]))
    near[order] = np.roll(order, 1)
    needed = [np.zeros(1)]
    for partner in (np.random.default_rng(seed).permutation(len(x)), near):
        for at in range(0, len(x), 1024):
            here, there = x[at : at + 1024], x[partner[at : at + 1024]]
            aside = there - (here * there).sum(axis=1, keepdims=True) * here
            size = np.sqrt((aside * aside).sum(axis=1))
            some = size > 1e-9
            here, aside = here[some], aside[some] / size[some, None]
            turned = threshold * here + math.sqrt(max(0.0, 1 - threshold * threshold)) * aside
            ways = np.zeros((2, len(here)))
            rows = np.arange(len(here))
            for lo, hi, book in ((0, half, books[0]), (half, x.shape[1], books[1])):
                (own, far), (home, back) = plane_distances(here[:, lo:hi], book), plane_distances(turned[:, lo:hi], book)
                ways += np.stack([far[rows, home], back[rows, own]]) ** 2
            needed.append(np.sqrt(ways.min(axis=0)))
    return float(np.quantile(np.concatenate(needed), min(1.0, target_recall), method="higher"))


def _unit(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    # scaled first, so that very large or small components neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _place(books: tuple[np.ndarray, np.ndarray], radius: float, dim: int):
    """Rows (cell, role, rep): role 0 stored, role 1 visiting."""
    half = books[0].shape[1]
    width = len(books[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column(batch.schema.get_field_index("embedding")), dim)
            reps = batch.column(batch.schema.get_field_index("rep"))
            own1, far1 = plane_distances(x[:, :half], books[0])
            own2, far2 = plane_distances(x[:, half:], books[1])
            row, cell, role = [], [], []
            for i in range(len(x)):
                row.append(i)
                cell.append(int(own1[i]) * width + int(own2[i]))
                role.append(0)
                for a, b in cells_within(far1[i], far2[i], radius):
                    row.append(i)
                    cell.append(a * width + b)
                    role.append(1)
            pick = pa.array(row, pa.int64())
            for at in range(0, len(row), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[at : at + 4096], pa.int64()), pa.array(role[at : at + 4096], pa.int32()), reps.take(pick.slice(at, 4096))],
                    names=["cell", "role", "rep"],
                )

    return run


def _verify(books: tuple[np.ndarray, np.ndarray], radius: float, dim: int, threshold: float):
    half = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in common.groups_in(batches, "tile"):
            x = _unit(group.column("embedding"), dim)
            role = np.asarray(group.column("role"))
            rep = np.asarray(group.column("rep"))
            weight = np.asarray(group.column("weight"))
            stored, visiting = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
            if not len(stored) or not len(visiting):
                continue
            home1 = squared_distances(x[visiting, :half], books[0]).argmin(axis=1)
            home2 = squared_distances(x[visiting, half:], books[1]).argmin(axis=1)
            far1 = plane_distances(x[stored, :half], books[0])[1] ** 2
            far2 = plane_distances(x[stored, half:], books[1])[1] ** 2
            links = x[stored] @ x[visiting].T >= threshold
            links &= rep[stored][:, None] != rep[visiting][None, :]
            # a pair that meets in both directions counts where the larger id visits
            both = far1[:, home1] + far2[:, home2] <= radius * radius
            links &= ~both | (rep[visiting][None, :] > rep[stored][:, None])
            n = np.zeros(len(x))
            n[stored] = links @ weight[visiting]
            n[visiting] = weight[stored] @ links
            some = np.flatnonzero(n)
            ids, place = np.unique(rep, return_inverse=True)
            forest = common.Forest(len(ids))
            u, v = [], []
            for s in np.flatnonzero(links.any(axis=1)).tolist():
                for t in np.flatnonzero(links[s]).tolist():
                    a, b = int(place[stored[s]]), int(place[visiting[t]])
                    if forest.join(a, b):
                        u.append(int(ids[a]))
                        v.append(int(ids[b]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rep[some].tolist() + u, pa.int64()),
                    pa.array([None] * len(some) + v, pa.int64()),
                    pa.array(n[some].astype(np.int64).tolist() + [None] * len(u), pa.int64()),
                ],
                names=["u", "v", "n"],
            )

    return run


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.95, target_recall: float = 1 - 1e-6) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    ``n_links``: other rows whose cosine with this one is at least ``threshold``.  Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing, and so do vectors
    whose length is not the table's most frequent one, and rows with a null vec_id (null
    component, kept).  Rows that repeat a vec_id are counted as vectors of their own but share a
    component.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    common.configure(spark)
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    finite = "forall(embedding, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and exists(embedding, v -> v <> 0)"
    good = vectors.where("vec_id is not null and embedding is not null").where(finite)
    dim_row = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dim_row is None:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dim = dim_row["d"]
    good = good.where(F.size("embedding") == dim)
    classes = common.written(
        good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")).select("rep", "weight", "embedding"), "multi-index-classes"
    )
    count = classes.count()
    # about FIT_ROWS rows by their hash, so that no more than these leave the tasks
    chance = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) / float(1 << 30)
    sample = classes.where(chance < 1.1 * FIT_ROWS / count).orderBy(chance, "rep").limit(FIT_ROWS).select("embedding").toArrow()
    x = _unit(sample.column("embedding"), dim)
    half = max(1, dim // 2)
    size = min(MAX_CENTROIDS, max(1, round(math.sqrt(count / PER_CELL))))
    books = (fit_codebook(x[:, :half], size), fit_codebook(x[:, half:], size) if dim > half else np.zeros((1, 0)))
    # never beyond the radius that meets every pair
    radius = min(search_radius(threshold, dim, 1.0), max(search_radius(threshold, dim, target_recall), measured_radius(x, books, threshold, target_recall) + 1e-12))

    places = common.written(classes.mapInArrow(_place(books, radius, dim), "cell long, role int, rep long"), "multi-index-places")
    sizes = places.groupBy("cell").agg(
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("role") == 0, 1).otherwise(0)) / TILE)).alias("stored_blocks"),
        F.greatest(F.lit(1), F.ceil(F.sum("role") / TILE)).alias("visiting_blocks"),
    )
    block = F.when(F.col("role") == 0, F.pmod(F.xxhash64("rep"), "stored_blocks")).otherwise(F.pmod(F.xxhash64("rep"), "visiting_blocks"))
    others = F.when(F.col("role") == 0, F.col("visiting_blocks")).otherwise(F.col("stored_blocks"))
    tiles = (
        places.join(sizes, "cell")
        .select("cell", "role", "rep", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias("other"))
        .select("rep", "role", F.when(F.col("role") == 0, F.xxhash64("cell", "block", "other")).otherwise(F.xxhash64("cell", "other", "block")).alias("tile"))
    )
    work = tiles.join(classes, "rep").repartition("tile").sortWithinPartitions("tile")
    found = common.written(work.mapInArrow(_verify(books, radius, dim, threshold), "u long, v long, n long"), "multi-index-links")
    comps = common.connected_components(found.where("n is null").select("u", "v"), "multi-index-cc").withColumnRenamed("id", "rep")
    counts = found.where("n is not null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    of_class = (
        classes.join(counts, "rep", "left")
        .join(comps, "rep", "left")
        .select("embedding", F.coalesce("component", "rep").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"))
    )
    # vectors that link with nothing take no part in the join
    linked = good.join(of_class, "embedding").select("vec_id", F.col("n").alias("n_links"), F.col("component").alias("component_id"))
    is_good = F.coalesce(F.expr(f"vec_id is not null and embedding is not null and size(embedding) = {dim} and {finite}"), F.lit(False))
    alone = vectors.where(~is_good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
