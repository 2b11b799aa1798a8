"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are put in a pseudo-random order and cut into blocks of ``block_chars``
characters.  The ideal mix gives every source with blocks left its weight's part of each slot, the
weights of those that have run out being shared in proportion.  Block ``i`` of a source may not
start before the whole slot in which the ideal mix begins it (its release) and must be done by the
end of the slot in which the ideal mix ends it (its deadline); as long as no source runs out these
are ``floor(i / w)`` and ``ceil((i + 1) / w)``.  One block is placed per slot, always the released
block with the earliest deadline, ties by source.  Every prefix of the schedule then holds each
source within less than one block of the ideal mix, from the first slot to the last.

Nothing of the schedule is made on the driver, which knows the sources' sizes alone.  Windows are
closed formulas in whole numbers (``Ideal``).  The slots are cut into segments.  One task walks over
the segments and finds, without placing blocks, which sources are ahead at each cut (one bit a
source); then every segment is scheduled in a task of its own, and the outcome is the schedule
that one pass over all slots would make.

Running totals within a source are two-level (per hash range, then inside the range), so no
source, however large, is one task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm import common

BLOCK_CHARS = 1 << 16
#: Slots of one scheduling task.
SEGMENT = 1 << 16
MAX_TASKS = 20_000
#: Ranges of the order key in which running totals are taken, at least.
RANGES = 1024
#: Sources scheduled on their own; the others share one place in the schedule.
MAX_SOURCES = 1 << 16
POOL = "\x00others"


def blocks_of(n_chars: int, block_chars: int) -> int:
    """Blocks of a source: up to the last place at which one of its documents may start."""
    return n_chars // block_chars + 1


class Ideal:
    """The ideal mix of ``blocks`` (a number for each source) under ``weights``.

    A source without a positive weight takes the smallest positive one.  Weights whose ratios are
    those of small whole numbers are kept as they are; others are rounded to parts of
    2^61 / (all blocks), at most 2^48, so that products stay below 2^63 and all results are exact.
    Over a million blocks the rounding comes to less than a millionth of a block.
    """

    def __init__(self, blocks: dict[str, int], weights: dict[str, float]):
        self.names = sorted(s for s, n in blocks.items() if n > 0)
        n = [blocks[s] for s in self.names]
        self.slots = sum(n)
        given = [Fraction(max(weights.get(s, 0.0), 0.0)) for s in self.names]
        least = min((x for x in given if x), default=Fraction(1))
        given = [x or least for x in given]
        parts = min(1 << 48, (1 << 61) // max(self.slots, 1))
        whole, common_part = sum(given), math.lcm(*(x.denominator for x in given))
        scale = common_part if whole * common_part <= parts else parts / whole
        w = [max(1, int(x * scale)) for x in given]
        # sources run out in the order of blocks / weight; a phase ends with each distinct one
        ends = [Fraction(a, b) for a, b in zip(n, w, strict=True)]
        order = sorted(set(ends))
        place = {e: p for p, e in enumerate(order)}
        gone, left = [0] * (len(order) + 1), [0] * (len(order) + 1)
        for a, b, e in zip(n, w, ends, strict=True):
            gone[place[e] + 1] += a
            left[place[e]] += b
        for p in range(len(order)):
            gone[p + 1] += gone[p]
        for p in reversed(range(len(order))):
            left[p] += left[p + 1]
        starts = [0] + [gone[p + 1] + -(-e.numerator * left[p + 1] // e.denominator) for p, e in enumerate(order)]
        self.n, self.w = np.array(n, np.int64), np.array(w, np.int64)
        self.last = np.array([place[e] for e in ends], np.int64)
        self.gone, self.left, self.starts = (np.array(x, np.int64) for x in (gone, left, starts))
        self.end_n = np.array([e.numerator for e in order], np.int64)
        self.end_w = np.array([e.denominator for e in order], np.int64)
        self.ends = self.end_n / np.maximum(self.end_w, 1)

    def phase(self, slots: np.ndarray) -> np.ndarray:
        """Distinct ends of sources at or before each slot."""
        return np.searchsorted(self.starts, slots, side="right") - 1

    def reached(self, source: np.ndarray, blocks: np.ndarray, up: bool) -> np.ndarray:
        """The time at which the ideal mix has placed that many blocks of a source, rounded up or down."""
        w = self.w[source]
        p = np.searchsorted(self.ends, blocks / w, side="right")
        top = len(self.ends) - 1
        while True:  # the division may be off by a rounding
            low = (p > 0) & (self.end_n[np.maximum(p - 1, 0)] * w > blocks * self.end_w[np.maximum(p - 1, 0)])
            high = (p <= top) & (self.end_n[np.minimum(p, top)] * w <= blocks * self.end_w[np.minimum(p, top)])
            if not (low.any() or high.any()):
                break
            p = p - low + high
        x = blocks * self.left[p]
        return self.gone[p] + (-(-x // w) if up else x // w)

    def placed(self, slot: int) -> tuple[np.ndarray, np.ndarray]:
        """(whole blocks of each source in the ideal mix before ``slot``, whether there is more than these)."""
        p = int(self.phase(np.int64(slot)))
        x = self.w * (slot - self.gone[p])
        running = self.last >= p
        part = max(int(self.left[p]), 1)
        return np.where(running, x // part, self.n), running & (x % part != 0)

    def _jobs(self, t0: int, done: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(source, block, release from ``t0`` on) of the blocks ``done`` to ``upto`` of each source."""
        count = np.maximum(upto - done, 0)
        source = np.repeat(np.arange(len(count)), count)
        block = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count) + done[source]
        return source, block, np.maximum(self.reached(source, block, up=False) - t0, 0)

    def advance(self, t0: int, t1: int, done: np.ndarray) -> np.ndarray:
        """Blocks of each source placed before ``t1`` when ``done`` are placed before ``t0``.

        All blocks with a deadline up to ``t1`` are.  The remaining slots go to blocks that the ideal
        mix has begun, by deadline: one is placed if for every slot the blocks released at it or
        later still fit before ``t1``, which is what placing slot by slot comes to."""
        whole, more = self.placed(t1)
        out = np.maximum(done, whole)
        source, _, release = self._jobs(t0, done, whole)
        length = t1 - t0
        free = length - len(source)
        room = np.arange(length, 0, -1) - np.cumsum(np.bincount(release, minlength=length)[::-1])[::-1]
        begun = np.flatnonzero(more & (done <= whole))
        deadline = self.reached(begun, whole[begun] + 1, up=True)
        release = np.maximum(self.reached(begun, whole[begun], up=False) - t0, 0)
        for j in np.lexsort((begun, deadline)):
            if not free:
                break
            upto = room[: release[j] + 1]
            if upto.min() > 0:
                upto -= 1
                out[begun[j]] += 1
                free -= 1
        return out

    def schedule(self, t0: int, t1: int, done: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(source, block) of each slot from ``t0`` to ``t1``: earliest deadline first."""
        source, block, release = self._jobs(t0, done, upto)
        order = np.lexsort((source, self.reached(source, block + 1, up=True)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        by_release = np.argsort(release, kind="stable")
        coming, at = rank[by_release].tolist(), 0
        until = np.cumsum(np.bincount(release, minlength=t1 - t0)).tolist()
        ready: list[int] = []
        taken = []
        for stop in until:
            while at < stop:
                heapq.heappush(ready, coming[at])
                at += 1
            taken.append(heapq.heappop(ready))
        picked = order[np.array(taken, np.int64)]
        return source[picked], block[picked]


CUTS = "first long, stop long, low binary, high binary"
CUTS_ARROW = pa.schema([("first", pa.int64()), ("stop", pa.int64()), ("low", pa.binary()), ("high", pa.binary())])
PLACES = "lane string, block long, phase int, slot long"


def _cuts(ideal: Ideal, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in (row for batch in batches for row in range(batch.num_rows)):
            done, low = np.zeros(len(ideal.names), np.int64), b""
            for t0 in range(0, ideal.slots, segment):
                t1 = min(t0 + segment, ideal.slots)
                done = ideal.advance(t0, t1, done)
                high = np.packbits(done > ideal.placed(t1)[0]).tobytes()
                yield pa.RecordBatch.from_pylist([{"first": t0, "stop": t1, "low": low, "high": high}], schema=CUTS_ARROW)
                low = high

    return run


def _segments(ideal: Ideal):
    names = pa.array(ideal.names, pa.string())

    def at(slot: int, bits: bytes) -> np.ndarray:
        whole, _ = ideal.placed(slot)
        return whole + np.unpackbits(np.frombuffer(bits, np.uint8), count=len(whole)) if bits else whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t0, t1, low, high in zip(*common.batches_of(batch, "first", "stop", "low", "high"), strict=True):
                source, block = ideal.schedule(t0, t1, at(t0, low), at(t1, high))
                slot = np.arange(t0, t1)
                phase = ideal.phase(slot).astype(np.int32)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(source)), pa.array(block), pa.array(phase), pa.array(slot)], names=["lane", "block", "phase", "slot"])

    return run


def schedule(spark, blocks: dict[str, int], weights: dict[str, float], segment: int = SEGMENT) -> DataFrame:
    """(lane, block, phase, slot) for every block of every source; ``phase`` counts the distinct
    ends of sources before the slot."""
    ideal = Ideal(blocks, weights)
    tasks = -(-ideal.slots // segment)
    if not tasks:
        return spark.createDataFrame([], PLACES)
    cuts = common.written(spark.range(0, 1, 1, 1).mapInArrow(_cuts(ideal, segment), CUTS), "mix-cuts")
    return cuts.repartition(min(tasks, MAX_TASKS)).mapInArrow(_segments(ideal), PLACES)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS, temperature: float = 0.7, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, source, n_chars, order_key, block, phase, slot, place) for every row of ``docs``
    (doc_id, text, source): ``slot`` is the place of the row's block in the mix, ``place`` the
    characters of its source before it; ascending (slot, place, order_key, doc_id) is the mix.

    ``weights``: target weight per source (null sources under ""); by default in proportion to the
    source's characters to the power ``temperature``.  A source without a weight takes the smallest
    one.  Null and empty texts have no characters and go with the block they fall in; a block is
    named by the characters before a document, so a document longer than a block leaves the numbers
    it covers unused.  Rows that repeat each other stay.  Beyond ``MAX_SOURCES`` sources the smaller
    ones are mixed as one source, with the sum of their weights: the pool keeps its share, but a source
    in it has no windows of its own, and weights given inside the pool only count in that sum.
    """
    spark = docs.sparkSession
    common.configure(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_chars"),
    ).withColumn("order_key", F.xxhash64("doc_id", "source"))
    ranges = max(RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = common.written(rows.withColumn("part", F.pmod(F.shiftrightunsigned("order_key", 40), F.lit(ranges)).cast("int")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("n_chars").alias("n"))
    totals = {r["source"]: r["n"] for r in sizes.orderBy(F.desc("n"), "source").limit(MAX_SOURCES + 1).collect()}
    rows = rows.withColumn("lane", F.col("source"))
    pool = None
    if len(totals) > MAX_SOURCES:
        totals = dict(list(totals.items())[: MAX_SOURCES - 1])
        alone = F.broadcast(spark.createDataFrame([(s,) for s in totals], "source string").withColumn("alone", F.lit(True)))
        others = sizes.join(alone, "source", "left_anti")
        power = F.sum(F.pow(F.greatest("n", F.lit(1)), F.lit(temperature)))
        pool = others.agg(F.sum("n").alias("n"), power.alias("power")).first()
        rows = rows.join(alone, "source", "left").withColumn("lane", F.when(F.col("alone"), F.col("source")).otherwise(F.lit(POOL))).drop("alone")
    if weights is None:
        weights = {s: float(max(n, 1)) ** temperature for s, n in totals.items()} | ({POOL: pool["power"]} if pool else {})
    elif pool:
        weights = weights | {POOL: sum(w for s, w in weights.items() if s not in totals)}
    if pool:
        totals[POOL] = pool["n"]
    sums = rows.groupBy("lane", "part").agg(F.sum("n_chars").alias("chars"))
    before = F.sum("chars").over(Window.partitionBy("lane").orderBy("part")) - F.col("chars")
    offsets = common.written(sums.withColumn("before", before), "mix-offsets")
    running = F.sum("n_chars").over(Window.partitionBy("lane", "part").orderBy("order_key", "doc_id", "n_chars").rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        rows.join(offsets.drop("chars"), ["lane", "part"])
        .withColumn("place", F.col("before") + F.coalesce(running, F.lit(0)))
        .withColumn("block", F.floor(F.col("place") / block_chars))
    )
    slots = schedule(spark, {s: blocks_of(n, block_chars) for s, n in totals.items()}, weights, segment)
    return placed.join(slots, ["lane", "block"]).select("doc_id", "source", "n_chars", "order_key", "block", "phase", "slot", "place")
