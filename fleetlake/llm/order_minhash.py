"""Document fingerprints by order MinHash, in DataFrame functions only.

The k-mers of a text (runs of ``WIDTH`` words) are numbered by occurrence, so that a repeated k-mer
counts as often as it stands there, and hashed.  Each of ``TUPLES`` constants orders the numbered
k-mers by their hash exclusive-or the constant (a permutation of the hash values, so each k-mer is as
likely the first as any other, and constants are independent of each other).  The k-mers are split by
their hashes into ``GROUPS``; an order looks at the k-mers of one group, or at all of them where the
group holds fewer than two, so the work is that of ``TUPLES / GROUPS`` orders over the text.  The ``2``
smallest of an order are selected, put back into their order in the text, and the pair is hashed.  The fingerprint is the list
of these hashes; the share of equal ones estimates a similarity that falls with the edit distance: it
takes account of repeats and of order, unlike a set sketch.

A hash and its k-mer's place in the text share one long (the place in the low ``PLACE_BITS``), so
the smallest of an order is at once where it stands.

Everything for one text is one expression over its own arrays (linear in the text but for one sort),
evaluated in the scan's tasks: no k-mer is ever shuffled.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm import common

WIDTH, TUPLES, GROUPS = 3, 64, 16
#: Bits of a k-mer's place; more than an array can have elements.
PLACE_BITS = 28
PLACES, HASHES = (1 << PLACE_BITS) - 1, -(1 << PLACE_BITS)
MAX_RANGES = 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def upto(n: Column) -> Column:
    """0 .. n - 1; empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def kmers(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the runs of ``width`` words in order; a shorter text is one k-mer; no word, none."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return let(
        words,
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
        .when(F.size(w) < width, F.array(F.xxhash64(w)))
        .otherwise(F.transform(upto(F.size(w) - (width - 1)), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))),
    )


def constants(tuples: int) -> list[int]:
    """The orders: random bits above the place."""
    rng = random.Random(5)
    return [(rng.getrandbits(64 - PLACE_BITS) - (1 << (63 - PLACE_BITS))) << PLACE_BITS for _ in range(tuples)]


def numbered(ordered: Column) -> Column:
    """From the sorted (k-mer hash, place): (hash of k-mer and occurrence number, place)."""

    def kmer(i: Column) -> Column:
        return F.get(ordered, i).bitwiseAND(F.lit(HASHES))

    def one(x: Column, h: Column, number: Column) -> Column:
        return F.xxhash64(h, number).bitwiseAND(F.lit(HASHES)).bitwiseOR(x.bitwiseAND(F.lit(PLACES)))

    starts = F.filter(upto(F.size(ordered)), lambda i: (i == 0) | (kmer(i) != kmer(i - 1)))
    return let(
        starts,
        lambda s: F.when(F.size(s) == F.size(ordered), F.transform(ordered, lambda x: one(x, x.bitwiseAND(F.lit(HASHES)), F.lit(0)))).otherwise(
            F.flatten(F.transform(s, lambda a, r: F.transform(F.sequence(a, F.coalesce(F.get(s, r + 1), F.size(ordered)) - 1), lambda j: one(F.get(ordered, j), kmer(a), j - a))))
        ),
    )


def _tuple(base: Column, constant: Column, inorder: Column) -> Column:
    """Hash of the two first k-mers of an order, as they follow each other in the text (of the only
    one, if there is one)."""

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit(PLACES)).cast("int")

    def pair(hashes: Column, low: Column) -> Column:
        return let(
            F.array_min(F.filter(hashes, lambda x: x != low)),
            lambda second: F.when(second.isNull(), F.xxhash64(F.get(inorder, place(low)))).otherwise(
                F.xxhash64(F.get(inorder, F.least(place(low), place(second))), F.get(inorder, F.greatest(place(low), place(second))))
            ),
        )

    return let(F.transform(base, lambda b: b.bitwiseXOR(constant)), lambda hashes: let(F.array_min(hashes), lambda low: pair(hashes, low)))


def group_of(x: Column) -> Column:
    """Group of a hash, from the bits above the place."""
    return F.pmod(F.shiftright(x, PLACE_BITS), F.lit(GROUPS))


def sketch(text: Column, width: int = WIDTH, tuples: int = TUPLES) -> Column:
    """array<bigint> of ``tuples`` hashes; empty for a text without words."""
    orders = constants(tuples)
    by_group = F.array(*[F.array(*[F.lit(c).cast("long") for c in orders[g::GROUPS]]) if orders[g::GROUPS] else F.array().cast("array<bigint>") for g in range(GROUPS)])

    def of_group(base: Column, own: Column, g: Column, inorder: Column) -> Column:
        return let(F.when(F.size(own) < 2, base).otherwise(own), lambda some: F.transform(F.get(by_group, g), lambda c: _tuple(some, c, inorder)))

    return let(
        kmers(text, width),
        lambda inorder: F.when(F.size(inorder) == 0, F.array().cast("array<bigint>")).otherwise(
            let(
                F.sort_array(F.transform(inorder, lambda h, i: h.bitwiseAND(F.lit(HASHES)).bitwiseOR(i.cast("long")))),
                lambda ordered: let(numbered(ordered), lambda base: F.flatten(F.transform(upto(F.lit(GROUPS)), lambda g: of_group(base, F.filter(base, lambda x: group_of(x) == g), g, inorder)))),
            )
        ),
    )


def as_text(fingerprint: Column) -> Column:
    """The fingerprint as hexadecimal text."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def likeness(a: Column, b: Column, tuples: int = TUPLES) -> Column:
    """Share of equal hashes, 0 to 1; two texts without words are alike, one alone is not."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda same: same))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(equal / F.lit(float(tuples)))


def with_next(docs: DataFrame, derived: dict[str, Column], *columns: str) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the columns ``derived`` and with ``next_<column>`` of the
    next row in descending doc_id order (equal ids by text, null ids last); after the last row comes
    the first again.  ``derived`` is computed once per row, and for the copied rows below.

    Rows are dealt to ranges of doc_id between quantiles; the last row of each range is copied to
    the following one, so every range is complete by itself and no global sort is needed.  The
    driver sees the quantiles alone, at most ``MAX_RANGES``.
    """
    spark = docs.sparkSession
    ranges = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    marks = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    marks = F.lit(sorted(set(marks))).cast("array<bigint>") if marks else F.array().cast("array<bigint>")
    own = F.coalesce(F.size(F.filter(marks, lambda m: m < F.col("doc_id"))), F.lit(-1))
    dealt = docs.withColumn("range", F.when(F.col("doc_id").isNull(), -1).otherwise(own))
    lasts = dealt.groupBy("range").agg(F.max("doc_id").alias("last_id"))
    ring = Window.orderBy("range")  # over the ranges, a bounded table
    following = lasts.select("range", "last_id", F.coalesce(F.lead("range").over(ring), F.min("range").over(ring)).alias("to"))
    copied = (
        dealt.join(F.broadcast(following), "range")
        .where(F.col("doc_id").eqNullSafe(F.col("last_id")))
        .drop("range", "last_id")
        .withColumnRenamed("to", "range")
        .withColumn("copied", F.lit(True))
    )
    both = dealt.withColumn("copied", F.lit(False)).unionByName(copied).withColumns(derived)
    order = Window.partitionBy("range").orderBy(F.col("copied").desc(), F.col("doc_id").asc_nulls_first(), F.col("text"))
    return both.select("*", *[F.lag(c).over(order).alias(f"next_{c}") for c in columns]).where(~F.col("copied")).drop("range", "copied")


def fingerprint_edits(docs: DataFrame, width: int = WIDTH, tuples: int = TUPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, per row of ``docs`` (doc_id, text).

    Edited text: the last floor(n / 2) code points replaced by the first as many (or all) of the
    next document.  Null texts are empty; a text without words has the empty fingerprint.  Other
    columns are ignored; an empty table gives an empty result.
    """
    common.configure(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows, {"f": sketch(F.col("text"), width, tuples)}, "text", "f")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    # the edited text is sketched once, after the row's own and its next one's sketches
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"), "f", "next_f", sketch(F.col("edited"), width, tuples).alias("e"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e"), tuples).alias("near_edited"),
        likeness(F.col("f"), F.col("next_f"), tuples).alias("near_next"),
    )
