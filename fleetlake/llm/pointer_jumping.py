"""Alignment of two tokenizers' tokens by pointer jumping, with corpus-wide counts of linked ids.

Both tokenizers cover the same bytes.  Tokens of one that share bytes with a token of the other
overlap; groups are the components of that graph, and they end where tokens of both end.  Every token
points to the token of the other side that covers its last byte and reaches farther, or as far in
the case of an A token; a B token that no A token outreaches points to itself.  Doubling the
pointers (succ = succ[succ]) of all tokens at once until nothing changes takes each to the last
token of its component, which labels the group.

Both tokenizers always break in front of a space or a line feed behind a non-space character
(checked on the piece model; a model for which it does not hold gets whole texts).  So a text is a
sequence of *segments* whose alignments do not depend on each other, and a task aligns each distinct
segment of a block of documents once.

Corpus-wide counts do not shuffle a row per link.  A task packs documents into blocks bounded in bytes
and distinct segments; a block gives its distinct id pairs with the number of its documents that hold them.
These rows are summed over all blocks, the counts are joined back to the blocks' rows, and each
block's documents, which hold segment numbers only, are finished beside their block's counts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fleetlake.llm import common
from fleetlake.llm.tree_bpe import bytes_as_chars

#: Bytes of text, distinct segments and links of segments at which a block is closed (a document is
#: never cut, so a block holds one document at least).
BLOCK_BYTES, BLOCK_SEGMENTS, BLOCK_LINKS = 48 << 20, 250_000, 2_000_000

SPACE = "\u2581"
#: Unicode white space, the same set in both tokenizers' libraries; and without space and line feed,
#: in front of which no cut is made.
_FAR = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WS, _OTHER = r"\t-\r " + _FAR, r"\t\x0b-\r" + _FAR
SEGMENTS = re.compile(f"[{_WS}]*[^{_WS}]+(?:[{_OTHER}][{_WS}]*[^{_WS}]+)*(?:[{_OTHER}][{_WS}]*\\Z)?|[{_WS}]+")


def group_labels(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every A and every B token the number of the B token that ends its component.

    Both sides are contiguous covers of the same bytes by tokens that are not empty."""
    n = len(a_end)
    cover_b = np.searchsorted(b_start, a_end, side="left") - 1  # the B token with an A token's last byte
    cover_a = np.searchsorted(a_start, b_end, side="left") - 1
    succ = np.concatenate([n + cover_b, np.where(a_end[cover_a] > b_end, cover_a, n + np.arange(len(b_end)))])
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            break
        succ = further
    return succ[:n] - n, succ[n:] - n


def overlap_links(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) for every pair of tokens that share a byte, in order."""
    first = np.searchsorted(b_start, a_start, side="right") - 1
    last = np.searchsorted(b_start, a_end, side="left") - 1
    counts = last - first + 1
    a = np.repeat(np.arange(len(a_start)), counts)
    offsets = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return a, first[a] + np.arange(len(a)) - offsets[a]


def _spans(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(lengths)
    return ends - lengths, ends


class Aligner:
    """Both tokenizers and the alignment of segments.

    A is the JSON of a byte-level model of the tokenizers library without normaliser, B a
    sentencepiece model.  Special tokens that stand in a text are plain text."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        as_byte = {c: b for b, c in enumerate(bytes_as_chars())}
        self.a_bytes: list[bytes] = []
        for i in range(self.a.get_vocab_size()):
            token = self.a.id_to_token(i) or ""
            self.a_bytes.append(bytes(as_byte[c] for c in token) if all(c in as_byte for c in token) else token.encode("utf-8"))
        self.b_bytes: list[bytes] = []
        cuts = True
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.b_bytes.append(piece.replace(SPACE, " ").encode("utf-8"))
                cuts = cuts and SPACE not in piece.lstrip(SPACE) and "\n" not in piece
        self.bare_space = self.b.piece_to_id(SPACE)
        # the prefix space must be what the model adds, one that can be taken off, and spaces must stay
        spaces = b"".join(self.b_bytes[i] for i in self.b.encode("  "))
        self.cuts = cuts and self.bare_space != self.b.unk_id() and self.b.encode("\nx")[:1] == [self.bare_space] and spaces == b"   "
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_text = [str(i) for i in range(len(self.a_bytes))]
        self.b_text = [str(i) for i in range(len(self.b_bytes))]

    def segments(self, text: str) -> list[str]:
        """Segments of a space and the text, in order."""
        return SEGMENTS.findall(" " + text) if self.cuts else [" " + text]

    def _encode_b(self, segments: list[str]) -> list[list[int]]:
        """B's ids: the model adds the space that a segment begins with; of one that begins with a
        line feed the added space is taken off."""
        coded = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        return [([self.bare_space] if s == " " else c) if s[0] == " " else c[1:] for s, c in zip(segments, coded, strict=True)]

    def align(self, segments: list[str]) -> "Alignments":
        """All segments at once; one whose joined tokens of a side are not its bytes is not ``ok``
        and has no tokens."""
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        b = self._encode_b(segments)
        ab, bb = self.a_bytes, self.b_bytes
        ok = np.ones(len(segments), bool)
        for k, (s, x, y) in enumerate(zip(segments, a, b, strict=True)):
            raw = s.encode("utf-8")
            if b"".join([ab[i] for i in x]) != raw or b"".join([bb[i] for i in y]) != raw:
                ok[k] = False
                a[k] = b[k] = []
        return Alignments(self, ok, a, b)


class Alignments:
    """Groups and links of aligned segments, laid end to end."""

    def __init__(self, aligner: Aligner, ok: np.ndarray, a: list[list[int]], b: list[list[int]]):
        self.ok = ok
        self.n_a = np.array([len(x) for x in a], np.int64)
        self.n_b = np.array([len(x) for x in b], np.int64)
        a_ids = np.array([i for x in a for i in x], np.int64)
        b_ids = np.array([i for x in b for i in x], np.int64)
        a_start, a_end = _spans(aligner.a_len[a_ids])
        b_start, b_end = _spans(aligner.b_len[b_ids])
        a_of = np.repeat(np.arange(len(ok)), self.n_a)
        if len(a_ids):
            in_group, b_group = group_labels(a_start, a_end, b_start, b_end)
            at, to = overlap_links(a_start, a_end, b_start)
        else:
            in_group, b_group, at, to = (np.empty(0, np.int64) for _ in range(4))
        self.codes = (a_ids[at] << 32) | b_ids[to]  # A id and B id of every link
        self.links = np.bincount(a_of[at], minlength=len(ok)).astype(np.int64)
        # groups in order: a component's label is that of its last B token
        a_cut = np.flatnonzero(np.append(in_group[1:] != in_group[:-1], True)) + 1 if len(a_ids) else np.empty(0, np.int64)
        b_cut = np.flatnonzero(np.append(b_group[1:] != b_group[:-1], True)) + 1 if len(b_ids) else np.empty(0, np.int64)
        self.groups = np.bincount(a_of[a_cut - 1], minlength=len(ok)).astype(np.int64)
        at_, bt = [aligner.a_text[i] for i in a_ids.tolist()], [aligner.b_text[i] for i in b_ids.tolist()]
        texts, x, y = [], 0, 0
        for p, q in zip(a_cut.tolist(), b_cut.tolist(), strict=True):
            texts.append(",".join(at_[x:p]) + "|" + ",".join(bt[y:q]))
            x, y = p, q
        ends = np.cumsum(self.groups).tolist()
        self.texts = [";".join(texts[s:e]) for s, e in zip([0, *ends[:-1]], ends, strict=True)]


class Block:
    """Documents of one task whose segments share a numbering."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.number: dict[str, int] = {}
        self.size = 0
        self.links = 0
        self.docs: list[tuple] = []  # (row, segment numbers)
        self.columns: dict[str, list] = {k: [] for k in ("ok", "n_a", "n_b", "groups", "links", "codes")}
        self.texts: list[str] = []

    def add(self, rows: list, texts: list[str]) -> None:
        number, start = self.number, len(self.number)
        for row, text in zip(rows, texts, strict=True):
            found = self.aligner.segments(text) if text else []
            self.docs.append((row, np.array([number.setdefault(s, len(number)) for s in found], np.int64)))
            self.size += len(text)
        if len(number) > start:
            new = list(number)[start:] if start else list(number)
            got = self.aligner.align(new)
            for k in ("ok", "n_a", "n_b", "groups", "links", "codes"):
                self.columns[k].append(getattr(got, k))
            self.texts += got.texts
            self.links += len(got.codes)

    def full(self) -> bool:
        return self.size >= BLOCK_BYTES or len(self.number) >= BLOCK_SEGMENTS or self.links >= BLOCK_LINKS

    def finish(self, digest: bool) -> tuple[list[dict], dict]:
        """A record per document, and the block's dictionary: its pairs with the number of documents
        that hold them, and each segment's links as numbers of pairs."""
        c = {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in self.columns.items()}
        pairs, of_link = np.unique(c["codes"], return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(c["links"])]).astype(np.int64)
        held = np.zeros(len(pairs), np.int64)
        stamp = np.empty(len(pairs), np.int64)
        stated = np.empty(len(self.number), np.int64)
        ok = c["ok"].astype(bool)
        records = []
        for row, segs in self.docs:
            if len(segs) and ok[segs].all():
                n_a, n_b, n_groups, n_links = (int(c[k][segs].sum()) for k in ("n_a", "n_b", "groups", "links"))
                text = ";".join([self.texts[s] for s in segs.tolist()])
                stated[segs] = np.arange(len(segs))  # the last writer of a place stays: one entry a segment
                once = segs[stated[segs] == np.arange(len(segs))]
                links = of_link[_ranges(starts[once], starts[once + 1])]
                stamp[links] = np.arange(len(links))
                held[links[stamp[links] == np.arange(len(links))]] += 1
            else:
                n_a = n_b = n_groups = n_links = 0
                text, segs = "", segs[:0]
            records.append(
                {
                    "row": row,
                    "n_a": n_a,
                    "n_b": n_b,
                    "n_groups": n_groups,
                    "n_links": n_links,
                    "groups": (hashlib.sha256(text.encode()).hexdigest() if text else "") if digest else text,
                    "segments": np.sort(segs).astype("<u4").tobytes(),
                }
            )
        dictionary = {"pairs": pairs, "documents": held, "starts": starts.astype("<u4").tobytes(), "links": of_link.astype("<u4").tobytes()}
        return records, dictionary


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    n = ends - starts
    before = np.cumsum(n) - n
    return np.repeat(starts - before, n) + np.arange(int(n.sum()))


_ALIGNERS: dict[int, Aligner] = {}


def aligner(byte_level: bytes, pieces: bytes) -> Aligner:
    """One aligner per Python worker and pair of models."""
    key = hash((byte_level, pieces))
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(byte_level, pieces)
    return _ALIGNERS[key]


#: Records of documents, and (row null) one of a block's dictionary.
_RECORD = "n_a long, n_b long, n_groups long, n_links long, groups string, segments binary, block long, is_block boolean, pairs array<long>, documents array<long>, starts binary, links binary"


def _records(models, digest: bool, row_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(*models.value)
        task, seq = TaskContext.get().partitionId(), 0
        block = Block(tool)

        def flush() -> Iterator[pa.RecordBatch]:
            records, d = block.finish(digest)
            number = (task << 32) | seq
            for a in range(0, len(records), 4096):
                some = records[a : a + 4096]
                n = len(some)
                columns = [pa.array([r["row"] for r in some], row_type)]
                columns += [pa.array([r[k] for r in some], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")]
                columns += [pa.array([r["groups"] for r in some], pa.string()), pa.array([r["segments"] for r in some], pa.binary())]
                columns += [pa.array([number] * n, pa.int64()), pa.array([False] * n), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            if len(d["pairs"]):
                columns = [pa.nulls(1, row_type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.array([number], pa.int64()), pa.array([True])]
                columns += [pa.array([d["pairs"]], pa.list_(pa.int64())), pa.array([d["documents"]], pa.list_(pa.int64())), pa.array([d["starts"]], pa.binary()), pa.array([d["links"]], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        names = ["row", "n_a", "n_b", "n_groups", "n_links", "groups", "segments", "block", "is_block", "pairs", "documents", "starts", "links"]
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index("row")).to_pylist()
            (texts,) = common.batches_of(batch, "text")
            for a in range(0, len(rows), 64):
                block.add(rows[a : a + 64], [t or "" for t in texts[a : a + 64]])
                if block.full():
                    yield from flush()
                    block, seq = Block(tool), seq + 1
        yield from flush()

    return run


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a block beside its counts: each segment's sums once, then each document's."""
    counts = right.filter(pc.is_valid(right.column("starts")))
    if counts.num_rows:
        starts = np.frombuffer(counts.column("starts")[0].as_py(), "<u4").astype(np.int64)
        links = np.frombuffer(counts.column("links")[0].as_py(), "<u4").astype(np.int64)
        rows = right.filter(pc.is_null(right.column("starts")))
        found = np.zeros(rows.num_rows, np.int64)
        best = np.zeros(rows.num_rows, np.int64)
        at = rows.column("pair_no").to_numpy()
        found[at] = rows.column("held").to_numpy()
        best[at] = rows.column("is_best").to_numpy()
        sums = np.concatenate([[0], np.cumsum(found[links])])
        bests = np.concatenate([[0], np.cumsum(best[links])])
        seg_sum, seg_best = sums[starts[1:]] - sums[starts[:-1]], bests[starts[1:]] - bests[starts[:-1]]
    else:
        seg_sum = seg_best = np.empty(0, np.int64)
    segs = [np.frombuffer(x, "<u4") for x in left.column("segments").to_pylist()]
    sums_of = [pa.array([int(per_segment[s].sum()) for s in segs], pa.int64()) for per_segment in (seg_best, seg_sum)]
    kept = left.select(["row", "n_a", "n_b", "n_groups", "n_links", "groups"])
    return kept.append_column("n_best", sums_of[0]).append_column("count_sum", sums_of[1])


def link_counts(blocks: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, documents): in how many documents an A id and a B id are linked."""
    pairs = blocks.where("is_block").select(F.explode(F.arrays_zip("pairs", "documents")).alias("e")).groupBy(F.col("e.pairs").alias("pair"))
    return pairs.agg(F.sum("e.documents").alias("documents")).select("pair", F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id"), "documents")


def align_blocks(docs: DataFrame, byte_level: bytes, pieces: bytes, digest: bool = False) -> DataFrame:
    """The written records of documents and blocks that ``align_documents`` and ``link_counts`` read."""
    spark = docs.sparkSession
    common.configure(spark)
    models = spark.sparkContext.broadcast((byte_level, pieces))  # two tokenizer files, a few megabytes
    others = [c for c in docs.columns if c not in ("text", *RESULTS)]
    packed = docs.select(F.struct(*([F.col(c) for c in others] or [F.lit(None).cast("string").alias("_none")])).alias("row"), F.col("text").cast("string").alias("text"))
    row = packed.schema["row"].dataType
    out = packed.mapInArrow(_records(models, digest, to_arrow_type(row)), f"row {row.simpleString()}, {_RECORD}")
    return common.written(out, "alignment-blocks")


RESULTS = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")


def align_documents(docs: DataFrame, byte_level: bytes, pieces: bytes, digest: bool = False) -> DataFrame:
    """``docs`` without text, with the alignment of a space and the text by both tokenizers:

    n_a, n_b (tokens), n_groups, n_links (pairs of tokens that share bytes), groups
    (``a1,a2|b1;a3|b2,b3``: the ids of each group; with ``digest`` its SHA-256, '' without tokens),
    n_best (links whose pair of ids is in as many documents as any pair of the same A id), count_sum
    (over the links: documents of the whole table that hold the pair of ids linked).  Texts that are
    null or empty, or that either side's tokens do not give back, have no tokens: zeros and ''.
    Repeated rows count as documents of their own; columns of the results' names are replaced, other
    columns pass through; an empty table stays empty.
    """
    blocks = align_blocks(docs, byte_level, pieces, digest)
    counts = link_counts(blocks)
    best = counts.groupBy("a_id").agg(F.max("documents").alias("top"))
    rated = counts.join(best, "a_id").select("pair", F.col("documents").alias("held"), (F.col("documents") == F.col("top")).cast("long").alias("is_best"))
    rows = blocks.where("is_block").select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("pair_no", "pair"))
    found = rows.join(rated, "pair").select("of_block", F.col("pair_no").cast("long").alias("pair_no"), "held", "is_best", F.lit(None).cast("binary").alias("starts"), F.lit(None).cast("binary").alias("links"))
    zero = F.lit(0).cast("long")
    heads = blocks.where("is_block").select(F.col("block").alias("of_block"), zero.alias("pair_no"), zero.alias("held"), zero.alias("is_best"), "starts", "links")
    records = blocks.where("not is_block").select("row", "n_a", "n_b", "n_groups", "n_links", "groups", "segments", "block")
    kind = records.schema["row"].dataType.simpleString()
    done = (
        records.groupBy("block")
        .cogroup(found.unionByName(heads).groupBy("of_block"))
        .applyInArrow(_finish, f"row {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long")
    )
    others = [c for c in docs.columns if c not in ("text", *RESULTS)]
    return done.select(*[F.col("row").getField(c).alias(c) for c in others], *RESULTS)
