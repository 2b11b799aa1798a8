"""Token ids in wavelet-matrix shard files.

A shard holds the ids of consecutive documents as succinct bit planes, most significant bit first:
plane ``k`` has one bit per token, and the tokens are then reordered stably, zeros before ones, for
the next plane.  With the ones counted before every block of ``BLOCK`` bits this gives, from the one
file and without decoding it: the token at a position, the number of times a token occurs before a
position, and the position of its n-th occurrence.

File layout (little-endian): the bytes ``WMX1``, the header's length as uint32, a JSON header
{tokens, documents, planes, zeros: [per plane]}, the doc_ids (int64), a validity byte per doc_id,
the documents' token counts (int64), then per plane the packed bits (most significant bit of a byte
first) followed by the block counts (uint32, exclusive).

Documents are range-partitioned by doc_id and sorted; each task writes shards of about
``SHARD_TOKENS`` ids as it goes, so its memory is bounded.  File names carry a random part and only
the manifest of the finished tasks names files, so a repeated task or a lost executor leaves at
worst an unnamed file.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm import common

SHARD_TOKENS = 4 << 20
BLOCK = 1024
PIECE = 1 << 14
MAX_READ_TASKS = 20_000
MAGIC = b"WMX1"


def pieces(ones: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(start, places of zeros, places of ones) of consecutive pieces of a plane that fit the
    processor's cache."""
    for a in range(0, len(ones), PIECE):
        piece = ones[a : a + PIECE]
        yield a, np.flatnonzero(~piece), np.flatnonzero(piece)


class WaveletMatrix:
    """A sequence of unsigned ids as bit planes with rank directories."""

    def __init__(self, length: int, planes: list[np.ndarray], blocks: list[np.ndarray], zeros: list[int]):
        self.length, self.planes, self.blocks, self.zeros = length, planes, blocks, zeros

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        cur = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        planes, blocks, zeros = [], [], []
        for bit in range(depth - 1, -1, -1):
            ones = (cur & cur.dtype.type(1 << bit)) != 0
            packed = np.packbits(ones)
            planes.append(packed)
            blocks.append(cls.directory(packed))
            low = len(cur) - int(np.count_nonzero(ones))
            zeros.append(low)
            out, high = np.empty_like(cur), low
            low = 0
            for a, zero, one in pieces(ones):
                piece = cur[a : a + PIECE]
                out[low : low + len(zero)] = piece.take(zero)
                out[high : high + len(one)] = piece.take(one)
                low, high = low + len(zero), high + len(one)
            cur = out
        return cls(len(ids), planes, blocks, zeros)

    @staticmethod
    def directory(packed: np.ndarray) -> np.ndarray:
        step = BLOCK // 8
        counts = np.bitwise_count(packed).astype(np.uint32)
        sums = np.add.reduceat(counts, np.arange(0, len(counts), step)) if len(counts) else np.zeros(0, np.uint32)
        return np.concatenate([[0], np.cumsum(sums)[:-1]]).astype(np.uint32) if len(sums) else np.zeros(0, np.uint32)

    def ones_before(self, plane: int, at: int) -> int:
        """Ones among the first ``at`` bits of a plane."""
        if at == 0:
            return 0
        block = min(at // BLOCK, len(self.blocks[plane]) - 1)
        packed, byte = self.planes[plane], at // 8
        n = int(self.blocks[plane][block]) + int(np.bitwise_count(packed[block * (BLOCK // 8) : byte]).sum())
        return n + (int(packed[byte]) >> (8 - at % 8)).bit_count() if at % 8 else n

    def bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at // 8]) >> (7 - at % 8) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.length:
            raise IndexError(at)
        value = 0
        for k in range(len(self.planes)):
            one = self.bit(k, at)
            value = value << 1 | one
            before = self.ones_before(k, at)
            at = self.zeros[k] + before if one else at - before
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        start = 0
        for k in range(len(self.planes)):
            a, b = self.ones_before(k, start), self.ones_before(k, end)
            if value >> (len(self.planes) - 1 - k) & 1:
                start, end = self.zeros[k] + a, self.zeros[k] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, value: int, end: int | None = None) -> int:
        """Occurrences of an id among the first ``end`` positions (all by default)."""
        if value < 0 or value.bit_length() > len(self.planes):
            return 0
        start, stop = self._range(value, self.length if end is None else end)
        return stop - start

    def _select_bit(self, plane: int, one: int, n: int) -> int:
        """Position of the n-th (from 0) bit of a kind in a plane."""
        blocks = self.blocks[plane].astype(np.int64)
        before = blocks if one else np.arange(len(blocks)) * BLOCK - blocks
        block = int(np.searchsorted(before, n, side="right")) - 1
        bits = np.unpackbits(self.planes[plane][block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)])
        return block * BLOCK + int(np.flatnonzero(bits == one)[n - int(before[block])])

    def locate(self, value: int, n: int) -> int:
        """Position of the n-th (from 0) occurrence of an id."""
        if not 0 <= n < self.count(value):
            raise IndexError(n)
        at = self._range(value, self.length)[0] + n
        for k in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - k) & 1
            at = self._select_bit(k, one, at - self.zeros[k] if one else at)
        return at

    def all_ids(self) -> np.ndarray:
        """Every id in order: the planes' reorderings undone from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        cur = np.zeros(self.length, kind)
        for k in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[k], count=self.length).view(bool)
            prev = np.empty(self.length, kind)
            bit = kind(1 << (len(self.planes) - 1 - k))
            low, high = 0, self.zeros[k]
            for a, zero, one in pieces(ones):
                piece = prev[a : a + PIECE]
                piece[zero] = cur[low : low + len(zero)]
                piece[one] = cur[high : high + len(one)] | bit
                low, high = low + len(zero), high + len(one)
            cur = prev
        return cur


def shard_bytes(doc_ids: list, lengths: list[int], ids: np.ndarray) -> list[bytes]:
    """The parts of a shard file."""
    wm = WaveletMatrix.build(ids)
    header = json.dumps({"tokens": wm.length, "documents": len(doc_ids), "planes": len(wm.planes), "zeros": wm.zeros}).encode()
    parts = [
        MAGIC,
        np.uint32(len(header)).tobytes(),
        header,
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], "u1").tobytes(),
        np.array(lengths, "<i8").tobytes(),
    ]
    for plane, blocks in zip(wm.planes, wm.blocks, strict=True):
        parts += [plane.tobytes(), blocks.astype("<u4").tobytes()]
    return parts


def parse_shard(raw) -> tuple[list, np.ndarray, WaveletMatrix]:
    """(doc_ids, token counts, wavelet matrix) of a shard file's bytes."""
    view = memoryview(raw)
    if bytes(view[:4]) != MAGIC:
        raise ValueError("not a wavelet shard")
    size = int(np.frombuffer(view[4:8], "<u4")[0])
    head = json.loads(bytes(view[8 : 8 + size]))
    at, n, docs = 8 + size, head["tokens"], head["documents"]

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(view, kind, count, at)
        at += out.nbytes
        return out

    values, valid, lengths = take("<i8", docs), take("u1", docs), take("<i8", docs)
    planes, blocks = [], []
    for _ in range(head["planes"]):
        planes.append(take("u1", -(-n // 8)))
        blocks.append(take("<u4", -(-n // BLOCK)))
    return [int(v) if ok else None for v, ok in zip(values, valid, strict=True)], lengths, WaveletMatrix(n, planes, blocks, head["zeros"])


#: The byte-level pre-tokenizer's public pattern (a fixed value).
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class CachedEncoder:
    """``tokenizer.encode`` with the ids of frequent words kept.

    The byte-level pre-tokenizer always cuts before a single space and around a single line feed
    that stand between characters that are not white space, so a text of such words is the
    concatenation of its words' ids.  A word not yet held goes through the library's pre-tokenizer
    and model; any other text goes to the library whole.
    """

    #: Words held (about 200 bytes each); all are dropped when there are more.
    limit = 1_600_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.kind = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.held: dict[str, bytes] = {}
        self.code = "H" if self.kind is np.uint16 else "I"
        self.model = self.tok.model
        self.model._resize_cache(0)  # words are held here
        self.pieces: dict[str, bytes] = {}
        self.feed = len(self.whole("\n"))  # the one put before the text
        # the shortcut is taken only where the library itself cuts and maps in this way
        self.alphabet = byte_alphabet()
        cut = self.tok.pre_tokenizer
        self.cuts = self.tok.normalizer is None and cut is not None and len(self.whole("\n")) == self.feed
        for probe in ("a\n b1\nc d, e", "it's 42ndé!\tx  y\r\n z", "\u00a0日本 語 \x1f_"):
            mapped = ["".join(self.alphabet[b] for b in p.encode()) for p in PRE_TOKENS.findall(probe)]
            self.cuts = self.cuts and [p for p, _ in cut.pre_tokenize_str(probe)] == mapped

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token: the model's tokens of its bytes in the byte-level alphabet."""
        if piece.isascii() and piece.isprintable():
            piece = piece.replace(" ", self.alphabet[32])
        else:
            piece = "".join([self.alphabet[b] for b in piece.encode()])
        return array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _word(self, word: str) -> bytes | None:
        """Ids of a word after a space, or of a line feed and a word; None if it is not one word."""
        if word.isalpha():
            return self._piece(" " + word)
        text = word if word[:1] == "\n" else " " + word
        bare = text[1:]
        if not bare or len(bare.split()) != 1 or bare[0].isspace() or bare[-1].isspace():
            return None
        out = []
        for piece in PRE_TOKENS.findall(text):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self._piece(piece)
                if len(piece) < 4:
                    self.pieces[piece] = ids
                    if len(self.pieces) > 50_000:
                        self.pieces.clear()
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian bytes of ``kind``."""
        if not self.cuts or not text or any(s in text for s in self.special):
            return self.whole(text)
        # a part is a word, or a line feed and a line's first word
        parts = ("\n" + text).replace("\n", " \n").split(" ")
        del parts[0]
        held = self.held
        found = list(map(held.get, parts))
        if None in found:
            if len(held) > self.limit:
                held.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    word = parts[i]
                    ids = held.get(word) or self._word(word)
                    if ids is None:
                        return self.whole(text)
                    held[word] = found[i] = ids
        return b"".join(found)[self.feed :]


_ENCODERS: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """One encoder per Python worker, so that held words outlive a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]


def _write(folder: str, tokenizer_path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        end = np.array([end_id], enc.kind).tobytes()
        width = np.dtype(enc.kind).itemsize
        fs, base = common.open_filesystem(folder)
        task = TaskContext.get().partitionId()
        docs, lengths, held, total, seq = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, lengths, held, total, seq
            name = f"shard-{task:06d}-{seq:06d}-{uuid.uuid4().hex}.wm"
            ids = np.frombuffer(b"".join(held), enc.kind)
            held = []
            with fs.open_output_stream(f"{base}/{name}") as out:
                for part in shard_bytes(docs, lengths, ids):
                    out.write(part)
            row = pa.RecordBatch.from_pylist([{"task": task, "seq": seq, "path": f"{folder}/{name}", "tokens": total, "documents": len(docs)}])
            docs, lengths, total, seq = [], [], 0, seq + 1
            return row

        for batch in batches:
            ids, texts = common.batches_of(batch, "doc_id", "text")
            for doc, text in zip(ids, texts, strict=True):
                raw = enc.encode(text) + end
                docs.append(doc)
                lengths.append(len(raw) // width)
                held.append(raw)
                total += lengths[-1]
                if total >= shard_tokens:
                    yield flush()
        if docs:
            yield flush()

    return run


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the documents' ids (each followed by ``end_id``) in ascending doc_id order as shard
    files below ``folder`` (any URI that pyarrow's filesystems open, shared by all executors).

    Returns the written manifest (task, seq, path, tokens, documents); ascending (task, seq) is
    ascending doc_id.  A null text is empty; null doc_ids come first; rows that repeat a doc_id are
    ordered by text.  Other columns are ignored; an empty table writes no shard.
    """
    spark = docs.sparkSession
    common.configure(spark)
    fs, base = common.open_filesystem(folder)
    fs.create_dir(base, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = rows.mapInArrow(_write(folder, tokenizer_path, end_id, shard_tokens), "task long, seq long, path string, tokens long, documents long")
    return common.written(manifest, "wavelet-manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, first in zip(*common.batches_of(batch, "path", "first"), strict=True):
            fs, name = common.open_filesystem(path)
            with fs.open_input_file(name) as f:
                docs, lengths, wm = parse_shard(f.read_buffer())
            ids = wm.all_ids().astype("<u4")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array(starts + first, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shard files."""
    # ids before each task, then before each shard of a task: two small sums, no global sort of rows
    tasks = manifest.groupBy("task").agg(F.sum("tokens").alias("tokens"))
    before = tasks.select("task", (F.sum("tokens").over(Window.orderBy("task")) - F.col("tokens")).alias("before"))
    within = F.sum("tokens").over(Window.partitionBy("task").orderBy("seq")) - F.col("tokens")
    shards = manifest.withColumn("within", within).join(before, "task").select("path", (F.col("before") + F.col("within")).alias("first"))
    files = max(1, min(manifest.count(), MAX_READ_TASKS))
    # a number, since the rows are tiny and the work behind them is not
    return shards.repartition(files).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(spark: SparkSession, docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Write all documents and return what the files say about each."""
    folder = folder or common.as_uri(common.scratch_path(spark, "wavelet-shards"))
    return read_documents(write_shards(docs, folder, tokenizer_path))
