"""SentencePiece encoding and decoding as a weighted transduction.

Three machines are compiled from a public ``.model`` file (its pieces, scores and normaliser flags;
nothing is trained here) and composed with each input:

* the normaliser: white space escaped as U+2581, the dummy prefix;
* the pieces: an acceptor of every piece, its arcs weighted by the negated score;
* byte fallback: a character without a piece becomes one arc per UTF-8 byte.

The encoding is the path of least total weight (tropical semiring).  In a unigram model any sequence
of pieces is a path.  In a BPE model two pieces may follow each other only if merging their
concatenation would give back these two; the pair gets weight infinity otherwise.  A sequence
whose neighbours all fit is the BPE encoding of its text, so exactly one finite path reaches each
position and the state of a position is its last piece.

The search runs over many distinct words at once (arrays, one column per position); the text is cut
beforehand between characters that no piece holds side by side, which no path could cross.
Encoded words are kept per Python worker in a cache of bounded size.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm import common

# Fixed values of the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"

NONE = np.int64(1) << 40


def wire_fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message: ints, 4-byte and length-delimited bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, raw[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, raw[at : at + n]
            at += n


class PieceModel:
    """Pieces, scores and flags of a model file."""

    def __init__(self, raw: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.algorithm, self.dummy_prefix, self.squeeze, self.charsmap = UNIGRAM, True, True, b""
        for field, value in wire_fields(raw):
            if field == 1:
                piece, score, kind = "", 0.0, NORMAL
                for f, v in wire_fields(value):
                    if f == 1:
                        piece = v.decode()
                    elif f == 2:
                        (score,) = struct.unpack("<f", v)
                    elif f == 3:
                        kind = v
                self.pieces.append(piece)
                self.scores.append(score)
                self.kinds.append(kind)
            elif field == 2:
                for f, v in wire_fields(value):
                    if f == 3:
                        self.algorithm = v
            elif field == 3:
                for f, v in wire_fields(value):
                    if f == 2:
                        self.charsmap = v
                    elif f == 3:
                        self.dummy_prefix = bool(v)
                    elif f == 4:
                        self.squeeze = bool(v)
        if self.charsmap:
            raise ValueError("models with a character map are not supported")
        if self.algorithm not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")


class Transducer:
    """The compiled machines; ``encode`` and ``decode``."""

    cache_words = 400_000

    def __init__(self, raw: bytes):
        m = self.model = PieceModel(raw)
        self.dtype = np.uint16 if len(m.pieces) <= 1 << 16 else np.uint32
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(m.pieces, m.kinds, strict=True)) if k == BYTE}
        self.unknown = m.kinds.index(UNKNOWN)
        usable = {p: i for i, (p, k) in enumerate(zip(m.pieces, m.kinds, strict=True)) if k in (NORMAL, USER_DEFINED)}
        order = {s: r for r, s in enumerate(sorted({m.scores[i] for i in usable.values()}, reverse=True))}
        self.rank_of = {p: order[m.scores[i]] for p, i in usable.items()}
        n = len(m.pieces)
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        held = set()
        joins = []
        if m.algorithm == BPE:
            for p, i in usable.items():
                parts = self._merge(p) if len(p) > 1 else [p]
                if len(p) > 1 and len(parts) == 2:
                    # the last merge gives the piece itself
                    self.rank[i], self.left[i], self.right[i] = self.rank_of[p], usable[parts[0]], usable[parts[1]]
                if len(p) == 1 or len(parts) == 2:
                    held.add(p)
            for p, i in usable.items():
                joins += [(usable[p[:c]], usable[p[c:]], i) for c in range(1, len(p)) if p[:c] in usable and p[c:] in usable]
            counts: dict[int, int] = {}
            for p in held:
                if len(p) > 1:
                    counts[self.rank_of[p]] = counts.get(self.rank_of[p], 0) + 1
            # pieces that share their score with others: merging order among them is by place
            self.tied = np.zeros(n, bool)
            for p in held:
                self.tied[usable[p]] = len(p) > 1 and counts[self.rank_of[p]] > 1
        else:
            held = set(usable)
            self.tied = np.zeros(n, bool)
        keys = np.array([a << 20 | b for a, b, _ in joins], np.int64)
        by = np.argsort(keys)
        self.join_keys = keys[by]
        self.join_ranks = np.array([self.rank_of[m.pieces[i]] for _, _, i in joins], np.int64)[by]
        self.join_bits = np.zeros(1 << 21, bool)
        self.join_bits[((self.join_keys >> 20) * 40503 + (self.join_keys & 0xFFFFF) * 7919) & 0x1FFFFF] = True
        self.pairs_seen: dict[tuple[int, int], bool] = {}
        chars = sorted({c for p in held for c in p})
        self.code = {c: i + 1 for i, c in enumerate(chars)}
        self.code_of = np.zeros(0x110000, np.uint32)
        self.code_of[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        # which characters some piece holds side by side; number 0 stands for all other characters
        pairs = {p[c : c + 2] for p in held for c in range(len(p) - 1)}
        inner = {c: i + 1 for i, c in enumerate(sorted({c for pair in pairs for c in pair}))}
        self.inner_of = np.zeros(0x110000, np.uint16)
        self.inner_of[[ord(c) for c in inner]] = list(inner.values())
        self.inside = np.zeros((len(inner) + 1, len(inner) + 1), bool)
        for x, y in pairs:
            self.inside[inner[x], inner[y]] = True
        self.feed_alone = not any("\n" in pair for pair in pairs) and not any(pair[1] == SPACE and pair[0] != SPACE for pair in pairs)
        self.longest = max(map(len, held), default=1)
        # substring hashes: polynomial over character codes modulo 2**64
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.powers = np.array([pow(int(self.base), l, 1 << 64) for l in range(self.longest + 1)], np.uint64)
        ids = np.array([usable[p] for p in held], np.int64)
        hashes = np.array([self._hash(p) for p in held], np.uint64)
        by = np.argsort(hashes)
        self.hashes, self.ids = hashes[by], ids[by]
        if len(np.unique(self.hashes)) != len(self.hashes):
            raise ValueError("piece hashes collide")
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        self.weight = -np.array(m.scores)
        self.cache: dict[str, bytes] = {}  # words
        self.held: dict[str, bytes] = {}  # segments
        self.surface = [self._surface(i) for i in range(n)]

    def _merge(self, text: str) -> list[str]:
        """BPE by repeated best merge (leftmost of equals); if all of it becomes one piece, the two
        parts of its last merge.  Used on pieces and pairs of pieces while compiling."""
        parts = list(text)
        while len(parts) > 1:
            best = min(((self.rank_of[a + b], i) for i, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True)) if a + b in self.rank_of), default=None)
            if best is None or len(parts) == 2:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _hash(self, s: str) -> int:
        h = 0
        for c in s:
            h = (h * int(self.base) + self.code[c]) & 0xFFFFFFFFFFFFFFFF
        return h

    def _fits_slowly(self, a: int, b: int) -> bool:
        """Whether merging the concatenation of two pieces gives back the two."""
        found = self.pairs_seen.get((a, b))
        if found is None:
            p, q = self.model.pieces[a], self.model.pieces[b]
            parts = list(p + q)
            while True:
                best = min(((self.rank_of[x + y], i) for i, (x, y) in enumerate(zip(parts[:-1], parts[1:], strict=True)) if x + y in self.rank_of), default=None)
                if best is None:
                    break
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            found = self.pairs_seen[a, b] = parts == [p, q]
        return found

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For arrays of neighbouring pieces: whether BPE keeps them apart.

        Runs the merges that built the two pieces backwards, latest first, along the right edge of
        the first and the left edge of the second; if at some moment the two symbols at the border
        could have merged before the merge just undone, the pair cannot occur.
        """
        ok = np.ones(len(a), bool)
        odd = self.tied[a] | self.tied[b]
        for i in np.flatnonzero(odd).tolist():
            ok[i] = self._fits_slowly(int(a[i]), int(b[i]))
        at = np.flatnonzero(~odd)
        x, y = a[at].astype(np.int64), b[at].astype(np.int64)
        limit = np.full(len(at), NONE)
        while len(at):
            # most pairs have no merge at all; a table of hash bits tells them at once
            maybe = np.flatnonzero(self.join_bits[(x * 40503 + y * 7919) & 0x1FFFFF])
            keys = x[maybe] << 20 | y[maybe]
            place = np.minimum(np.searchsorted(self.join_keys, keys), len(self.join_keys) - 1)
            bad = np.zeros(len(at), bool)
            bad[maybe] = (self.join_keys[place] == keys) & (self.join_ranks[place] < limit[maybe])
            ok[at[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry = at[go], x[go], y[go], rx[go], ry[go]
            undo_left = rx > ry
            # of equal merges the one further left comes first
            limit = np.where(undo_left, rx, ry + 1)
            x = np.where(undo_left, self.right[x], x)
            y = np.where(undo_left, y, self.left[y])
        return ok

    # --- search -----------------------------------------------------------------------------------

    def _lookup(self, h: np.ndarray) -> np.ndarray:
        """Piece of each substring hash, -1 for none."""
        out = np.full(len(h), -1, np.int64)
        some = np.flatnonzero(self.filter[(h >> np.uint64(44)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)
            hit = self.hashes[at] == h[some]
            out[some[hit]] = self.ids[at[hit]]
        return out

    def shortest_paths(self, segments: list[str]) -> list[bytes]:
        """Piece ids of each segment (all its characters have a code), as bytes of ``dtype``."""
        out: list = [b""] * len(segments)
        by_length: dict[int, list[int]] = {}
        for i, s in enumerate(segments):
            by_length.setdefault(len(s), []).append(i)
        for length, members in by_length.items():
            for a in range(0, len(members), 1 << 15):
                rows = members[a : a + (1 << 15)]
                points = np.frombuffer("".join([segments[i] for i in rows]).encode("utf-32-le"), np.uint32)
                last, back = self._search(self.code_of[points].astype(np.uint64).reshape(len(rows), length).T)
                # the paths, from their ends
                most = length
                ids = np.zeros((len(rows), most), self.dtype)
                ends, used, alive = np.full(len(rows), length), np.zeros(len(rows), np.int64), np.arange(len(rows))
                while len(alive):
                    at = ends[alive]
                    used[alive] += 1
                    ids[alive, most - used[alive]] = last[at, alive]
                    ends[alive] = at - back[at, alive]
                    alive = alive[ends[alive] > 0]
                raw, width = ids.tobytes(), ids.itemsize
                for r, (i, n) in enumerate(zip(rows, used.tolist(), strict=True)):
                    out[i] = raw[((r + 1) * most - n) * width : (r + 1) * most * width]
        return out

    def _search(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For equally long segments (position x segment): the last piece of the shortest path to
        each position, and its length."""
        length, n = codes.shape
        bpe = self.model.algorithm == BPE
        prefix = np.zeros((length + 1, n), np.uint64)
        for e in range(length):
            prefix[e + 1] = prefix[e] * self.base + codes[e]
        last = np.full((length + 1, n), -1, np.int64)
        back = np.zeros((length + 1, n), np.int64)
        cost = np.full((length + 1, n), np.inf)
        cost[0] = 0
        for e in range(1, length + 1):
            open_ = np.arange(n)
            for l in range(min(e, self.longest), 0, -1):
                s = e - l
                piece = self._lookup(prefix[e, open_] - prefix[s, open_] * self.powers[l])
                some = np.flatnonzero(piece >= 0)
                if not len(some):
                    continue
                who, piece = open_[some], piece[some]
                ok = np.isfinite(cost[s, who])
                if bpe and s:
                    ok[ok] = self.fits(last[s, who[ok]], piece[ok])
                new = cost[s, who] + self.weight[piece]
                ok &= new < cost[e, who]
                cost[e, who[ok]], last[e, who[ok]], back[e, who[ok]] = new[ok], piece[ok], l
                if bpe and ok.any():
                    # the only finite path to this place has been found
                    done = np.zeros(len(open_), bool)
                    done[some[ok]] = True
                    open_ = open_[~done]
                    if not len(open_):
                        break
        return last, back

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of normalised texts, as bytes: cut where no path can cross, then searched together."""
        if not units:
            return []
        joined = "".join(units)
        ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        inner = self.inner_of[points]
        cut = ~self.inside[inner[:-1], inner[1:]] if len(points) > 1 else np.zeros(0, bool)
        cut = np.concatenate([[True], cut])[: len(points)]
        cut[ends[ends < len(points)]] = True
        starts = np.flatnonzero(cut)
        bounds = [*starts.tolist(), len(points)]
        segments = [joined[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        held = self.held
        if len(held) > self.cache_words:
            held.clear()
        new = list(dict.fromkeys([s for s in segments if s not in held]))
        coded = []
        for s in new:
            if len(s) > 1 or s in self.code:
                coded.append(s)
            else:
                raw = s.encode("utf-8", "surrogatepass")
                held[s] = np.array([self.bytes.get(b, self.unknown) for b in raw] if self.bytes else [self.unknown], self.dtype).tobytes()
        held.update(zip(coded, self.shortest_paths(coded), strict=True))
        found = [held[s] for s in segments]
        last = np.searchsorted(starts, ends).tolist()
        return [b"".join(found[a:b]) for a, b in zip([0, *last[:-1]], last, strict=True)]

    def normalise(self, text: str) -> str:
        """The normaliser's output for a whole text."""
        if self.model.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        return ((" " if self.model.dummy_prefix else "") + text).replace(" ", SPACE)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``dtype``.

        Words are taken from the cache: a part is a word after a space, or a line feed and what
        follows it.  Texts in which such parts could influence each other (two spaces in a row, no
        dummy prefix, the space symbol itself) are searched whole.
        """
        parts_of: list[list[str] | None] = []
        new: dict[str, None] = {}
        whole: list[str] = []
        if len(self.cache) > self.cache_words:
            self.cache.clear()
        for text in texts:
            parts = None
            if self.model.squeeze:
                text = " ".join(x for x in text.split(" ") if x)
            if text and self.feed_alone and self.model.dummy_prefix and SPACE not in text:
                parts = text.replace("\n", " \n").split(" ")
                if "" in parts or parts[0][0] == "\n":
                    parts = None
                else:
                    for p in parts:
                        if p not in self.cache:
                            new[p] = None
            if parts is None:
                whole.append(self.normalise(text))
            parts_of.append(parts)
        names = list(new)
        for a in range(0, len(names), 50_000):
            some = names[a : a + 50_000]
            self.cache.update(zip(some, self._encode_units([p if p[0] == "\n" else SPACE + p for p in some]), strict=True))
        rest = iter(self._encode_units(whole))
        return [next(rest) if parts is None else b"".join(map(self.cache.__getitem__, parts)) for parts in parts_of]

    def _surface(self, i: int) -> bytes:
        kind = self.model.kinds[i]
        if kind == BYTE:
            return bytes([int(self.model.pieces[i][3:5], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return self.model.pieces[i].replace(SPACE, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """The text of a sequence of ids: byte pieces joined to UTF-8 (what is not UTF-8 becomes
        U+FFFD), the dummy prefix taken off."""
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


def compiled(raw: bytes) -> Transducer:
    """One compiled transducer per Python worker and model."""
    key = ("transducer", hash(raw))
    if key not in common.KEPT:
        common.KEPT[key] = Transducer(raw)
    return common.KEPT[key]


def encode_documents(docs: DataFrame, model: bytes, check: bool = False) -> DataFrame:
    """``docs`` with input_ids (array<int>) and, if ``check``, decoded (the text that the ids
    decode to); columns of these names are replaced.  A null text is empty and has no ids; only
    ``text`` is read, every other column passes through, row by row."""
    spark = docs.sparkSession
    docs = docs.drop("input_ids", "decoded")
    common.configure(spark)
    shared = spark.sparkContext.broadcast(model)  # a tokenizer file, about a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(shared.value)
        for batch in batches:
            (texts,) = common.batches_of(batch, "text")
            raws = t.encode_batch([x or "" for x in texts])
            ids = np.frombuffer(b"".join(raws), t.dtype)
            offsets = np.cumsum([0, *(len(r) // ids.itemsize for r in raws)])
            columns = [batch.column(batch.schema.get_field_index("row")), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))]
            if check:
                columns.append(pa.array([t.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["row", "input_ids", "decoded"][: len(columns)])

    packed = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), F.col("text").cast("string").alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    out = packed.mapInArrow(run, f"row {kind}, input_ids array<int>" + ", decoded string" * check)
    return out.select("row.*", "input_ids", *["decoded"] * check)
