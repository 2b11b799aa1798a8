"""Byte-pair encoding by tree concatenation.

A text is normalised and cut into words by the tokenizer's own rules.  A word of up to ``LEAF``
symbols is encoded at once.  A longer one is halved until its parts are that short; all parts are
encoded side by side, and then joined pairwise up the tree: the tokens around a join are taken as
one string and encoded again, and the window grows until its first token is the left half's and its
last one the right half's.  Byte-pair merging has exactly one sequence of tokens in which every two
neighbours would stay apart when encoded alone; both halves and the window are such sequences, and
agreement at both rims makes every remaining pair one of a half or of the window, so the joined
sequence is the encoding of the whole word.  A join costs what its window costs, so the time is
linear in the word's length but for the copying of ids up the tree.

Work on Spark is narrow: texts are encoded where they lie, and nothing is collected.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm import common

#: Symbols (bytes) of a word that is encoded at once.
LEAF = 512
#: Tokens of each side that the first window around a join holds.
FIRST_WINDOW = 2
#: Encoded chunks that a Python worker holds, and the bytes of a chunk worth holding.
HELD_CHUNKS, HELD_BYTES = 300_000, 64

#: A tokenizer with these rules encodes the text between two ASCII white-space characters alone:
#: no composition, replacement or word spans them.
CHUNK_NORMALIZER = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]
#: White space other than ASCII's; a chunk that holds some is taken singly.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
CHUNK_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _cuts_at_spaces(spec: dict) -> bool:
    steps = ((spec.get("normalizer") or {}).get("normalizers")) or []
    named = [(s["type"], s.get("pattern", {}).get("Regex") if s["type"] == "Replace" else None) for s in steps]
    parts = ((spec.get("pre_tokenizer") or {}).get("pretokenizers")) or [{}]
    split = parts[0]
    return (
        named == CHUNK_NORMALIZER
        and steps[1].get("content") == " "
        and split.get("type") == "Split"
        and split.get("behavior") == "Removed"
        and bool(split.get("invert"))
        and split.get("pattern", {}).get("Regex") == CHUNK_WORDS
        and not any(c.isspace() for t in spec["added_tokens"] for c in t["content"])
    )


class TreeEncoder:
    """Encodes as the library does with ``add_special_tokens=False`` (special tokens that stand in
    the text are found), and decodes as its ``decode(ids, skip_special_tokens=False)``.

    ``raw`` is the tokenizer's JSON.  Models with dropout, a joining prefix, byte fallback, or a
    vocabulary without all bytes are refused, and so are added tokens that strip or that are found
    in normalised text, and decoders other than none (tokens joined by a space)."""

    def __init__(self, raw: bytes, leaf: int = LEAF):
        from tokenizers import Tokenizer, models

        spec = json.loads(raw)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain byte-pair models are encoded")
        if spec.get("decoder") is not None:
            raise ValueError("only tokenizers without a decoder are decoded")
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]:
                raise ValueError(f"added token {t['content']!r} strips or is found in normalised text")
        self.leaf = leaf
        library = Tokenizer.from_str(raw.decode("utf-8"))
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        for c in bytes_as_chars():
            if c not in vocab or c + self.suffix not in vocab:
                raise ValueError("the vocabulary lacks a byte")
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.inner = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        self.ending = Tokenizer(models.BPE(vocab=vocab, merges=merges, end_of_word_suffix=self.suffix)) if self.suffix else self.inner
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.names: list[str] = [""] * size
        for token, i in [*vocab.items(), *self.added.items()]:
            self.names[i] = token
        self.specials = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.cut = _cuts_at_spaces(spec)
        self.words: dict[str, list[int]] = {}
        self.chunks: dict[bytes, bytes] = {}

    # -- words ---------------------------------------------------------------------------------
    def _encode_parts(self, parts: list[str], ends: list[bool]) -> list[list[int]]:
        """Each part by plain merging; ``ends`` marks parts that end a word."""
        out: list[list[int]] = [[]] * len(parts)
        for tokenizer, flag in ((self.inner, False), (self.ending, True)):
            at = [i for i, e in enumerate(ends) if e == flag]
            if at:
                for i, e in zip(at, tokenizer.encode_batch_fast([parts[i] for i in at], add_special_tokens=False), strict=True):
                    out[i] = e.ids
        return out

    def _surface(self, ids: list[int], end: bool) -> str:
        text = "".join(map(self.names.__getitem__, ids))
        return text[: -len(self.suffix)] if end and self.suffix else text

    def _join(self, pairs: list[tuple[list[int], list[int], bool]]) -> list[list[int]]:
        """The encodings of left + right for many pairs at once; the flag says that right ends a word."""
        out: list[list[int]] = [[]] * len(pairs)
        open_ = list(range(len(pairs)))
        width = FIRST_WINDOW
        while open_:
            windows, ends = [], []
            for p in open_:
                left, right, end = pairs[p]
                whole = width >= len(right)
                windows.append(self._surface(left[-width:], False) + self._surface(right[:width], end and whole))
                ends.append(end and whole)
            again = []
            for p, got in zip(open_, self._encode_parts(windows, ends), strict=True):
                left, right, _ = pairs[p]
                i, j = max(0, len(left) - width), min(len(right), width)
                agrees_left = i == 0 or got[0] == left[i]
                agrees_right = j == len(right) or got[-1] == right[j - 1]
                if agrees_left and agrees_right:
                    out[p] = left[:i] + got + right[j:]
                else:
                    again.append(p)
            open_ = again
            width *= 2
        return out

    def encode_long(self, words: list[str]) -> list[list[int]]:
        """The ids of words (in the byte-level alphabet) of any length, by halves."""
        trees: list[list[list[int]]] = []
        parts, ends = [], []
        for w in words:
            n = 1
            while -(-len(w) // n) > self.leaf:
                n *= 2
            bounds = [len(w) * k // n for k in range(n + 1)]
            parts += [w[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            ends += [False] * (n - 1) + [True]
            trees.append([[]] * n)
        leaves = iter(self._encode_parts(parts, ends))
        trees = [[next(leaves) for _ in t] for t in trees]
        while any(len(t) > 1 for t in trees):
            pairs = [(t[k], t[k + 1], k + 2 == len(t)) for t in trees if len(t) > 1 for k in range(0, len(t), 2)]
            joined = iter(self._join(pairs))
            trees = [[next(joined) for _ in range(len(t) // 2)] if len(t) > 1 else t for t in trees]
        return [t[0] for t in trees]

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        """Distinct new words of a batch together; short ones are held."""
        new = list(dict.fromkeys(w for w in words if w not in self.words))
        short = [w for w in new if len(w) <= self.leaf]
        long = [w for w in new if len(w) > self.leaf]
        if len(self.words) + len(short) > HELD_CHUNKS:
            self.words.clear()
            new_short = list(dict.fromkeys(w for w in words if len(w) <= self.leaf))
        else:
            new_short = short
        self.words.update(zip(new_short, self._encode_parts(new_short, [True] * len(new_short)), strict=True))
        passing = dict(zip(long, self.encode_long(long), strict=True))
        held = self.words
        return [held[w] if w in held else passing[w] for w in words]

    # -- texts ---------------------------------------------------------------------------------
    def _pieces(self, text: str) -> list[tuple[str, int]]:
        """(stretch, -1) of plain text and ("", id) of added tokens, in order."""
        if self.specials is None:
            return [(text, -1)]
        found = self.specials.split(text)
        return [(s, -1) if k % 2 == 0 else ("", self.added[s]) for k, s in enumerate(found) if s]

    def _words_of(self, stretch: str) -> list[str]:
        plain = self.normalizer.normalize_str(stretch) if self.normalizer else stretch
        return [w for w, _ in self.pre_tokenizer.pre_tokenize_str(plain)] if self.pre_tokenizer else [plain]

    def _words_of_chunks(self, chunks: list[str]) -> list[list[str]] | None:
        """The words of chunks without ASCII white space, normalised and cut together; None where
        the text holds added tokens or other white space, so that chunks are to be taken singly."""
        joined = " ".join(chunks)
        if (self.specials is not None and self.specials.search(joined)) or OTHER_SPACE.search(joined):
            return None
        joined = self.normalizer.normalize_str(joined)
        ends = np.cumsum([len(c) + 1 for c in joined.split(" ")])
        found = self.pre_tokenizer.pre_tokenize_str(joined)
        bounds = np.searchsorted([a for _, (a, _) in found], np.concatenate([[0], ends])).tolist()
        words = [w for w, _ in found]
        return [words[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _ids_singly(self, text: str) -> list[int]:
        ids: list[int] = []
        for stretch, added in self._pieces(text):
            if added >= 0:
                ids.append(added)
            else:
                for word in self._encode_words(self._words_of(stretch)):
                    ids += word
        return ids

    def _packed_ids(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts; of chunks between white space with the words of all of them together."""
        words_of = self._words_of_chunks(texts) if self.cut and texts else None
        if words_of is None:
            if self.cut and len(texts) > 1:  # the few that hold something special are in one half or the other
                half = len(texts) // 2
                return self._packed_ids(texts[:half]) + self._packed_ids(texts[half:])
            return [np.array(self._ids_singly(t), "<u4").tobytes() for t in texts]
        coded = self._encode_words([w for words in words_of for w in words])
        flat = np.array([i for ids in coded for i in ids], "<u4").tobytes()
        ends = np.cumsum([0, *map(len, coded)]) * 4
        at = ends[np.cumsum([0, *map(len, words_of)])].tolist()
        return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.cut:
            return self._packed_ids(texts)
        chunks_of = [t.encode("utf-8").split() for t in texts]
        held = self.chunks
        new = list({c: None for chunks in chunks_of for c in chunks if c not in held})
        if len(held) + len(new) > HELD_CHUNKS:
            held.clear()
            new = list({c: None for chunks in chunks_of for c in chunks})
        table = dict(zip(new, self._packed_ids(b" ".join(new).decode("utf-8").split(" ") if new else []), strict=True))
        if any(len(c) > HELD_BYTES for c in new):
            held.update((c, i) for c, i in table.items() if len(c) <= HELD_BYTES)
            table = held | {c: i for c, i in table.items() if len(c) > HELD_BYTES}
        else:
            held.update(table)
            table = held
        return [b"".join(map(table.__getitem__, chunks)) for chunks in chunks_of]

    def decode(self, ids) -> str:
        """The library's text of ids without a decoder: the tokens, joined by a space."""
        return " ".join(map(self.names.__getitem__, ids))


def bytes_as_chars() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes are themselves, the others follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in plain else chr(0x100 + extra))
        extra += b not in plain
    return out


_ENCODERS: dict[int, TreeEncoder] = {}


def encoder(raw: bytes) -> TreeEncoder:
    """One encoder per Python worker and tokenizer, so that held words outlive a task."""
    key = hash(raw)
    if key not in _ENCODERS:
        _ENCODERS[key] = TreeEncoder(raw)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, tokenizer: bytes, decoded: bool = False, packed: bool = False) -> DataFrame:
    """``docs`` with input_ids and, if ``decoded``, decoded (the text that the ids decode to).

    input_ids is array<int>, or with ``packed`` binary (little-endian unsigned 32-bit integers).
    A null or empty text has no ids and decodes to the empty text; repeated rows are coded row by
    row; columns named input_ids or decoded are replaced, all others pass through; an empty table
    stays empty.  ``tokenizer`` is the JSON of the tokenizers library.
    """
    spark = docs.sparkSession
    docs = docs.drop("input_ids", "decoded")
    common.configure(spark)
    shared = spark.sparkContext.broadcast(tokenizer)  # a tokenizer file, a few megabytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for batch in batches:
            (texts,) = common.batches_of(batch, "text")
            raws = enc.encode_batch([x or "" for x in texts])
            columns = [batch.column(batch.schema.get_field_index("row"))]
            if packed:
                columns.append(pa.array(raws, pa.binary()))
            else:
                offsets = np.cumsum([0, *(len(r) // 4 for r in raws)])
                ids = np.frombuffer(b"".join(raws), "<u4").astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)))
            if decoded:
                columns.append(pa.array([enc.decode(np.frombuffer(r, "<u4").tolist()) for r in raws], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["row", "input_ids", "decoded"][: len(columns)])

    others = [c for c in docs.columns if c != "text"]
    packed_rows = docs.select(F.struct(*(others or [F.lit(None).cast("string").alias("_none")])).alias("row"), F.col("text").cast("string").alias("text"))
    kind = packed_rows.schema["row"].dataType.simpleString()
    out = packed_rows.mapInArrow(run, f"row {kind}, input_ids {'binary' if packed else 'array<int>'}" + ", decoded string" * decoded)
    return out.select(*[F.col("row").getField(c).alias(c) for c in others], "input_ids", *["decoded"] * decoded)
