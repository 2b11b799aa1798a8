"""Language of words and documents by a linear-chain conditional random field.

Each word has one label.  Its features are the character n-grams of the word between two boundary
marks (those that touch a mark are its affixes) and its membership in a lexicon of frequent training
words; weights and label-to-label transitions are learned together by gradient steps on the
conditional likelihood, with the expectations from forward-backward.  Training sequences splice
runs of words of different documents, so that the transitions are those of code-switched text.

A document's score for a language is the mean, over its words with a letter, of the words'
posterior; the prediction is the best one.

Fit: all labelled rows, whole texts.  One pass counts the words of the lexicon and collects the letters
of the texts.  The rows are then dealt by a hash into groups of about ``GROUP_BYTES`` of text, a model is
fitted to each group in a task, and the weights are averaged, each by how often its group met the
feature.  Where thresholds are asked for, a pass judges all labelled rows, each by the mean of the
half of the groups that it is not in, and counts how many reach each certainty and score.  The
driver gets sums of the model's size.
Prediction: every row, whole texts, in one narrow pass.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm import common

MAX_LANGS = 128
#: Bytes of text in a group of rows; a group of equal rows is cut at twice that.
GROUP_BYTES = 8 << 20
#: Bytes of Arrow batches that are judged at once: documents of one language repeat their words, and a
#: step over many sequences costs little more than one over a few.
HELD_BYTES = 16 << 20
NOISE_TEXTS, NOISE_WORDS = 200, 50
STEPS = 1 << 14  # of certainties and scores, in the counts that give the thresholds
BUCKETS = 1 << 16  # what 16 bits hold
LEXICON_SLOTS = 1 << 17
POINTS = 0x110000  # code points
#: Numbers in a block of a sum over tasks.
BLOCK = 1 << 15
PARTS = "block int, task long, part binary"
ORDERS = (1, 2, 3, 4)
LEXICON_COUNT = 4
UNKNOWN = "und"

ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(raw: bytes) -> bool:
    """Whether the text holds a letter of any script."""
    if ASCII_LETTER.search(raw):
        return True
    return not raw.isascii() and any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def lettered_words(words: list[bytes]) -> np.ndarray:
    """``has_letter`` of each word (none is empty)."""
    buf = np.frombuffer(b"".join(words), np.uint8)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lens) - lens
    out = np.logical_or.reduceat((buf | 0x20) - np.uint8(ord("a")) < 26, starts)
    for i in np.flatnonzero(~out & (np.maximum.reduceat(buf, starts) > 0x7F)):
        out[i] = has_letter(words[i])
    return out


class Numbers(dict):
    """key -> number in the order of the first use."""

    def __missing__(self, key) -> int:
        value = self[key] = len(self)
        return value


def lexicon_slots(words: list[bytes]) -> np.ndarray:
    """The words' numbers in the hashed lexicon."""
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) & np.uint32(LEXICON_SLOTS - 1)


class WordFeatures:
    """Hashed n-gram features of a list of words, ragged: ``at`` are bucket numbers, ``owner`` the
    word of each."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        buf = np.frombuffer(b"\n" + b"\n".join(words) + b"\n", np.uint8).astype(np.uint32)
        lens = np.fromiter(map(len, words), np.int64, self.n)
        self.starts = np.concatenate([[0], np.cumsum(lens + 1)])[:-1]  # the mark before each word
        self.lens = lens
        self.orders = []
        for order in ORDERS:
            if len(buf) < order:
                continue
            h = np.full(len(buf) - order + 1, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for j in range(order):
                h = (h ^ buf[j : j + len(h)]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
            # grams that start at the mark before a word and end at the mark after it at the latest
            count = np.maximum(lens + 2 - order + 1, 0) if order > 1 else lens
            first = self.starts + (order == 1)
            self.orders.append(((h & np.uint32(BUCKETS - 1)).astype(np.uint16), first, count))

    def by_word(self) -> tuple[np.ndarray, np.ndarray]:
        """(bucket of every gram, word after word; where each word's grams start, and their end)."""
        starts = np.concatenate([[0], np.cumsum(sum((count for _, _, count in self.orders), np.zeros(self.n, np.int64)))])
        out = np.empty(int(starts[-1]), np.uint16)
        filled = starts[:-1].copy()
        for h, first, count in self.orders:
            within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            out[np.repeat(filled, count) + within] = h[np.repeat(first, count) + within]
            filled += count
        return out, starts


@dataclass
class Model:
    langs: list[str]
    grams: np.ndarray  # BUCKETS x langs
    lexicon: np.ndarray  # sorted slots of the lexicon's words
    lexical: np.ndarray  # words of the lexicon x langs
    moves: np.ndarray  # langs x langs, log weights
    begin: np.ndarray
    floor: float = 0.0  # certainty below which a text has no language
    clear: float = math.inf  # score from which the prediction outweighs a given label

    def emissions(self, words: list[bytes], features: WordFeatures | None = None) -> np.ndarray:
        """log weight of each label for each word; words without a letter say nothing."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        if not words:
            return out
        f = features or WordFeatures(words)
        scale = 1 / np.sqrt(np.maximum(f.lens, 1)).astype(np.float32)
        for h, first, count in f.orders:
            # sums over runs of a prefix-sum would lose precision; reduceat keeps each word's own sum
            ok = count > 0
            if ok.any():
                bounds = np.stack([first[ok], np.minimum(first[ok] + count[ok], len(h))], 1).ravel()
                # one row more, in no word's sum: the last bound may be the end
                rows = self.grams.take(np.append(h, h[:1]), axis=0)
                out[ok] += np.add.reduceat(rows, bounds, axis=0)[::2]
        out *= scale[:, None]
        at, found = self.lookup(words)
        out[found] += self.lexical[at[found]]
        return out

    def lookup(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        keys = lexicon_slots(words)
        if not len(self.lexicon):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.lexicon, keys), len(self.lexicon) - 1)
        return at, self.lexicon[at] == keys


def weights_of(emit: np.ndarray) -> np.ndarray:
    """The weights of the log weights of each row's labels, the largest as 1."""
    return np.exp(emit - emit.max(axis=-1, keepdims=True))


def chains(e: np.ndarray, lens: np.ndarray, moves: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int], np.ndarray]:
    """(forward and backward weights, each column with sum 1; sequences longer than each time; weights
    of the moves).  ``e``: time x label x sequence weights, so that a step works on long rows."""
    steps = len(e)
    alive = np.searchsorted(-lens, -np.arange(steps), side="left").tolist()
    a = np.exp(moves - moves.max()).astype(e.dtype)
    alpha, beta = np.zeros_like(e), np.ones_like(e)
    cur = np.exp(begin - begin.max()).astype(e.dtype)[:, None] * e[0]
    alpha[0] = cur / cur.sum(axis=0)
    for t in range(1, steps):
        n = alive[t]
        cur = a.T @ alpha[t - 1, :, :n]
        cur *= e[t, :, :n]
        np.divide(cur, np.add.reduce(cur, 0), out=alpha[t, :, :n])
    for t in range(steps - 2, -1, -1):
        n = alive[t + 1]
        cur = a @ (beta[t + 1, :, :n] * e[t + 1, :, :n])
        np.divide(cur, np.add.reduce(cur, 0), out=beta[t, :, :n])
    return alpha, beta, alive, a


def forward_backward(emit: np.ndarray, lens: np.ndarray, moves: np.ndarray, begin: np.ndarray, count_moves: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (time x sequence x label) and expected transition counts (if asked for).

    ``emit``: time x sequence x label log weights, sequences sorted by falling length ``lens``; only
    the first ``alive(t)`` sequences have a word at time t.
    """
    steps, _, labels = emit.shape
    e = weights_of(emit).transpose(0, 2, 1).copy()
    alpha, beta, alive, a = chains(e, lens, moves, begin)
    post = alpha * beta
    post /= np.maximum(post.sum(axis=1, keepdims=True), 1e-30)
    expected = np.zeros((labels, labels))
    if steps > 1 and count_moves:
        left = alpha[:-1].transpose(0, 2, 1).reshape(-1, labels)
        right = (beta[1:] * e[1:]).transpose(0, 2, 1).reshape(-1, labels)
        z = np.einsum("ni,ij,nj->n", left, a, right)
        weight = np.where(z > 0, 1 / np.maximum(z, 1e-30), 0)
        real = np.concatenate([np.arange(emit.shape[1]) < n for n in alive[1:]])
        expected = (left.T @ (right * (weight * real)[:, None])) * a
    return post.transpose(0, 2, 1), expected


def fit(texts: list[bytes], labels: list[str], rounds: int = 2, seed: int = 5, length: int = 160, batch: int = 64) -> Model:
    """A model of the given documents; labels in ascending order are its languages."""
    return fit_group(texts, labels, rounds=rounds, seed=seed, length=length, batch=batch)[0]


def fit_group(
    texts: list[bytes], labels: list[str], langs: list[str] | None = None, lexicon: np.ndarray | None = None, rounds: int = 2, seed: int = 5, length: int = 160, batch: int = 64
) -> tuple[Model, np.ndarray, np.ndarray, int]:
    """(model, how often each gram was met, and each slot of the lexicon; number of words).  Without
    ``langs`` and ``lexicon`` they are those of the given documents."""
    langs = sorted(set(labels)) if langs is None else langs
    number = {lang: i for i, lang in enumerate(langs)}
    k = len(langs)
    rng = np.random.default_rng(seed)
    index = Numbers()
    runs = []
    for raw, lang in zip(texts, labels, strict=True):
        words = common.lower_words(raw)
        ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        at = 0
        while at < len(ids):
            n = int(rng.integers(6, 60))
            runs.append((ids[at : at + n], number[lang]))
            at += n
    vocabulary = list(index)
    seen = np.bincount(np.concatenate([np.zeros(0, np.int64), *(r for r, _ in runs)]), minlength=len(vocabulary))
    if lexicon is None:
        slots, slot = np.unique(lexicon_slots(vocabulary), return_inverse=True)
        lexicon = slots[np.bincount(slot, seen, minlength=len(slots)) >= LEXICON_COUNT]
    model = Model(langs, np.zeros((BUCKETS, k), np.float32), lexicon, np.zeros((len(lexicon), k), np.float32), np.zeros((k, k)), np.zeros(k))
    if not runs:
        return model, np.zeros(BUCKETS), np.zeros(len(lexicon)), 0
    features = WordFeatures(vocabulary)
    scale = 1 / np.sqrt(np.maximum(features.lens, 1))
    bucket, first = features.by_word()
    lex_at, lex_in = model.lookup(vocabulary)
    met = np.bincount(bucket, np.repeat(seen, np.diff(first)), minlength=BUCKETS)
    lex_met = np.bincount(lex_at[lex_in], seen[lex_in], minlength=len(lexicon))
    if k < 2:
        return model, met, lex_met, int(seen.sum())
    model.moves += np.eye(k) * 2
    sums = {"grams": np.full_like(model.grams, 1e-2), "lexical": np.full_like(model.lexical, 1e-2), "moves": np.full_like(model.moves, 1e-2)}

    def step(name: str, rate: float, rows: np.ndarray, g: np.ndarray) -> None:
        value = getattr(model, name)
        g = g + 1e-5 * value[rows]
        sums[name][rows] += g * g
        value[rows] -= (rate * g / np.sqrt(sums[name][rows])).astype(value.dtype)

    for _ in range(rounds):
        rng.shuffle(runs)
        words_in = np.concatenate([r for r, _ in runs])
        gold_in = np.repeat([c for _, c in runs], [len(r) for r, _ in runs])
        total = len(words_in) // length
        if total == 0:
            length, total = len(words_in), 1
        grid, gold = words_in[: total * length].reshape(total, length), gold_in[: total * length].reshape(total, length)
        for at in range(0, total, batch):
            ids, want = grid[at : at + batch], gold[at : at + batch]
            here = np.bincount(ids.ravel(), minlength=len(vocabulary))
            used = np.flatnonzero(here)
            here[used] = np.arange(len(used))
            place = here[ids]
            counts = first[used + 1] - first[used]
            starts = np.cumsum(counts) - counts
            b = bucket[np.repeat(first[used] - starts, counts) + np.arange(int(counts.sum()))].astype(np.int64)
            emit = np.add.reduceat(model.grams.take(b, axis=0), starts, axis=0) * scale[used][:, None]
            known, lex = lex_in[used], lex_at[used][lex_in[used]]
            emit[known] += model.lexical[lex]
            post, expected = forward_backward(emit[place].transpose(1, 0, 2), np.full(len(ids), length), model.moves, model.begin)
            truth = np.eye(k)[want.T]
            delta = (post - truth).reshape(-1, k)
            flat = place.T.ravel()
            grad = np.stack([np.bincount(flat, delta[:, c], minlength=len(used)) for c in range(k)], 1) / len(ids)
            scaled = grad * scale[used][:, None]
            touched = np.flatnonzero(np.bincount(b, minlength=BUCKETS))
            step("grams", 0.3, touched, np.stack([np.bincount(b, np.repeat(scaled[:, c], counts), minlength=BUCKETS)[touched] for c in range(k)], 1))
            slots, slot = np.unique(lex, return_inverse=True)
            step("lexical", 0.3, slots, np.stack([np.bincount(slot, grad[known, c], minlength=len(slots)) for c in range(k)], 1))
            pairs_want = np.bincount((want[:, :-1] * k + want[:, 1:]).ravel(), minlength=k * k).reshape(k, k)
            step("moves", 0.1, np.arange(k), (expected - pairs_want) / len(ids))
    return model, met, lex_met, int(seen.sum())


def predict(model: Model, raws: list[bytes]) -> tuple[list[str], list[float]]:
    """(language, mean posterior) of each text."""
    langs, scores, _ = judge(model, raws)
    return langs, scores


def judge(model: Model, raws: list[bytes]) -> tuple[list[str], list[float], list[float]]:
    """(language, mean posterior, certainty) of each text; the certainty is the mean over the words
    of their own best label's posterior, so a text that mixes languages is certain, noise is not."""
    langs, scores, sure = [UNKNOWN] * len(raws), [0.0] * len(raws), [0.0] * len(raws)
    index = Numbers()
    docs = []
    for i, raw in enumerate(raws):
        if has_letter(raw):
            words = common.lower_words(raw)
            docs.append((i, np.fromiter(map(index.__getitem__, words), np.int64, len(words))))
    if not docs or not model.langs:
        return langs, scores, sure
    words = list(index)
    lettered = lettered_words(words)
    emit = model.emissions(words)
    emit[~lettered] = 0
    # the row after the last word's is the padding's
    e = np.concatenate([weights_of(emit), np.ones((1, len(model.langs)), np.float32)])
    heard = np.append(lettered, False)
    docs.sort(key=lambda d: -len(d[1]))
    at = 0
    while at < len(docs):
        # a block of documents of similar length, its padded grid bounded
        top = len(docs[at][1])
        end = at + 1
        while end < len(docs) and 2 * len(docs[end][1]) >= top and (end + 1 - at) * top <= 1 << 19:
            end += 1
        block = docs[at:end]
        lens = np.array([len(ids) for _, ids in block])
        grid = np.full((len(block), top), len(words))
        for c, (_, ids) in enumerate(block):
            grid[c, : len(ids)] = ids
        here = e.take(grid.T, axis=0).transpose(0, 2, 1).copy()
        post, beta, _, _ = chains(here, lens, model.moves, model.begin)
        post *= beta
        post /= np.maximum(post.sum(axis=1, keepdims=True), 1e-30)
        said = heard[grid.T]
        post *= said[:, None, :]
        total = np.maximum(said.sum(axis=0), 1)
        mean = (post.sum(axis=0) / total).T
        own = post.max(axis=1).sum(axis=0) / total
        for c, (i, _) in enumerate(block):
            best = int(mean[c].argmax())
            langs[i], scores[i], sure[i] = model.langs[best], float(min(1.0, mean[c, best])), float(min(1.0, own[c]))
        at = end
    return langs, scores, sure


def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``HELD_BYTES`` at least, but for the last."""
    kept, size = [], 0
    for batch in batches:
        kept.append(batch)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
            kept, size = [], 0
    if kept:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()


def joined(runs: list[bytes]) -> bytes:
    """One text of the runs, without the words that the cuts between them broke; a run that is part
    of one word stays, less the bytes of broken characters."""
    out = []
    for i, run in enumerate(runs):
        words = run.split()
        first, last = i > 0 and not run[:1].isspace(), i + 1 < len(runs) and not run[-1:].isspace()
        whole = words[first : len(words) - last]
        out += whole or [w.decode("utf-8", "ignore").encode() for w in words]
    return b" ".join(out) if len(runs) > 1 else runs[0]


def partial_sums(task: int, vector: np.ndarray, first: int = 0) -> Iterator[pa.RecordBatch]:
    """A task's part of a sum, in blocks numbered from ``first``; blocks of zeros are left out."""
    for i, at in enumerate(range(0, len(vector), BLOCK)):
        part = vector[at : at + BLOCK]
        if part.any():
            yield pa.RecordBatch.from_pydict({"block": pa.array([first + i], pa.int32()), "task": pa.array([task], pa.int64()), "part": pa.array([part.tobytes()], pa.binary())})


def summed(parts: DataFrame, size: int, vectors: int = 1, kind: type = np.float64) -> np.ndarray:
    """The sums of the ``partial_sums`` of all tasks, added up block by block in tasks and returned
    as ``kind``: ``vectors`` rows of ``size`` numbers."""

    def finished(block: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "part": pa.array([total.astype(kind).tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for batch in batches:
            for block, part in zip(*common.batches_of(batch, "block", "part"), strict=True):
                if block != last:
                    if last is not None:
                        yield finished(last, total)
                    last, total = block, np.zeros(len(part) // 8)
                total += np.frombuffer(part)
        if last is not None:
            yield finished(last, total)

    each = -(-size // BLOCK)
    out = np.zeros((vectors, each * BLOCK), kind)
    for row in parts.repartition("block").sortWithinPartitions("block", "task").mapInArrow(common.lean(run), "block int, part binary").collect():
        part = np.frombuffer(row["part"], kind)
        out[row["block"] // each, row["block"] % each * BLOCK :][: len(part)] = part
    return out[:, :size]


def count_words(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(words in each slot of the lexicon, words that hold each code point, counted once for every
    batch of texts) of all ``rows`` (raw); letters as ``str.lower`` makes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, points = np.zeros(LEXICON_SLOTS), np.zeros(POINTS)
        for batch in batches:
            seen: Counter = Counter()
            for raw in common.batches_of(batch, "raw")[0]:
                seen.update(common.lower_words(raw))
            slots += np.bincount(lexicon_slots(list(seen)), np.fromiter(seen.values(), np.int64, len(seen)), minlength=LEXICON_SLOTS)
            letters = set(b" ".join(seen).decode("utf-8", "ignore").lower())
            points[[ord(c) for c in letters]] += 1
        yield from partial_sums(0, np.concatenate([slots, points]))

    both = summed(rows.select("raw").mapInArrow(common.lean(run), PARTS), LEXICON_SLOTS + POINTS)[0]
    return both[:LEXICON_SLOTS], both[LEXICON_SLOTS:]


def group_of(groups: int):
    """The group of a row (doc_id, lang, raw)."""
    return F.pmod(F.xxhash64("doc_id", "raw", "lang"), F.lit(groups))


def train(rows: DataFrame, langs: list[str], lexicon: np.ndarray, groups: int, folds: int = 1) -> list[Model]:
    """The mean of the models of ``groups`` groups of ``rows`` (doc_id, lang, raw), each weight by
    how often its group met the feature; with two ``folds`` after it the means of the lower and of
    the upper half of the groups."""
    k, n = len(langs), BUCKETS + len(lexicon)
    size = (n + k) * (k + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n + k, k + 1))
        last, raws, labels, held = None, [], [], 0

        def learn() -> None:
            # a small group has few steps: more rounds, in smaller batches
            small = held < GROUP_BYTES // 2
            model, met, lex_met, words = fit_group(raws, labels, langs, lexicon, rounds=2 if small else 1, batch=64 if small else 256)
            for at, weights, count in ((0, model.grams, met), (BUCKETS, model.lexical, lex_met), (n, model.moves, np.full(k, words))):
                total[at : at + len(weights), :k] += weights * count[:, None]
                total[at : at + len(weights), k] += count

        def part() -> Iterator[pa.RecordBatch]:
            return partial_sums(last, total.ravel(), last * folds // groups * -(-size // BLOCK))

        for batch in batches:
            for group, raw, lang in zip(*common.batches_of(batch, "group", "raw", "lang"), strict=True):
                if raws and (group != last or held >= 2 * GROUP_BYTES):
                    learn()
                    raws, labels, held = [], [], 0
                    if group * folds // groups != last * folds // groups:
                        yield from part()
                        total[:] = 0
                last = group
                raws.append(raw)
                labels.append(lang)
                held += len(raw)
        if raws:
            learn()
            yield from part()

    dealt = rows.select("raw", "lang", F.xxhash64("doc_id", "raw", "lang").alias("key"), group_of(groups).alias("group"))
    dealt = dealt.repartition("group").sortWithinPartitions("group", "key").select("group", "raw", "lang")
    sums = summed(dealt.mapInArrow(common.lean(run), PARTS), size, folds, np.float32).reshape(folds, n + k, k + 1)

    def mean(total: np.ndarray) -> Model:
        weights = total[:, :k] / np.maximum(total[:, k:], 1)
        return Model(langs, weights[:BUCKETS], lexicon, weights[BUCKETS:n], weights[n:].astype(np.float64), np.zeros(k))

    return [mean(sums.sum(axis=0)), *(map(mean, sums) if folds > 1 else [])]


def calibrate(model: Model, folds: list[Model], rows: DataFrame, letters: list[str], seed: int = 7) -> None:
    """Set ``floor`` and ``clear`` from all labelled ``rows`` (lang, raw, fold), each judged by the
    model of the fold that it is not in, and from noise of ``letters``.

    ``floor`` is a quarter of the way from the certainty that 95 % of the noise texts (random letters
    of the texts' alphabet, in words of 2 to 9) stay below to that which 99 % of the texts reach, and
    never above the latter.  ``clear`` is the score
    that 95 % of the texts reach, but at least 0.8; no score is clear if the predictions for any
    given language's texts agree with less than 90 % of their labels.  Certainties and scores are
    counted in steps of 1 / ``STEPS``, and every language has the same weight in these shares."""
    k = len(model.langs)
    if k < 2 or not letters:
        return
    shared = rows.sparkSession.sparkContext.broadcast(folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds = shared.value
        number = {lang: i for i, lang in enumerate(folds[0].langs)}
        counts = np.zeros((2 * STEPS + 1, k))  # by certainty, by score, and of those that agree
        for batch in held(batches):
            found = [row for row in zip(*common.batches_of(batch, "raw", "lang", "fold"), strict=True) if has_letter(row[0])]
            for fold, other in ((0, folds[1]), (1, folds[0])):
                given = [lang for _, lang, at in found if at == fold]
                langs, scores, sure = judge(other, [raw for raw, _, at in found if at == fold])
                at = np.array([number[lang] for lang in given], np.int64)
                for first, values in ((0, sure), (STEPS, scores)):
                    np.add.at(counts, (first + np.minimum((np.array(values) * STEPS).astype(np.int64), STEPS - 1), at), 1)
                np.add.at(counts[-1], at, [lang == pred for lang, pred in zip(given, langs, strict=True)])
        yield from partial_sums(0, counts.ravel())

    counts = summed(rows.select("raw", "lang", "fold").mapInArrow(common.lean(run), PARTS), (2 * STEPS + 1) * k)[0].reshape(-1, k)
    certain, scored, agreed = counts[:STEPS], counts[STEPS:-1], counts[-1]
    given = certain.sum(axis=0)
    if not given.any():
        return

    def reached_by_all_but(share: float, steps: np.ndarray) -> float:
        reached = np.cumsum((steps / np.maximum(given, 1)).sum(axis=1))
        return int(np.searchsorted(reached, share * reached[-1], side="right")) / STEPS

    rng = np.random.default_rng(seed)
    noise = [" ".join("".join(rng.choice(letters, int(rng.integers(2, 10)))) for _ in range(NOISE_WORDS)).encode() for _ in range(NOISE_TEXTS)]
    _, _, below = judge(model, noise)
    reached = reached_by_all_but(0.01, certain)
    model.floor = float(min(reached, 0.75 * np.quantile(below, 0.95) + 0.25 * reached))
    if (agreed >= 0.9 * given).all():
        model.clear = float(max(0.8, reached_by_all_but(0.05, scored)))


def fit_on(labelled: DataFrame, calibrated: bool = False) -> Model:
    """A model of all rows of ``labelled`` (doc_id, text, lang); rows with a null text or lang
    teach nothing.  No such row: a model without languages.  ``calibrated``: with ``floor`` and
    ``clear`` from the same rows."""
    common.configure(labelled.sparkSession)
    rows = labelled.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"), common.text_bytes().alias("raw"), F.col("text").isNotNull().alias("has"))
    rows = rows.where(F.col("has") & F.col("lang").isNotNull()).drop("has")
    counts = rows.groupBy("lang").agg(F.sum(F.octet_length("raw")).alias("size")).limit(MAX_LANGS + 1).collect()
    if not counts:
        return fit([], [])
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: raise MAX_LANGS or label the rows more coarsely")
    slots, points = count_words(rows)
    lexicon = np.flatnonzero(slots >= LEXICON_COUNT).astype(np.uint32)
    langs, groups = sorted(r["lang"] for r in counts), round(sum(r["size"] for r in counts) / GROUP_BYTES)
    if not calibrated:
        return train(rows, langs, lexicon, max(1, groups))[0]
    groups = max(2, groups)
    model, *folds = train(rows, langs, lexicon, groups, folds=2)
    parted = rows.withColumn("fold", F.floor(group_of(groups) * 2 / groups).cast("int"))
    calibrate(model, folds, parted, [chr(c) for c in np.flatnonzero(points) if chr(c).isalpha()])
    return model


def label_documents(docs: DataFrame, model: Model, known: bool = False) -> DataFrame:
    """``docs`` with lang_pred and lang_score (columns of these names are replaced).  Null texts and
    texts without a letter: ``und``, 0.  Only ``text`` is read; every other column passes through,
    row by row, repeated rows too.  ``known``: also lang_known, whether the text has a letter and
    the model, if it has languages, is at least ``floor`` certain of its words."""
    spark = docs.sparkSession
    names = ["lang_pred", "lang_score", *["lang_known"] * known]
    docs = docs.drop(*names)
    common.configure(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in held(batches):
            (raws,) = common.batches_of(batch, "raw")
            langs, scores, sure = judge(model, raws)
            columns = [batch.column(batch.schema.get_field_index("row")), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            if known:
                columns.append(pa.array([has_letter(raw) and (not model.langs or c >= model.floor) for raw, c in zip(raws, sure, strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=["row", *names])

    packed = docs.select(F.struct(*docs.columns).alias("row"), common.text_bytes().alias("raw"))
    kind = packed.schema["row"].dataType.simpleString()
    return packed.mapInArrow(common.lean(run), f"row {kind}, lang_pred string, lang_score double" + ", lang_known boolean" * known).select("row.*", *names)
