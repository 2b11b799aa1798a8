"""Log-likelihood of whole documents under a gated recurrent language model trained here.

Tokens are the lower-cased words of a text and one end.  The model's own vocabulary is the ``VOCAB``
most frequent training tokens; every other word is one ``tail`` symbol times the word's smoothed
share of the tail, so the probabilities of all words add up to one.

* Network: a gated recurrent unit over input rows (the embedding already multiplied by the input
  matrix), and a class-factored softmax: the symbol's class given the state, then the symbol given
  class and state.  The biases start at the unigram distribution.
* Training: truncated backpropagation in numpy, Adagrad.  Each task runs through all of its training
  documents, joined to parallel streams whose state is carried from window to window and cleared
  after each end; the tasks' parameters are averaged in Spark, weighted by tokens, and are the start
  of the next round.  The rounds split the training documents, so every training token is seen once.
* Scoring: every document as one sequence from the cleared state, the state carried over its windows
  to its last token.

After the counts each text is split and looked up once: a written table holds its symbols, the sums that
need no network, and its words beyond the table; training and scoring read the symbols.

What is gathered from the corpus: the exact counts of all training tokens (a written table, never on
the driver), from which the at most ``TABLE`` most frequent words go to the tasks; the words beyond these
(each a small share of all tokens, so no join key is hot) take their counts by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm import common

VOCAB, CLASSES, HIDDEN = 2048, 32, 16
TABLE = 100_000
ROUNDS, STREAMS, WINDOW, RATE = 2, 512, 16, 0.08
#: Words counted in a task before its counts are passed on; tokens joined to streams at a time.
HELD_WORDS, HELD_TOKENS = 400_000, 400_000
#: Bytes of text that are split into words together.
HELD_TEXT = 2 << 20
#: Tokens of documents that are scored side by side (a longer document is scored whole as well).
SIDE_BY_SIDE = 6_000_000
#: The end of a document among the words (no word can hold a line feed).
END_WORD = b"\n"
END, TAIL = 0, 1
CHUNK = 1 << 14
#: Rows of scores (of several output layers) and documents of similar length that are worked on at a
#: time, few enough for a processor's cache.
TOGETHER, ABREAST = 2048, 1024


# --- the network ----------------------------------------------------------------------------------


class Network:
    """Parameters by name, all float32.  Class 0 holds the tail symbol alone; the others follow by
    falling frequency, ``width`` to a class.  The last row of an output matrix is its bias."""

    def __init__(self, symbols: int, classes: int, hidden: int):
        self.width = max(1, -(-(symbols - 1) // max(1, classes - 1)))
        self.classes, self.hidden, self.symbols = classes, hidden, symbols
        number = np.arange(symbols) - (np.arange(symbols) > TAIL)  # without the tail
        self.class_of = np.where(np.arange(symbols) == TAIL, 0, 1 + number // self.width)
        self.member_of = np.where(np.arange(symbols) == TAIL, 0, number % self.width)
        self.shapes: dict[str, tuple[int, ...]] = {
            "inputs": (symbols, 3 * hidden),
            "gates": (hidden, 2 * hidden),
            "fresh": (hidden, hidden),
            "to_class": (hidden + 1, classes),
            "to_member": (classes, hidden + 1, self.width),
        }

    def start(self, counts: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
        """Small random weights; biases at the log of the symbols' counts."""
        rng = np.random.default_rng(seed)
        p = {k: (rng.normal(size=s) * 0.1).astype(np.float32) for k, s in self.shapes.items()}
        grid = np.zeros((self.classes, self.width))
        grid[self.class_of, self.member_of] = counts + 0.1
        mass = np.maximum(grid.sum(1), 1e-9)
        p["to_class"][-1] = np.log(mass / mass.sum())
        p["to_member"][(grid == 0)[:, None, :].repeat(self.hidden + 1, 1)] = 0
        p["to_member"][:, -1] = np.where(grid > 0, np.log(np.maximum(grid, 1e-9) / mass[:, None]), -1e9)
        return p

    def pack(self, p: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([p[k].ravel() for k in self.shapes]).astype(np.float32)

    def unpack(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k, s in self.shapes.items():
            n = math.prod(s)
            out[k] = flat[at : at + n].reshape(s).astype(np.float32)
            at += n
        return out


def split_gates(p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``advance`` needs, each gate by itself: input rows (gate, symbol, unit), the matrices of the
    update and the reset gate, that of the fresh state."""
    hidden = p["fresh"].shape[0]
    inputs = np.ascontiguousarray(p["inputs"].reshape(-1, 3, hidden).transpose(1, 0, 2))
    return inputs, np.ascontiguousarray(p["gates"].reshape(hidden, 2, hidden).transpose(1, 0, 2)), p["fresh"]


def advance(split: tuple, h: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One step of all streams from states that are cleared already: (new state, update, reset, reset
    state, fresh state)."""
    inputs, gates, fresh = split
    g = inputs.take(x, axis=1)
    zr, c = g[:2], g[2]
    zr += np.matmul(h, gates)
    # the logistic function of both
    zr *= 0.5
    np.tanh(zr, out=zr)
    zr *= 0.5
    zr += 0.5
    s = zr[1] * h
    c += s @ fresh
    np.tanh(c, out=c)
    new = c - h
    new *= zr[0]
    new += h
    return new, zr[0], zr[1], s, c


def step(p: dict, h: np.ndarray, x: np.ndarray) -> tuple:
    """One step of all streams: (new state, what the backward pass needs)."""
    h = np.where((x == END)[:, None], np.float32(0), h)  # an end clears the state
    new, *kept = advance(split_gates(p), h, x)
    return new, (h, *kept)


def bounded(w: np.ndarray) -> np.ndarray:
    """The weights of softmax layers with scores of at most 0: states lie in (-1, 1), which bounds the
    scores, so one shift of a layer's bias keeps the exponentials of all rows finite."""
    out = w.copy()
    out[..., -1, :] -= (np.abs(w[..., :-1, :]).sum(-2) + w[..., -1, :]).max(-1)[..., None]
    return out


def softmax_rows(a: np.ndarray, y: np.ndarray, want_rest: bool) -> tuple[np.ndarray, np.ndarray]:
    """(log probability of ``y``, sum of the exponentials) of rows of scores; ``a`` becomes the gradient
    of its negative if that is wanted.  A row whose exponentials are all too small for a float has the
    sum 0 and no result."""
    flat = a.reshape(-1)
    at = np.arange(0, len(flat), a.shape[1])
    at += y
    picked = flat.take(at)
    np.exp(a, out=a)
    total = a.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        logs = picked - np.log(total)
        if want_rest:
            a /= total[:, None]
            flat[at] -= 1
    return logs, total


def spread_rows(h1: np.ndarray, w: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log probability of ``y``, gradient of its negative) in double, each row by its own maximum."""
    a = h1.astype(np.float64) @ w.astype(np.float64)
    a -= a.max(axis=1, keepdims=True)
    return softmax_rows(a, y, True)[0], a


def layers(h1: np.ndarray, w: np.ndarray, ends: np.ndarray, y: np.ndarray, grads: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """(log probability of ``y``, gradient with respect to the states) of rows that stand by softmax
    layer, ``ends`` apart; states end with a one.  Layers of few rows go through the softmax together."""
    logs = np.empty(len(h1), h1.dtype)
    dh = None if grads is None else np.empty((len(h1), h1.shape[1] - 1), h1.dtype)
    low, bounds, k = bounded(w), ends.tolist(), 0
    while k < len(w):
        first, a = k, bounds[k]
        k += 1
        while k < len(w) and bounds[k + 1] - a <= TOGETHER:
            k += 1
        b = bounds[k]
        if a == b:
            continue
        scores = np.empty((b - a, w.shape[2]), h1.dtype)
        some = [(c, bounds[c], bounds[c + 1]) for c in range(first, k) if bounds[c] < bounds[c + 1]]
        for c, i, j in some:
            np.matmul(h1[i:j], low[c], out=scores[i - a : j - a])
        logs[a:b], total = softmax_rows(scores, y[a:b], grads is not None)
        if not total.all():  # scores spread beyond the range of a float
            for c, i, j in some:
                if not total[i - a : j - a].all():
                    logs[i:j], scores[i - a : j - a] = spread_rows(h1[i:j], w[c], y[i:j])
        if grads is not None:
            for c, i, j in some:
                d = scores[i - a : j - a]
                grads[c] += h1[i:j].T @ d
                np.matmul(d, w[c, :-1].T, out=dh[i:j])
    return logs, dh


def output(p: dict, net: Network, h: np.ndarray, y: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural-log probability of symbols ``y`` given states ``h`` (rows); with ``grads``, also the
    gradient of the summed negative log probability (parameters added to ``grads``, states returned)."""
    cls = net.class_of.take(y)
    h1 = np.ones((len(h), net.hidden + 1), h.dtype)
    h1[:, :-1] = h
    both = grads is not None
    out, dh = layers(h1, p["to_class"][None], np.array([0, len(h1)]), cls, grads["to_class"][None] if both else None)
    out = out.astype(np.float64)
    ends = np.concatenate([[0], np.cumsum(np.bincount(cls, minlength=net.classes))])
    # the tail is alone in its class; numpy sorts small numbers by radix
    by = np.argsort(cls.astype(np.min_scalar_type(net.classes)), kind="stable")[ends[1] :]
    logs, dhs = layers(h1.take(by, axis=0), p["to_member"][1:], ends[1:] - ends[1], net.member_of.take(y.take(by)), grads["to_member"][1:] if both else None)
    out[by] += logs
    if both:
        dh[by] += dhs
    return out, dh


def window_gradient(p: dict, net: Network, h: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> tuple[float, np.ndarray, dict, np.ndarray, np.ndarray]:
    """Backpropagation through one window (time x stream) from state ``h``.

    Returns (loss, last state, gradients, touched input rows, their gradients)."""
    hidden = net.hidden
    split, shape = split_gates(p), (*xs.shape, hidden)
    # what the derivatives need of the forward values
    states, h0, z, r, s, c = (np.empty(shape, h.dtype) for _ in range(6))
    cleared = [np.flatnonzero(x == END) for x in xs]
    for t, x in enumerate(xs):
        h0[t] = h
        h0[t, cleared[t]] = 0  # an end clears the state
        states[t], z[t], r[t], s[t], c[t] = advance(split, h0[t], x)
        h = states[t]
    grads = {k: np.zeros_like(p[k]) for k in net.shapes if k != "inputs"}
    logs, dout = output(p, net, states.reshape(-1, hidden), ys.ravel(), grads)
    dout = dout.reshape(shape)
    dg = np.empty((*xs.shape, 3 * hidden), h.dtype)
    dh = np.zeros_like(h)
    fresh_t, gates_t = p["fresh"].T.copy(), p["gates"].T.copy()
    for t in range(len(xs) - 1, -1, -1):
        dh += dout[t]
        keep = 1 - z[t]
        dc = c[t] * c[t]
        np.subtract(1, dc, out=dc)
        dc *= z[t]
        dc *= dh
        ds = dc @ fresh_t
        to_z = c[t] - h0[t]
        to_z *= z[t]
        to_z *= keep
        np.multiply(dh, to_z, out=dg[t, :, :hidden])
        to_r = h0[t] * r[t]
        to_r *= 1 - r[t]
        np.multiply(ds, to_r, out=dg[t, :, hidden : 2 * hidden])
        dg[t, :, 2 * hidden :] = dc
        dh *= keep
        ds *= r[t]
        dh += ds
        dh += dg[t, :, : 2 * hidden] @ gates_t
        dh[cleared[t]] = 0
    every = dg.reshape(-1, 3 * hidden)
    grads["fresh"] = s.reshape(-1, hidden).T @ every[:, 2 * hidden :]
    grads["gates"] = h0.reshape(-1, hidden).T @ every[:, : 2 * hidden]
    flat = xs.ravel()
    by = np.argsort(flat.astype(np.min_scalar_type(net.symbols)), kind="stable")
    flat = flat.take(by)
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    return -float(logs.sum()), h, grads, flat[first], np.add.reduceat(every.take(by, axis=0), first, axis=0)


class Trainer:
    """Adagrad over windows of parallel streams."""

    def __init__(self, net: Network, p: dict, streams: int = STREAMS, window: int = WINDOW, rate: float = RATE):
        self.net, self.streams, self.window, self.rate = net, streams, window, rate
        self.p = {k: v.copy() for k, v in p.items()}
        self.sums = {k: np.full(s, 1e-6, np.float32) for k, s in net.shapes.items()}
        self.tokens, self.loss = 0, 0.0

    def learn(self, symbols: np.ndarray) -> None:
        """One pass over documents joined in one array, each closed by END."""
        if not len(symbols):
            return
        seq = np.concatenate([[END], symbols])
        n = len(symbols)
        streams = max(1, min(self.streams, n // (2 * self.window)))
        # equal streams, and what is left over as one more
        length = n // streams
        even = length * streams
        xs = seq[:even].reshape(streams, length).T
        ys = seq[1 : even + 1].reshape(streams, length).T
        self._run(xs, ys)
        if even < n:
            self._run(seq[even:n, None], seq[even + 1 : n + 1, None])

    def _run(self, xs: np.ndarray, ys: np.ndarray) -> None:
        h = np.zeros((xs.shape[1], self.net.hidden), np.float32)
        for t in range(0, len(xs), self.window):
            x, y = xs[t : t + self.window], ys[t : t + self.window]
            loss, h, grads, rows, dinputs = window_gradient(self.p, self.net, h, x, y)
            scale = np.float32(1 / x.size)
            for k, g in grads.items():
                g *= scale
                self.sums[k] += g * g
                self.p[k] -= self.rate * g / np.sqrt(self.sums[k])
            dinputs *= scale
            sums = self.sums["inputs"].take(rows, axis=0)
            sums += dinputs * dinputs
            self.sums["inputs"][rows] = sums
            self.p["inputs"][rows] -= self.rate * dinputs / np.sqrt(sums)
            self.tokens += x.size
            self.loss += loss


def score_documents(p: dict, net: Network, docs: list[np.ndarray], rows: int = 1 << 13) -> np.ndarray:
    """Natural-log probability of each document (symbols, the last one END), whole.

    Documents of similar length run side by side, longest first, each with its own state from its
    first to its last token; the states of several steps go through the output layer together."""
    order = np.argsort([-len(d) for d in docs], kind="stable")
    out = np.zeros(len(docs))
    split = split_gates(p)
    for a in range(0, len(docs), ABREAST):
        some = order[a : a + ABREAST]
        out[some] = _score_abreast(p, net, split, [docs[i] for i in some], rows)
    return out


def _score_abreast(p: dict, net: Network, split: tuple, docs: list[np.ndarray], rows: int) -> np.ndarray:
    """``score_documents`` of documents by falling length."""
    lens = np.array([len(d) for d in docs])
    starts = np.concatenate([[0], np.cumsum(lens)])[:-1]
    flat = np.concatenate(docs)
    total = np.zeros(len(docs))
    alive = np.searchsorted(-lens, -np.arange(lens[0])).tolist()
    # steps behind an end within a document, which clears the state
    ends = np.flatnonzero(flat == END)
    of = np.searchsorted(starts, ends, side="right") - 1
    closed = set((ends - starts[of] + 1)[ends - starts[of] + 1 < lens[of]].tolist())
    h = np.zeros((len(docs), net.hidden), np.float32)
    x = np.full(len(docs), END)
    states, targets, held = [], [], 0
    for t, n in enumerate(alive):
        h, x = h[:n], x[:n]
        if t in closed:
            h = np.where((x == END)[:, None], np.float32(0), h)
        h = advance(split, h, x)[0]
        x = flat.take(starts[:n] + t)
        states.append(h)
        targets.append(x)
        held += n
        if held >= rows or t + 1 == lens[0]:
            logs, _ = output(p, net, np.concatenate(states), np.concatenate(targets))
            at = 0
            for y in targets:
                total[: len(y)] += logs[at : at + len(y)]
                at += len(y)
            states, targets, held = [], [], 0
    return total


# --- corpus jobs ----------------------------------------------------------------------------------


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches (raw), joined until they hold ``HELD_TEXT`` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(batch.schema.get_field_index("raw")).nbytes
        if size >= HELD_TEXT:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def coded_words(raw: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(place in ``words`` of every word of the texts, number of words of every text, the distinct
    ``words``), the words as ``common.lower_words`` has them."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(raw.view(pa.string())))
    sizes = np.asarray(split.value_lengths())
    coded = split.flatten().dictionary_encode()
    codes, words = np.asarray(coded.indices), coded.dictionary.view(pa.binary())
    empty = words.index(pa.scalar(b"", pa.binary())).as_py()
    if empty >= 0:  # beside white space at the rims of a text, or a text without words
        kept = codes != empty
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
        codes = codes[kept]
    return codes, sizes, words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    size = 0

    def merged() -> pa.Table:
        sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return pa.table({"word": sums.column("word"), "n": sums.column("n_sum")})

    for block in blocks(batches):
        codes, _, words = coded_words(block.column(block.schema.get_field_index("raw")))
        n = np.bincount(codes, minlength=len(words))
        some = pa.table({"word": words, "n": pa.array(n, pa.int64())}).filter(pa.array(n > 0))
        held += [some, pa.table({"word": pa.array([END_WORD], pa.binary()), "n": pa.array([block.num_rows], pa.int64())})]
        size += len(some) + 1
        if size >= 2 * HELD_WORDS:
            held = [merged()]
            size = len(held[0])
            if size >= HELD_WORDS:
                yield from held[0].combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from merged().combine_chunks().to_batches()


def token_counts(docs: DataFrame) -> DataFrame:
    """Written (word, n): exact counts of every token of ``docs`` (raw); the end is ``END_WORD``."""
    return common.written(docs.mapInArrow(common.lean(_count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


def frequent_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, by falling count, then word: all whose count lies above a limit, the
    lowest (of 32 steps per doubling) that leaves at most ``most`` of them.  The driver gets a
    histogram and at most ``most`` rows, however many tasks there are."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 32).cast("int")
    limit, total = None, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        total += r["count"]
        if total > most:
            break
        limit = r["level"]
    if limit is None:
        return []
    rows = counts.where(level >= limit).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))


def symbol_type(symbols: int) -> str:
    return "<u2" if symbols <= 1 << 16 else "<u4"


ENCODED = "row long, doc_id long, held_out boolean, lane int, symbols binary, n_tokens long, n_known long, base double, extra double, words array<binary>, times array<int>"


def _encode(head: pa.Array, columns: tuple[np.ndarray, np.ndarray, np.ndarray], kind: str, end_base: float):
    """One row per document: its symbols, and the sums over its tokens that need no network.

    ``head``: the words of the table.  ``columns`` (symbol, base log10 probability, log10 share of the
    tail) begin with what stands for every other word, and those are listed with how often they stand."""
    symbol_of, base_of, extra_of = columns[0].astype(kind), columns[1], columns[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for block in blocks(batches):
            codes, sizes, words = coded_words(block.column(block.schema.get_field_index("raw")))
            n = block.num_rows
            place = np.asarray(pc.index_in(words, head).fill_null(-1)) + 1
            found, of = place.take(codes), np.repeat(np.arange(n), sizes)
            symbols = np.full(len(found) + n, END, kind)  # every text is closed by an end
            symbols[np.arange(len(found)) + of] = symbol_of.take(found)
            bounds = np.concatenate([[0], np.cumsum(sizes + 1)]) * symbols.itemsize
            rest = np.flatnonzero(found == 0)
            listed, times = np.unique(of.take(rest) * len(words) + codes.take(rest), return_counts=True)
            offsets = pa.array(np.searchsorted(listed, np.arange(n + 1) * len(words)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(row, row + n), pa.int64()),
                    *[block.column(block.schema.get_field_index(c)) for c in ("doc_id", "held_out", "lane")],
                    pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(symbols)]),
                    pa.array(sizes + 1, pa.int64()),
                    pa.array(np.bincount(of, found > 0, n).astype(np.int64)),
                    pa.array(np.bincount(of, base_of.take(found), n) + end_base),
                    pa.array(np.bincount(of, extra_of.take(found), n)),
                    pa.ListArray.from_arrays(offsets, words.take(pa.array(listed % max(1, len(words))))),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                ],
                names=[c.split()[0] for c in ENCODED.split(", ")],
            )
            row += n

    return run


def _train(net: Network, kind: str, flat: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(net, net.unpack(flat))
        held: list[bytes] = []
        size = 0

        def learn() -> None:
            nonlocal held, size
            trainer.learn(np.frombuffer(b"".join(held), kind).astype(np.int64))
            held, size = [], 0

        for batch in batches:
            for symbols in common.batches_of(batch, "symbols")[0]:
                held.append(symbols)
                size += len(symbols)
                if size >= HELD_TOKENS * np.dtype(kind).itemsize:
                    learn()
        learn()
        if trainer.tokens:
            out = net.pack(trainer.p)
            task = TaskContext.get().partitionId()
            for c, a in enumerate(range(0, len(out), CHUNK)):
                yield pa.RecordBatch.from_pylist([{"chunk": c, "task": task, "tokens": trainer.tokens, "loss": trainer.loss, "values": out[a : a + CHUNK].tobytes()}])

    return run


def _mean(rows: pa.Table) -> pa.Table:
    """The token-weighted mean of the same part of several tasks' parameters."""
    weights = np.asarray(rows.column("tokens"), np.float64)
    total = sum(w * np.frombuffer(v, np.float32).astype(np.float64) for w, v in zip(weights, rows.column("values").to_pylist(), strict=True))
    return pa.table(
        {
            "chunk": rows.column("chunk").slice(0, 1),
            "task": rows.column("task").slice(0, 1),
            "tokens": pa.array([int(weights.sum())], pa.int64()),
            "loss": pa.array([float(np.asarray(rows.column("loss")).sum())]),
            "values": pa.array([(total / weights.sum()).astype(np.float32).tobytes()], pa.binary()),
        }
    )


PARTS = "chunk long, task long, tokens long, loss double, values binary"


def train_round(docs: DataFrame, net: Network, kind: str, flat: np.ndarray) -> np.ndarray:
    """One pass over ``docs`` (symbols) from the parameters ``flat``: the averaged parameters.  The
    average is taken in two steps, so that no group holds more than about the root of all tasks."""
    parts = common.written(docs.select("symbols").mapInArrow(common.lean(_train(net, kind, flat)), PARTS), "lm-parts")
    some = parts.groupBy("chunk", (F.col("task") % 64).alias("lane")).applyInArrow(_mean, PARTS)
    rows = some.groupBy("chunk").applyInArrow(_mean, PARTS).orderBy("chunk").select("values").collect()
    return np.concatenate([np.frombuffer(r["values"], np.float32) for r in rows]) if rows else flat


SCORED = "row long, doc_id long, n_tokens long, n_known long, base double, score double"


def _score(net: Network, kind: str, flat: np.ndarray):
    """The network's log10 probability of every document, with the columns that go with it."""
    names = [c.split()[0] for c in SCORED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = net.unpack(flat)
        held: list[pa.RecordBatch] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, tokens
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, tokens = [], 0
            symbols, extra = common.batches_of(rows, "symbols", "extra")
            logs = score_documents(p, net, [np.frombuffer(x, kind).astype(np.int32) for x in symbols]) / math.log(10) + np.array(extra)
            kept = [rows.column(rows.schema.get_field_index(c)) for c in names[:-1]]
            return pa.RecordBatch.from_arrays([*kept, pa.array(logs, pa.float64())], names=names)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                tokens += sum(common.batches_of(batch, "n_tokens")[0])
            # many documents side by side make the network's steps wide
            if tokens >= SIDE_BY_SIDE:
                yield flush()
        if held:
            yield flush()

    return run


def score_corpus(docs: DataFrame, held_out: Column, rounds: int = ROUNDS, vocab: int = VOCAB, classes: int = CLASSES, hidden: int = HIDDEN, table_size: int = TABLE) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row of
    ``docs`` (doc_id, text), learned from the rows where ``held_out`` is not true.

    A null or empty text is its end alone.  Rows that repeat a doc_id are scored one by one.  Without
    training rows every count is 0 and the network keeps its start.  Other columns are ignored.
    """
    spark = docs.sparkSession
    common.configure(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_bytes().alias("raw"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = docs.where(~F.col("held_out"))
    counts = token_counts(train)
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head = frequent_words(counts.where(F.col("word") != F.lit(END_WORD)), table_size)
    end_count = (counts.where(F.col("word") == F.lit(END_WORD)).agg(F.sum("n")).first()[0]) or 0
    # an end that no training row has (no training rows at all) is no type
    own = head[: vocab - 2]
    tail_tokens = total - end_count - sum(n for _, n in own)
    tail_types = types - (end_count > 0) - len(own)
    whole, rest = math.log10(total + 0.1 * (types + 1)), math.log10(tail_tokens + 0.1 * (tail_types + 1))
    net = Network(len(own) + 2, max(2, min(classes, len(own) + 2)), hidden)
    symbol = {w: i + 2 for i, (w, _) in enumerate(own)}
    flat = net.pack(net.start(np.array([end_count, max(tail_tokens, 0), *(n for _, n in own)], np.float64)))
    logs = np.log10(np.array([n for _, n in head], np.float64) + 0.1)
    symbols = np.array([TAIL, *(symbol.get(w, TAIL) for w, _ in head)], np.int32)
    in_tail = np.concatenate([[False], symbols[1:] == TAIL])
    columns = (symbols, np.concatenate([[0.0], logs - whole]), np.where(in_tail, np.concatenate([[0.0], logs - rest]), 0.0))
    kind = symbol_type(net.symbols)
    lane = F.pmod(F.xxhash64("doc_id", F.octet_length("raw")), F.lit(rounds)).cast("int").alias("lane")
    coding = _encode(pa.array([w for w, _ in head], pa.binary()), columns, kind, math.log10(end_count + 0.1) - whole)
    encoded = common.written(docs.select("doc_id", "raw", "held_out", lane).mapInArrow(common.lean(coding), ENCODED), "lm-encoded")
    for r in range(rounds if total else 0):
        flat = train_round(encoded.where(~F.col("held_out") & (F.col("lane") == r)), net, kind, flat)
    scored = encoded.select("row", "doc_id", "n_tokens", "n_known", "base", "extra", "symbols").mapInArrow(common.lean(_score(net, kind, flat)), SCORED)
    listed = encoded.select("row", F.explode(F.arrays_zip("words", "times")).alias("e")).select("row", F.col("e.words").alias("word"), F.col("e.times").alias("times"))
    rare = listed.join(counts, "word", "left")
    c = F.coalesce("n", F.lit(0))
    share = F.log10(c + F.lit(0.1))
    sums = rare.groupBy("row").agg(
        F.sum(F.col("times") * (share - whole)).alias("rare_base"),
        F.sum(F.col("times") * (share - rest)).alias("rare_score"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    out = scored.join(sums, "row", "left")
    # whether the end itself is known
    return out.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + int(end_count > 0) + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
