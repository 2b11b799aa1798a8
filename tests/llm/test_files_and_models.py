"""Operators 4, 6, 7, 8 and 10: models, schedules and files."""

import base64
import collections
import hashlib
import heapq
import io
import json
import math
import random
import struct
import time
import zipfile
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import common
from fleetlake.llm import gru_lm as lm
from fleetlake.llm import pfair_mix as mix
from fleetlake.llm import queries
from fleetlake.llm import warc_zip as wz
from fleetlake.llm import wavelet_ids as wi
from fleetlake.llm import wfst_pieces as wp

# --- 4: language model ------------------------------------------------------------------------------


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    net = lm.Network(7, 3, 4)
    p = {k: v.astype(np.float64) for k, v in net.start(np.arange(7) + 1.0).items()}
    xs, ys, h = rng.integers(0, 7, (5, 3)), rng.integers(0, 7, (5, 3)), rng.normal(size=(3, 4)) * 0.5
    _, _, grads, rows, dinputs = lm.window_gradient(p, net, h, xs, ys)
    grads["inputs"] = np.zeros(net.shapes["inputs"])
    grads["inputs"][rows] = dinputs
    for name, shape in net.shapes.items():
        for _ in range(15):
            i = tuple(int(rng.integers(0, s)) for s in shape)
            if name == "to_member" and p[name][i[0], -1, i[2]] < -1e8:
                continue
            old, losses = p[name][i], []
            for d in (1e-4, -1e-4):
                p[name][i] = old + d
                losses.append(lm.window_gradient(p, net, h, xs, ys)[0])
            p[name][i] = old
            assert abs((losses[0] - losses[1]) / 2e-4 - grads[name][i]) < 1e-5


def test_probabilities_add_up_and_state_is_carried():
    rng = np.random.default_rng(1)
    net = lm.Network(40, 5, 6)
    p = net.start(rng.integers(1, 100, 40).astype(float))
    h = np.tanh(rng.normal(size=(3, 6))).astype(np.float32)
    total = sum(np.exp(lm.output(p, net, h, np.full(3, y))[0]) for y in range(40))
    assert np.allclose(total, 1, atol=1e-5)
    docs = [rng.integers(0, 40, n) for n in (1, 90, 33, 33, 7)]
    together = lm.score_documents(p, net, docs, rows=8)
    for d, got in zip(docs, together, strict=True):
        state, want, x = np.zeros((1, 6), np.float32), 0.0, lm.END
        for y in d:
            state, _ = lm.step(p, state, np.array([x]))
            want += lm.output(p, net, state, np.array([y]))[0][0]
            x = y
        assert abs(got - want) < 1e-3
    assert lm.score_documents(p, net, []).tolist() == []


def test_training_learns_a_pattern():
    net = lm.Network(10, 3, 8)
    seq = np.array([2, 3, 4, 5, 0] * 4000)
    p = net.start(np.bincount(seq, minlength=10).astype(float))
    trainer = lm.Trainer(net, p, streams=32)
    trainer.learn(seq)
    docs = [np.array([2, 3, 4, 5, 0])]
    assert lm.score_documents(trainer.p, net, docs)[0] > lm.score_documents(p, net, docs)[0] + 3
    assert trainer.tokens == len(seq)


def test_small_output_layers_share_a_softmax(monkeypatch):
    rng = np.random.default_rng(3)
    net = lm.Network(400, 30, 6)
    p = net.start(rng.integers(1, 100, 400).astype(float))
    h, y = np.tanh(rng.normal(size=(300, 6))).astype(np.float32), rng.integers(0, 400, 300)
    calls, plain = [], lm.softmax_rows
    monkeypatch.setattr(lm, "softmax_rows", lambda *a: calls.append(1) or plain(*a))
    grads = {k: np.zeros_like(p[k]) for k in net.shapes}
    logs, dh = lm.output(p, net, h, y, grads)
    assert len(calls) == 2  # one for the classes, one for the members of all of them
    # layers by themselves
    monkeypatch.setattr(lm, "TOGETHER", 0)
    alone = {k: np.zeros_like(p[k]) for k in net.shapes}
    logs_alone, dh_alone = lm.output(p, net, h, y, alone)
    assert len(calls) > 20 and np.allclose(logs, logs_alone) and np.allclose(dh, dh_alone)
    assert all(np.allclose(grads[k], alone[k]) for k in grads)


def test_scores_beyond_a_float_among_others():
    rng = np.random.default_rng(4)
    net = lm.Network(41, 5, 6)
    p = net.start(rng.integers(1, 100, 41).astype(float))
    p["to_member"][2, :-1] *= 2000
    h, y = np.tanh(rng.normal(size=(200, 6))).astype(np.float32), rng.integers(0, 41, 200)
    logs, _ = lm.output(p, net, h, y, {k: np.zeros_like(p[k]) for k in net.shapes})
    h1 = np.concatenate([h, np.ones((200, 1))], axis=1)
    for k in range(200):
        want = 0.0
        for w, at in ((p["to_class"], net.class_of[y[k]]), (p["to_member"][net.class_of[y[k]]], net.member_of[y[k]])):
            a = h1[k] @ w.astype(np.float64)
            want += 0.0 if w is not p["to_class"] and net.class_of[y[k]] == 0 else a[at] - a.max() - np.log(np.exp(a - a.max()).sum())
        assert abs(logs[k] - want) < 1e-4 * max(1, abs(want))


def test_documents_in_groups_score_the_same(monkeypatch):
    rng = np.random.default_rng(5)
    net = lm.Network(40, 5, 6)
    p = net.start(rng.integers(1, 100, 40).astype(float))
    docs = [rng.integers(0, 40, n) for n in (1, 90, 33, 0, 33, 7, 2)]  # ends within documents as well
    whole = lm.score_documents(p, net, docs)
    monkeypatch.setattr(lm, "ABREAST", 2)
    assert np.allclose(lm.score_documents(p, net, docs, rows=8), whole)


def test_words_of_texts_and_their_counts(monkeypatch):
    rng = random.Random(6)
    marks = [bytes([b]) for b in range(256)] + [b" ", b"a", b"B", b"\t", b"\x0b", "\u00c9".encode(), "\u00a0".encode()] * 30
    texts = [b"", b" ", b" \n", b"x", *(b"".join(rng.choice(marks) for _ in range(rng.randint(0, 60))) for _ in range(200))]
    raw = pa.array([b"not here", *texts]).slice(1)
    codes, sizes, words = lm.coded_words(raw)
    found, at = words.to_pylist(), 0
    for text, n in zip(texts, sizes, strict=True):
        assert [found[c] for c in codes[at : at + n]] == common.lower_words(text)
        at += n
    assert at == len(codes)
    want = collections.Counter(w for t in texts for w in [*common.lower_words(t), lm.END_WORD])
    batches = [pa.record_batch([raw.slice(k, 7)], names=["raw"]) for k in range(0, len(texts), 7)]
    for held in (5, 400_000):  # passed on early; all at once
        monkeypatch.setattr(lm, "HELD_WORDS", held)
        monkeypatch.setattr(lm, "HELD_TEXT", held)
        out, got = list(lm._count(iter(batches))), collections.Counter()
        for b in out:
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got[w] += n
        assert got == want and (len(out) > 1) == (held == 5)
    assert list(lm._count(iter([]))) == []


def test_corpus_scores_and_exact_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "HELD_WORDS", 50)
    rng = random.Random(2)
    words = [f"W{i}" for i in range(120)]
    rows = [(i, " ".join(words[min(int(rng.expovariate(0.05)), 119)] for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "never-seen here"), (502, "never-seen here"), (None, "w1 W2")]
    df = spark.createDataFrame([(d, t, 1, b"x") for d, t in rows], "doc_id long, text string, n int, word binary")
    held = F.col("doc_id") % 5 == 2
    got = lm.score_corpus(df, held, vocab=30, classes=4, hidden=6, table_size=50).collect()
    assert len(got) == len(rows)
    counts = collections.Counter()
    tokens = lambda t: [*(t or "").lower().split(), "\n"]
    for d, t in rows:
        if d is None or d % 5 != 2:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for d, t in rows:
        want = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))
        for r in by[d]:
            assert abs(r.base_score - want) < 1e-9 * max(1, abs(want))
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n)
            assert r.score < 0
    assert len(by[502]) == 2
    # no training rows; no rows
    assert {r.train_tokens for r in lm.score_corpus(df, F.lit(True), vocab=30).collect()} == {0}
    assert lm.score_corpus(df.limit(0), held).collect() == []


def test_model_beats_the_unigram_base_on_held_out_text(spark):
    rows = queries.QUERIES["op4_gru_lm"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


# --- 6: Pfair ---------------------------------------------------------------------------------------


def one_pass(blocks, weights):
    """((source, block) of every slot, times at which the ideal mix has placed 0, 1, 2, ... blocks of
    each source): the ideal mix phase by phase in fractions, then one heap over all slots."""
    left = {s: n for s, n in blocks.items() if n > 0}
    times = {s: [Fraction(0)] for s in left}
    got, now, running = dict.fromkeys(left, Fraction(0)), Fraction(0), set(left)
    while running:
        whole = sum(weights[s] for s in running)
        step = min((left[s] - got[s]) * whole / weights[s] for s in running)
        for s in running:
            rate = weights[s] / whole
            while len(times[s]) <= left[s] and len(times[s]) <= got[s] + rate * step:
                times[s].append(now + (len(times[s]) - got[s]) / rate)
            got[s] += rate * step
        now += step
        running = {s for s in running if got[s] < left[s]}
    jobs = sorted((math.floor(times[s][i]), math.ceil(times[s][i + 1]), s, i) for s in left for i in range(left[s]))
    out, ready, at = [], [], 0
    for slot in range(len(jobs)):
        while at < len(jobs) and jobs[at][0] <= slot:
            heapq.heappush(ready, jobs[at][1:])
            at += 1
        deadline, s, i = heapq.heappop(ready)
        assert deadline > slot
        out.append((s, i))
    return out, times


def in_segments(ideal, segment, slots=None):
    """(source numbers, blocks) of each segment, one after the other."""
    done = np.zeros(len(ideal.names), np.int64)
    slots = ideal.slots if slots is None else slots
    for t0 in range(0, slots, segment):
        t1 = min(t0 + segment, slots)
        upto = ideal.advance(t0, t1, done)
        yield ideal.schedule(t0, t1, done, upto)
        done = upto


def whole_weights(ideal):
    return {s: Fraction(int(x)) for s, x in zip(ideal.names, ideal.w, strict=True)}


def test_segments_make_the_schedule_of_one_pass():
    rng = random.Random(1)
    for _ in range(150):
        blocks = {f"s{i:03d}": rng.choice([0, 1, 3, rng.randint(1, 60)]) for i in range(rng.choice([1, 2, 5, 20, 60]))}
        draw = rng.choice([lambda: 1.0, lambda: rng.random() + 1e-3, lambda: float(rng.randint(1, 5)), lambda: rng.choice([1.0, 1e-4])])
        ideal = mix.Ideal(blocks, {s: draw() for s in blocks})
        want, times = one_pass(blocks, whole_weights(ideal))
        got = [(ideal.names[s], int(b)) for part in in_segments(ideal, rng.choice([1, 2, 3, 7, 16, 64, 1000])) for s, b in zip(*part, strict=True)]
        assert got == want
        # every prefix within less than one block of the ideal mix, ends of sources included
        for slot, (s, i) in enumerate(got):
            assert times[s][i] < slot + 1 and times[s][i + 1] > slot


@pytest.mark.parametrize("kind", ["20 equal", "37 random", "1000 tiny", "1000 tiny and 3 large"])
def test_lag_against_the_target_weights_stays_below_one_block(kind):
    rng = random.Random(8)
    weights = {
        "20 equal": [1.0] * 20,
        "37 random": [rng.random() + 1e-6 for _ in range(37)],
        "1000 tiny": [1.0] * 1000,
        "1000 tiny and 3 large": [1.0] * 1000 + [5e5, 3e5, 1e3],
    }[kind]
    total, slots = sum(weights), 1_000_000
    names = [f"{i:04d}" for i in range(len(weights))]
    ideal = mix.Ideal({s: int(2 * slots * w / total) + 2 for s, w in zip(names, weights, strict=True)}, dict(zip(names, weights, strict=True)))
    source = np.concatenate([s for s, _ in in_segments(ideal, mix.SEGMENT, slots)])
    assert len(source) == slots
    whole = int(ideal.w.sum())
    for j, w in enumerate(weights):
        # the lag is greatest just before and just after a block; in whole numbers, hence without rounding
        at, part = np.flatnonzero(source == j), int(ideal.w[j])
        before = np.arange(len(at)) * whole - at * part
        assert abs(before).max(initial=0) < whole and abs(before + whole - part).max(initial=0) < whole
        assert abs(len(at) * whole - slots * part) < whole
        # the weights as given: what rounding them moves is below a millionth of a block
        assert slots * abs(part / whole - w / total) < 1e-6


def test_rounded_weights_and_sources_without_a_weight():
    ideal = mix.Ideal({"a": 5, "b": 5, "c": 5, "d": 0}, {"a": 0.5, "b": 0.25, "c": -1.0, "x": 9.0})
    assert ideal.names == ["a", "b", "c"] and ideal.slots == 15
    assert np.allclose(ideal.w / ideal.w.sum(), [0.5, 0.25, 0.25], atol=1e-12)
    big = mix.Ideal({"a": 10**9, "b": 7 * 10**8}, {"a": 0.3, "b": 0.7})
    assert int(big.w.sum()) * big.slots < 1 << 62
    assert int(big.placed(10**9)[0].sum()) in (10**9, 10**9 - 1)
    assert mix.Ideal({}, {}).slots == 0


def brute_mix(rows, weights, block_chars):
    """One source after the other, one slot after the other."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    blocks = {}
    for s, docs in by.items():
        place = 0
        for r in sorted(docs, key=lambda r: ((r.order_key % (1 << 64) >> 40) % mix.RANGES, r.order_key, r.doc_id or -1, r.n_chars)):
            blocks.setdefault((s, place // block_chars), []).append((r.doc_id, place))
            place += r.n_chars
        by[s] = max(1, -(-place // block_chars) + (place % block_chars == 0))
    order, _ = one_pass(by, whole_weights(mix.Ideal(by, weights)))
    slots = {b: slot for slot, b in enumerate(order)}
    return sorted((slots[b], place, d if d is not None else -1) for b, docs in blocks.items() for d, place in docs)


def test_mix_matches_a_sequential_mix(spark):
    rng = random.Random(3)
    rows = [(i, "x" * rng.choice([0, 3, 40, 700]), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(1000, None, "d"), (None, "yy", "a"), (1001, "y" * 5000, "b")]
    df = spark.createDataFrame([(d, t, s, 1, 2) for d, t, s in rows], "doc_id long, text string, source string, block int, slot int")
    weights = {"a": 0.2, "b": 0.5, "c": 0.2, "d": 0.05, "": 0.05}
    got = mix.mix(df, weights, block_chars=500, segment=16).collect()
    assert sorted((r.slot, r.place, r.doc_id if r.doc_id is not None else -1) for r in got) == brute_mix(got, weights, 500)
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(d for d, _, _ in rows)
    # while no source has run out, each is within one block of its share
    first = [r for r in got if r.phase == 0]
    end = max(r.slot for r in first) + 1
    for s in weights:
        used = {r.block for r in first if r.source == s}
        assert len(used) <= end * weights[s] + 1
    assert mix.mix(df.limit(0)).collect() == []


def test_many_small_sources_share_a_place(spark, monkeypatch):
    monkeypatch.setattr(mix, "MAX_SOURCES", 4)
    rows = [(i, "x" * (1000 if i % 7 < 3 else 30), f"s{i % 7}") for i in range(700)]
    for weights in (None, {f"s{i}": 1.0 for i in range(7)}):
        got = mix.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights, block_chars=500, segment=64).collect()
        assert collections.Counter((r.doc_id, r.source) for r in got) == collections.Counter((d, s) for d, _, s in rows)
        by_slot = collections.defaultdict(set)
        for r in got:
            by_slot[r.slot].add(r.source)
        pool = {"s3", "s4", "s5", "s6"}
        assert all(len(s) == 1 or s <= pool for s in by_slot.values())
        assert any(len(s & pool) > 1 for s in by_slot.values())


def test_registered_mix_matches_a_sequential_mix(spark):
    got = queries.QUERIES["op6_pfair_mix"](spark, "/root/testdata/sf0.001").collect()
    totals = collections.Counter()
    for r in got:
        totals[r.source] += r.n_chars
    weights = {s: float(max(n, 1)) ** 0.7 for s, n in totals.items()}
    assert sorted((r.slot, r.place, r.doc_id) for r in got) == brute_mix(got, weights, mix.BLOCK_CHARS)


# --- 7: WARC in ZIP ---------------------------------------------------------------------------------


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_packages_round_trip(spark):
    rows = [(1, "http://a/1", "same"), (2, "http://a/2\r\nX: y", "same"), (3, None, "same"), (3, None, "same"), (4, "u", ""), (5, "u", None), (6, "é", "ü\r\n\r\nContent-Length: 3\r\n"), (None, "n", "same"), (7, "long", "z" * 300000)]
    df = spark.createDataFrame([(p, u, h, "d") for p, u, h in rows], "page_id long, url string, html string, digest string")
    folder = common.as_uri(common.scratch_path(spark, "warc-test"))
    manifest = wz.write_packages(df, folder, package_bytes=400)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in wz.read_packages(manifest).collect())
    want = collections.Counter()
    for p, _, h in rows:
        raw = (h or "").encode()
        top = {"same": 3, "": 5}.get(h or "", p)
        revisit = p != top
        want[p, len(raw), digest(raw), "revisit" if revisit else "response", top if revisit else None, None if revisit else raw] += 1
    assert got == want
    urls = {r.page_id: r.url for r in wz.read_packages(manifest, with_payload=False).collect()}
    assert urls[2] == "http://a/2%0D%0AX:%20y"
    assert urls[3] == "urn:page:3"
    empty = wz.write_packages(df.limit(0), folder + "-none")
    assert wz.read_packages(empty).collect() == []


def test_least_bytes_keeps_small_payloads_as_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    manifest = wz.write_packages(df, common.as_uri(common.scratch_path(spark, "warc-small")), least_bytes=3)
    assert {(r.page_id, r.record_type) for r in wz.read_packages(manifest).collect()} == {(1, "response"), (2, "response"), (3, "revisit"), (4, "response")}


def records(n):
    out = [wz.gzip_member(wz.warc_record(i, f"http://x/{i}", "1970-01-01T00:00:00Z", digest(b"p%d" % i), len(b"p%d" % i), b"p%d" % i, None)) for i in range(n)]
    index, at = [], 0
    for r in out:
        index.append(wz.index_line(f"http://x/{len(index)}", "1970-01-01T00:00:00Z", "", at, len(r), False))
        at += len(r)
    return out, index


def zip64_of(raw):
    """The same archive with saturated fields, ZIP64 extras and a ZIP64 end of central directory."""
    end = raw.rfind(struct.pack("<I", wz.END_RECORD))
    n, size, at = struct.unpack_from("<HII", raw, end + 10)
    central, p = b"", at
    for _ in range(n):
        name, extra, comment = struct.unpack_from("<HHH", raw, p + 28)
        packed, plain = struct.unpack_from("<II", raw, p + 20)
        (local,) = struct.unpack_from("<I", raw, p + 42)
        z64 = struct.pack("<HHQQQ", wz.ZIP64_EXTRA, 24, plain, packed, local)
        other = struct.pack("<HH", 0x7777, 3) + b"abc"
        central += raw[p : p + 20] + b"\xff" * 8 + struct.pack("<HHH", name, len(other + z64), comment) + raw[p + 34 : p + 42] + b"\xff" * 4
        central += raw[p + 46 : p + 46 + name] + other + z64
        p += 46 + name + extra + comment
    out = raw[:at] + central
    out64 = struct.pack("<IQHHIIQQQQ", wz.END64_RECORD, 44, 45, 45, 0, 0, n, n, len(central), at)
    locator = struct.pack("<IIQI", wz.END64_LOCATOR, 0, len(out), 1)
    return out + out64 + locator + struct.pack("<IHHHHIIH", wz.END_RECORD, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 4) + b"note"


def test_directory_zip64_and_missing_index():
    out, index = records(7)
    plain = wz.package(out, index)
    for raw in (plain, zip64_of(plain)):
        read = lambda at, n, raw=raw: raw[at : at + n]
        assert zipfile.ZipFile(io.BytesIO(plain)).namelist() == list(wz.members(read, len(raw)))
        ranges = wz.record_ranges(read, len(raw), range_bytes=600)
        got = []
        for r in ranges:
            got += [wz.parse_record(x) for x in wz.split_records(wz.windows(read, r["start"], r["length"], 50), True)]
        assert len(ranges) > 1
        assert [(g["page_id"], g["payload"]) for g in got] == [(i, b"p%d" % i) for i in range(7)]
    bare = io.BytesIO()
    with zipfile.ZipFile(bare, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/a.warc.gz", b"".join(out))
        z.writestr("archive/b.warc", b"".join(zlib.decompress(r, 31) for r in out))
    raw = bare.getvalue()
    for r in wz.record_ranges(lambda at, n: raw[at : at + n], len(raw)):
        found = wz.split_records([raw[r["start"] : r["start"] + r["length"]]], r["member"].endswith(".gz"))
        assert [wz.parse_record(x)["payload"] for x in found] == [b"p%d" % i for i in range(7)]
    with pytest.raises(ValueError, match="not a ZIP"):
        wz.members(lambda at, n: b"x" * n, 100)
    broken = wz.warc_record(1, "u", "d", digest(b"other"), 2, b"ab", None)
    with pytest.raises(ValueError, match="digest"):
        wz.parse_record(broken)


def plain_record(kind, ident, block, content="application/http;msgtype=response", digest_of=None):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{ident}>", f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    if digest_of:
        lines.append(f"WARC-Payload-Digest: {digest_of}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def foreign_archive():
    """An archive as other programs write it: several members, records of other types that no index
    names, keyed index lines in several files and forms, digests in other forms."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n2;x=y\r\nde\r\n0\r\n\r\n"
    first = [
        plain_record("warcinfo", "info", b"software: x\r\n", "application/warc-fields"),
        plain_record("response", "a", http + b"A" * 300, digest_of="sha1:" + digest(b"A" * 300)),
        plain_record("request", "a-req", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", "application/http; msgtype=request"),
        plain_record("response", "b", chunked, digest_of="sha1:" + hashlib.sha1(b"abcde").hexdigest()),
        plain_record("resource", "c", b"not http\r\n\r\nat all", "text/plain", digest_of="sha256:00"),
    ]
    second = [plain_record("response", f"s{i}", http + b"S%d" % i) for i in range(5)]
    third = [plain_record("response", f"t{i}", http + b"T%d" % i) for i in range(4)]
    parts = {"one.warc.gz": [wz.gzip_member(r) for r in first], "two.warc": second, "three.warc.gz": [wz.gzip_member(b"".join(third))]}
    places = {}
    for name, records_of in parts.items():
        places[name] = [(sum(map(len, records_of[:i])), len(r)) for i, r in enumerate(records_of)]
    line = lambda key, name, i, **more: f"{key} 20200101000000 " + json.dumps({"url": "http://x/{y z}", "offset": str(places[name][i][0]), "length": str(places[name][i][1]), "filename": name, **more})
    cdxj = "!meta 1\n" + "\n".join([line("com,x)/{y}", "one.warc.gz", 1), line("com,x)/b", "one.warc.gz", 3), line("com,x)/gone", "one.warc.gz", 3).replace("one.warc.gz", "elsewhere.warc.gz")])
    cdx = " CDX N b a m s k r M S V g\n" + "".join(f"com,x)/s 20200101000000 http://x/s text/html 200 - - - {n} {at} two.warc\n" for at, n in places["two.warc"][2:4])
    old = f"com,x)/s 20200101000000 http://x/s text/html 200 - - {places['two.warc'][4][0]} two.warc\n"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}")
        for name, records_of in parts.items():
            z.writestr(f"archive/{name}", b"".join(records_of))
        z.writestr("indexes/index.cdxj", cdxj, zipfile.ZIP_DEFLATED)
        z.writestr("indexes/more.cdx.gz", wz.gzip_member(cdx.encode()[:60]) + wz.gzip_member(cdx.encode()[60:]))
        z.writestr("indexes/old.cdx", old)
    ids = ["info", "a", "a-req", "b", "c"] + [f"s{i}" for i in range(5)] + [f"t{i}" for i in range(4)]
    return out.getvalue(), ids


def test_archives_of_other_programs(spark, tmp_path):
    raw, ids = foreign_archive()
    for k, form in enumerate((raw, zip64_of(raw))):
        (tmp_path / f"{k}.wacz").write_bytes(form)
        for range_bytes in (1, 400, wz.RANGE_BYTES):
            ranges = wz.record_ranges(lambda at, n, form=form: form[at : at + n], len(form), range_bytes)
            for name in ("one.warc.gz", "two.warc", "three.warc.gz"):
                mine = [r for r in ranges if r["member"] == f"archive/{name}"]
                _, at, length = wz.members(lambda at, n, form=form: form[at : at + n], len(form))[f"archive/{name}"]
                assert [r["start"] for r in mine] == [at, *[r["start"] + r["length"] for r in mine[:-1]]]
                assert sum(r["length"] for r in mine) == length
            if range_bytes == 1:
                assert len(ranges) == 5 + 4 + 1  # around every indexed record; one without index
    manifest = spark.createDataFrame([(f"file://{tmp_path}/{k}.wacz", "clash", 3) for k in range(2)], "path string, payload string, page_id int")
    got = wz.read_packages(manifest).collect()
    assert collections.Counter(r.record_id for r in got) == collections.Counter({f"urn:uuid:{i}": 2 for i in ids})
    by = {r.record_id.removeprefix("urn:uuid:"): r for r in got}
    assert {r.page_id for r in got} == {None}
    assert bytes(by["a"].payload) == b"A" * 300 and by["a"].payload_digest == digest(b"A" * 300)
    assert bytes(by["b"].payload) == b"abcde" and by["b"].payload_digest == digest(b"abcde")
    assert bytes(by["c"].payload) == b"not http\r\n\r\nat all"
    assert by["info"].record_type == "warcinfo" and by["a-req"].payload_bytes == 0
    assert [bytes(by[f"t{i}"].payload) for i in range(4)] == [b"T%d" % i for i in range(4)]
    assert wz.read_packages(manifest.limit(0)).collect() == []


def test_index_lines():
    assert wz.url_key("http://www.Example.com:8080/A?b=C d") == "com,example:8080)/a?b=c%20d"
    assert wz.url_key(None) == "-" and wz.url_key("urn:page:3") == "urn:page:3"
    line = wz.index_line("http://x.org/{a b}", "2020-01-02T03:04:05Z", "D", 7, 9, True)
    assert line.startswith("org,x)/{a%20b} 20200102030405 {")
    assert wz.index_entries("i.cdxj", (line + "\r\n\n").encode()) == [(7, 9, "data.warc.gz")]
    assert wz.index_entries("i.json", b'{"offset": 1}') == [(1, None, None)]
    with pytest.raises(ValueError, match="not an index line"):
        wz.index_entries("i.cdx", b"a b c")
    with pytest.raises(ValueError, match="outside"):
        raw = wz.package([b"x"], [wz.index_line("u", "", "", 5, 9, False)])
        wz.record_ranges(lambda at, n: raw[at : at + n], len(raw))


def test_many_records_without_an_index_are_split_in_linear_time():
    one = plain_record("response", "x", b"HTTP/1.1 200 OK\r\n\r\n" + b"y" * 400)
    for gzipped, record in ((False, one), (True, wz.gzip_member(one))):
        raw = record * 100_000
        begun = time.process_time()
        pieces = wz.windows(lambda at, n, raw=raw: raw[at : at + n], 0, len(raw))
        assert sum(1 for x in wz.split_records(pieces, gzipped) if len(x) == len(one) - 4) == 100_000
        assert time.process_time() - begun < 20
    for cut in (one[:-10], one + b"junk\r\n\r\n"):
        with pytest.raises(ValueError, match=r"ends early|not a WARC"):
            list(wz.split_records([cut], False))
    with pytest.raises(ValueError, match="ends early"):
        list(wz.split_records([wz.gzip_member(one)[:-9]], True))


def test_hot_and_cold_payloads_find_the_same_response(spark, monkeypatch):
    rows = [(i if i % 11 else None, f"u{i}", f"p{min(i % 40, 9)}") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    kinds = []
    for part in (1, 5, 1000):  # none, some and all of the repeated payloads are hot
        monkeypatch.setattr(wz, "HOT_PART", part)
        manifest = wz.write_packages(df, common.as_uri(common.scratch_path(spark, "warc-hot")))
        kinds.append(collections.Counter((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in wz.read_packages(manifest, with_payload=False).collect()))
    assert kinds[0] == kinds[1] == kinds[2]
    top = {h: max(p for p, _, x in rows if x == h and p is not None) for _, _, h in rows}
    want = collections.Counter((p, digest(h.encode()), "response" if p == top[h] else "revisit", None if p == top[h] else top[h]) for p, _, h in rows)
    assert kinds[0] == want


# --- 8: pieces --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return wp.Transducer(queries.model_bytes(queries.PIECES))


def test_pieces_match_the_library(pieces):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    rng = random.Random(2)
    cases = ["", "a", "  Hello  world\n\tx ", "éé漢字", "\n", "\nfoo", " foo", "foo\n\nbar", "<s> </s> <unk> <0x0A>", "a" * 50, " " * 37, "▁", "a▁b", "x " * 3000]
    cases += ["".join(rng.choice("  \nabeést thin.1漢ñ😀") for _ in range(rng.randint(0, 25))) for _ in range(800)]
    held = [p for p in pieces.model.pieces[300:] if len(p) > 1]
    cases += ["".join(rng.choice(held).replace(wp.SPACE, " ") for _ in range(rng.randint(1, 8))) for _ in range(800)]
    got = [np.frombuffer(x, pieces.dtype).tolist() for x in pieces.encode_batch(cases)]
    assert got == sp.encode(cases)
    for text, ids in zip(cases, got, strict=True):
        if wp.SPACE not in text:
            assert pieces.decode(ids) == text


def test_unigram_paths_are_shortest():
    """A small unigram model against all segmentations."""

    def field(n, kind, body):
        return bytes([n << 3 | kind]) + body

    def piece(text, score, kind=1):
        body = field(1, 2, bytes([len(text.encode())]) + text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind]))
        return field(1, 2, bytes([len(body)]) + body)

    scores = {"▁": -2.0, "a": -1.5, "b": -1.25, "ab": -2.5, "ba": -2.0, "▁a": -3.0, "aba": -3.25, "bb": -4.0}
    raw = piece("<unk>", 0, 2) + b"".join(piece(p, s) for p, s in scores.items()) + field(2, 2, b"\x02" + field(3, 0, b"\x01")) + field(3, 2, b"\x04" + field(3, 0, b"\x01") + field(4, 0, b"\x00"))
    t = wp.Transducer(raw)

    def best(text):
        if not text:
            return 0.0
        return min(best(text[len(p) :]) - s for p, s in scores.items() if text.startswith(p)) if any(text.startswith(p) for p in scores) else math.inf

    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 9)))
        ids = np.frombuffer(t.encode_batch([text])[0], t.dtype).tolist()
        assert "".join(t.model.pieces[i] for i in ids) == t.normalise(text)
        assert abs(-sum(t.model.scores[i] for i in ids) - best(t.normalise(text))) < 1e-6


def test_documents_round_trip_and_edge_cases(spark):
    rows = queries.QUERIES["op8_wfst_pieces"](spark, "/root/testdata/sf0.001").collect()
    assert all(r.round_trip for r in rows)
    df = spark.createDataFrame([(1, None, 5), (1, "", 6), (None, "a  b\n", 7), (2, "w" * 100000, 8), (2, "w" * 100000, 8)], "doc_id long, text string, decoded int")
    got = wp.encode_documents(df, queries.model_bytes(queries.PIECES), check=True).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == [(0, "a  b\n"), (1, ""), (1, ""), (2, "w" * 100000), (2, "w" * 100000)]
    assert [r.input_ids for r in got if r.doc_id == 1] == [[], []]
    assert wp.encode_documents(df.limit(0), queries.model_bytes(queries.PIECES)).collect() == []


# --- 10: wavelet matrix -----------------------------------------------------------------------------


def test_wavelet_matrix_against_the_array():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 8, 9, 1023, 1024, 1025, 4000):
        ids = rng.integers(0, rng.integers(1, 70000), n)
        docs, lengths, wm = wi.parse_shard(b"".join(wi.shard_bytes([4, None], [n, 0], ids)))
        assert docs == [4, None]
        assert lengths.tolist() == [n, 0]
        assert (wm.all_ids() == ids).all()
        for at in rng.integers(0, n, min(n, 15)).tolist():
            value = int(ids[at])
            where = np.flatnonzero(ids == value)
            k = int(rng.integers(0, len(where)))
            assert wm.access(at) == value
            assert wm.count(value, at) == (ids[:at] == value).sum()
            assert wm.count(value) == len(where)
            assert wm.locate(value, k) == where[k]
        assert wm.count(1 << 20) == 0
        with pytest.raises(IndexError):
            wm.access(n)
        with pytest.raises(IndexError):
            wm.locate(3, n + 1)


def test_cached_encoder_matches_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.BYTE_BPE)
    plain, cached = Tokenizer.from_file(path), wi.CachedEncoder(path)
    assert cached.cuts
    rng = random.Random(1)
    cases = ["", "a", " a", "a ", "a  b", "a\nb", "a\n b", "\na", "a\n", "a\n\nb", "a\tb", "don't it's", "x 　y", "日本 語", "a <|endoftext|> b", "\x1c a", "a\r\nb c", "\n", "é è"]
    cases += ["".join(rng.choice(" \n\ta'sB1é.   \x85\x1c") for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    for text in cases:
        assert np.frombuffer(cached.encode(text), cached.kind).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_shards_match_direct_encoding(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_BPE))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "a b"), (10**6 + 2, "a a")], "doc_id long, text string")
    df = docs.unionByName(extra).withColumn("start", F.lit("s"))
    folder = common.as_uri(common.scratch_path(spark, "wavelet-test"))
    manifest = wi.write_shards(df, folder, public_tokenizers.path(queries.BYTE_BPE), shard_tokens=5000)
    assert manifest.count() > 8
    got = sorted(wi.read_documents(manifest).collect(), key=lambda r: r.start)
    at = 0
    for r, d in zip(got, sorted(df.collect(), key=lambda r: (r.doc_id, r.text or "")), strict=True):
        ids = np.array([*tok.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4")
        assert tuple(r) == (d.doc_id, at, len(ids), zlib.crc32(ids))
        at += len(ids)
    assert wi.encode_and_read(spark, df.limit(0), public_tokenizers.path(queries.BYTE_BPE)).collect() == []


def test_null_doc_ids_come_first(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "doc_id long, text string")
    rows = sorted(wi.encode_and_read(spark, df, public_tokenizers.path(queries.BYTE_BPE)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1]


def test_index_json_is_one_line_per_record():
    out, index = records(3)
    with zipfile.ZipFile(io.BytesIO(wz.package(out, index))) as z:
        assert [json.loads(x) for x in z.read("indexes/index.cdxj").splitlines()] == index
