"""Operators 1 and 3 against brute force, and their edge cases."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fleetlake.llm import circulant_minhash as cm
from fleetlake.llm import common
from fleetlake.llm import multi_index as mi


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if 0 < len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(docs, width, num, den):
    sets = {d: shingles(t, width) for d, t in docs}
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and den * inter >= num * (len(sets[a]) + len(sets[b]) - inter):
                links.append((a, b))
    return sets, components(ids, links)


def near_copies(seed):
    """Families of one base text each, edited more and more, so that similarities lie on both sides
    of the threshold and some links hold only over a third text."""
    rng = random.Random(seed)
    docs, at = [], 100
    for _ in range(8):
        base = [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(rng.choice([30, 120, 400]))]
        docs.append((at, " ".join(base)))
        at += 1
        cur = base
        for _ in range(9):
            cur = list(cur if rng.random() < 0.5 else base)
            for _ in range(rng.choice([0, 1, 2, 4, 9])):
                cur[rng.randrange(len(cur))] = "x" + str(rng.randrange(1000))
            docs.append((at, "  ".join(cur).upper() if rng.random() < 0.2 else "\n".join(cur)))
            at += 1
    return docs


@pytest.mark.parametrize(("width", "num", "den", "rows"), [(3, 85, 100, 6), (5, 80, 100, 5)])
def test_near_duplicates_match_brute_force(spark, width, num, den, rows):
    docs = near_copies(width)
    sets, comps = brute(docs, width, num, den)
    got = cm.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width, num, den, rows).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {d: (len(sets[d]), comps[d], comps[d] == d) for d, _ in docs}
    assert len(set(comps.values())) < len(docs)


def test_near_duplicates_blocks_of_a_large_bucket(spark, monkeypatch):
    """A bucket cut into several blocks loses no link."""
    monkeypatch.setattr(cm, "BLOCK_BYTES", 3000)
    docs = near_copies(77)
    _, comps = brute(docs, 3, 85, 100)
    got = cm.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == comps


def test_near_duplicates_edge_cases(spark):
    long = "word " * 30000
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "a b", 0), (5, "A  B", 0), (5, "A  B", 1), (None, "a b", 0), (6, long, 0), (7, long + "x", 0), (9, "one two three", 0), (8, "one two three", 0)]
    df = spark.createDataFrame([(d, t, e, "r", 5) for d, t, e in rows], "doc_id long, text string, rep int, raw string, h int")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in cm.near_duplicates(df).collect())
    assert got == [
        (0, 1, None, True),
        (1, 0, 1, True),
        (2, 0, 2, True),
        (3, 0, 3, True),
        (4, 1, 4, True),
        (5, 1, 4, False),
        (5, 1, 4, False),
        (6, 1, 6, True),
        (7, 2, 7, True),
        (8, 1, 8, True),
        (9, 1, 8, False),
    ]
    assert cm.near_duplicates(df.limit(0)).collect() == []


def test_second_permutation_is_a_bijection_on_a_sample_and_shifts_give_minhash():
    x = np.arange(1 << 20, dtype=np.uint32) * np.uint32(4096) + np.uint32(77)
    assert len(np.unique(cm.second_permutation(x.copy()))) == len(x)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 600, dtype=np.uint64)
    b = np.concatenate([a[:400], rng.integers(0, 2**64, 200, dtype=np.uint64)])  # similarity 0.5
    same = np.mean(cm.signature(np.unique(a), 2048) == cm.signature(np.unique(b), 2048))
    assert abs(same - 0.5) < 0.06


def test_connected_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(5, i) for i in range(100, 140)] + [(7, 7)]
    got = {r.id: r.component for r in common.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = components({x for e in edges for x in e}, edges)
    want.pop(7)
    assert got == want
    assert common.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def vectors(seed, n=260, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    out = []
    for i in range(n):
        v = base[i % 60] + rng.normal(size=dim) * rng.choice([0.0, 0.15, 0.3, 2.0])
        out.append((i + 10, (v * rng.choice([0.01, 1.0, 50.0])).tolist()))
    return out


@pytest.mark.parametrize("target", [1 - 1e-6, 1.0])
def test_vectors_match_brute_force(spark, monkeypatch, target):
    monkeypatch.setattr(mi, "PER_CELL", 8)
    monkeypatch.setattr(mi, "TILE", 16)
    vecs = vectors(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in mi.near_duplicate_vectors(spark.createDataFrame(vecs, "vec_id long, embedding array<double>"), 0.95, target).collect()}
    x = np.array([v for _, v in vecs])
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    comps = components([i for i, _ in vecs], [(vecs[a][0], vecs[b][0]) for a, b in zip(*np.nonzero(links), strict=True)])
    assert got == {i: (int(links[k].sum()), comps[i], comps[i] == i) for k, (i, _) in enumerate(vecs)}


def test_recall_against_brute_force_on_the_query_set(spark):
    """Of the links of every vector whose id is divisible by 20, found by brute force, at least 0.9
    must be there (here: all)."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.collect()
    x = np.array([r.embedding for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.array([r.vec_id for r in rows])
    q = ids % 20 == 0
    want = (x[q] @ x.T >= 0.95).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in mi.near_duplicate_vectors(df).collect()}
    found = np.array([got[i] for i in ids[q]])
    assert found.sum() >= 0.9 * want.sum()
    assert (found <= want).all()


def test_vectors_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0, 0.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (None, [1.0, 0.0]), (8, [0.0, 1.0]), (9, []), (10, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 3, "c") for i, v in rows], "vec_id long, embedding array<double>, rep int, cell string")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in mi.near_duplicate_vectors(df).collect())
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 8, 9, 10)]
    assert got == sorted([(0, 0, None, True), (6, 2, 6, True), (7, 2, 6, False), (7, 2, 6, False), *alone])
    assert mi.near_duplicate_vectors(df.limit(0)).collect() == []
    assert [tuple(r) for r in mi.near_duplicate_vectors(df.where("vec_id = 2")).collect()] == [(2, 0, 2, True)]


def test_multi_sequence_gives_every_cell_nearest_first():
    rng = np.random.default_rng(0)
    for n, m in ((1, 1), (1, 6), (9, 7), (20, 3)):
        a, b = rng.integers(0, 5, n) / 4, rng.random(m)  # with ties
        got = list(mi.multi_sequence(a, b))
        assert sorted((i, j) for _, i, j in got) == [(i, j) for i in range(n) for j in range(m)]
        assert [d for d, _, _ in got] == sorted(d for d, _, _ in got)
        assert all(d == a[i] ** 2 + b[j] ** 2 for d, i, j in got)
        within = mi.cells_within(a, b, 0.5)
        assert set(within) == {(i, j) for i in range(n) for j in range(m) if a[i] ** 2 + b[j] ** 2 <= 0.25}
    # a few nearest cells of a large grid are found without walking over it
    far = np.arange(1000.0)
    assert [(i, j) for _, i, j in itertools.islice(mi.multi_sequence(far, far), 3)] == [(0, 0), (0, 1), (1, 0)]
    assert list(mi.multi_sequence(far[:0], far)) == []


def test_pairs_that_differ_along_few_directions_are_met(spark, monkeypatch):
    """Vectors of 64 components that lie near a plane of three: the radius for even displacements is
    too small for them, the one measured on the sample is not."""
    monkeypatch.setattr(mi, "PER_CELL", 4)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 3)) @ np.linalg.qr(rng.normal(size=(64, 3)))[0].T + rng.normal(size=(700, 64)) * 1e-3
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    books = (mi.fit_codebook(unit[:, :32], 13), mi.fit_codebook(unit[:, 32:], 13))
    even, measured = mi.search_radius(0.95, 64, 0.9), mi.measured_radius(unit, books, 0.95, 0.999)
    assert even < measured <= mi.search_radius(0.95, 64, 1.0)
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in mi.near_duplicate_vectors(df, 0.95, 0.999).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.999 * want.sum() > 0


def test_a_worker_gives_back_what_earlier_tasks_left():
    def anonymous_mb():
        with open("/proc/self/status") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("RssAnon")) / 1024

    pins = []

    def run(batches):
        for batch in batches:
            held = [np.ones(100 << 7) for _ in range(1000)]  # 100 KB each: from the heap, not mapped
            pins.append(bytearray(64 << 10))  # so that the heap can't shrink from its end
            del held
            yield batch

    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2], pa.int64()), "raw": pa.array([b"a b c d e f", b""], pa.binary())})
    before = anonymous_mb()
    assert list(common.lean(run)(iter([batch]))) == [batch]
    assert anonymous_mb() < before + 40

    common.KEPT["model"] = object()  # as the tokenizer leaves its model in a worker
    (out,) = common.lean(cm._describe(5, 5, 32))(iter([batch]))
    assert out.column("n_shingles").to_pylist() == [2, 0]
    assert not common.KEPT


def test_every_python_step_of_the_search_runs_lean(spark, monkeypatch):
    made = []
    lean = common.lean
    monkeypatch.setattr(common, "lean", lambda run: made.append(run.__qualname__.split(".")[0]) or lean(run))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h i j")], "doc_id long, text string")
    assert sorted(tuple(r) for r in cm.near_duplicates(docs).select("doc_id", "component_id").collect()) == [(1, 1), (2, 1), (3, 3)]
    assert made == ["_describe", "_verify_stars", "_verify_blocks"]
