"""Operators 11, 12 and 13: repair of roles, byte-pair encoding of long words, aligned tokens."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlake.llm import pointer_jumping as pj
from fleetlake.llm import queries
from fleetlake.llm import role_repair as rr
from fleetlake.llm import tree_bpe as tb

SF = "/root/testdata/sf0.001"


# --- 11: role repair --------------------------------------------------------------------------------

MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def inserted(state):
    """(state, inserted lines) after up to three insertions."""
    layer, out = [(state, ())], []
    for _ in range(4):
        out += layer
        layer = [(MOVES[s, x], lines + (name + ":",)) for s, lines in layer for x, name in (("u", "user"), ("a", "assistant")) if (s, x) in MOVES]
    return out


def cheapest(rows):
    """Exhaustive over states of the regular language, with the audits written out."""
    best = {0: (0, "", ())}
    for role, text, kind in rows:
        new = {}

        def put(state, value, new=new):
            if state not in new or value[:2] < new[state][:2]:
                new[state] = value

        for start, (cost, audit, lines) in best.items():
            for s, more in inserted(start):
                c, a, kept = cost + 5 * len(more), audit + "I" * len(more), lines + more
                put(s, (c + 2, a + "D", kept))
                if kind != "gone":
                    extra = 5 if kind == "cut" else 0
                    if (s, role[:1]) in MOVES:
                        put(MOVES[s, role[:1]], (c + extra, a + "K", kept + (f"{role}:{text}",)))
                    for x, name in (("u", "user"), ("a", "assistant")):
                        if (s, x) in MOVES:
                            put(MOVES[s, x], (c + 1 + extra, a + "R", kept + (f"{name}:{text}",)))
        best = new
    ends = [(c + 5 * len(m), a + "I" * len(m), kept + m) for start, (c, a, kept) in best.items() for s, m in inserted(start) if s in (0, 3)]
    return min(ends, key=lambda v: v[:2])


def damage(rows):
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            yield from [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)


def repaired(rows, damaged=True):
    convs = {r[0]: [] for r in rows}
    for r in damage(rows) if damaged else rows:
        convs[r[0]].append(r)
    out = {}
    for conv, held in convs.items():
        held = sorted(held, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, count, seq, illegal = set(), collections.Counter(), [], 0
        for k, (_, _, role, text) in enumerate(held):
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            count[fault] += 1
            seen.add((role, text))
            seq.append((role, text, {"": "", "truncated": "cut"}.get(fault, "gone")))
            illegal += k > 0 and held[k - 1][2][:1] + role[:1] not in ("su", "ua", "au")
        turns = {r[1] for r in held} - {None}
        cost, audit, lines = cheapest(seq)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def as_map(df):
    rows = df.select(*NAMES).collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def odd_conversations(rng, convs=150, long=400):
    rows = []
    for c in range(convs):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            turn = None if rng.random() < 0.05 else t + rng.randint(0, 2)
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"])
            rows.append((c or None, turn, role, rng.choice(["Hi.", "Yes!", "No", "a b?  ", "", " \n", None, "x.\x0b", "é"])))
    rows += [(10**6, t // 2, rng.choice(["user", "assistant", "system"]), f"t{rng.randint(0, 300)}.") for t in range(long)]
    return rows


@pytest.mark.parametrize("piece_rows", [50_000, 7])
def test_repair_equals_brute_force_over_many_tasks(spark, monkeypatch, piece_rows):
    monkeypatch.setattr(rr, "PIECE_ROWS", piece_rows)
    rows = odd_conversations(random.Random(piece_rows))
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, cost int").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert as_map(rr.repair_conversations(rr.damaged(df), digest=True)) == repaired(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_registered_repair(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    assert as_map(queries.QUERIES["op11_glr_repair"](spark, SF)) == repaired([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_repair_without_damage_and_edges(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "assistant", "A."), (2, 0, "assistant", "A."), (3, 5, "user", "Q?"), (4, 0, "user", ""), (None, None, "user", "Q?"), (5, 1, "user", "same."), (5, 1, "user", "same.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in rr.repair_conversations(df).collect()}
    assert (got[1].audit, got[1].cost, got[1].repaired) == ("KKK", 0, "system:S.\nuser:Q?\nassistant:A.")
    assert (got[2].audit, got[2].cost, got[2].repaired) == ("D", 2, "")
    assert (got[4].audit, got[4].blank, got[4].repaired) == ("D", 1, "")
    assert got[5].duplicate == 1 and got[None].audit == "D"
    assert as_map(rr.repair_conversations(df, digest=True)) == repaired(rows, damaged=False)
    assert rr.repair_conversations(df.limit(0)).collect() == []
    none = rr.repair_conversations(df.where("conv_id = 1").withColumn("copies", F.lit(0))).collect()
    assert [(r.conv_id, r.gaps, r.cost, r.audit, r.repaired) for r in none] == [(1, 0, 0, "", "")]


def test_stack_graph():
    g = rr.StackGraph()

    def accepted(word):
        tops = {0}
        for x in word:
            tops = {t for top in tops for t in g.advance(top, x)}
        return any(g.accepts(t) for t in tops)

    for n in range(7):
        for code in range(3**n):
            word = "".join("sua"[code // 3**k % 3] for k in range(n))
            assert accepted(word) == bool(re.fullmatch("(s?(ua)+)?", word))
    with pytest.raises(ValueError):
        rr.StackGraph((("x", ()), ("x", ("u", "x", "a"))), "ua").tops(50)
    # an ambiguous grammar: both parses live, equal stacks are one
    two = rr.StackGraph((("x", ("u",)), ("x", ("x", "x"))), "u")
    assert two.accepts(max(two.advance(two.advance(0, "u")[0], "u")))


# --- 12: tree concatenation -------------------------------------------------------------------------

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def word_library():
    lib = Tokenizer.from_file(WORD_FILE)
    lib.no_truncation()
    lib.no_padding()
    return lib


def odd_texts(rng):
    parts = list("abcABC'sdtlvemr 12\n\té́ Σİß日<|>!?.\x1c\x85") + ["'re", "<|endoftext|>", "the", " "]
    texts = [None, "", " ", "Hello, World's 123 CAFÉ İstanbul ΣΑΣ <|endoftext|>x<|startoftext|> y", "a" * 3000, "!" * 999 + "?" * 77, "<|endoftext|" * 50, "́́ ́a", "ǅ ﬁ Ⅷ ½ ٣"]
    texts += ["".join(rng.choice(["the", "ing", "er", "un", "日本", "é", "𝒳", "ß"]) for _ in range(2000)), "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5000))]
    return texts + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(150)]


@pytest.mark.parametrize("leaf", [1, 8, tb.LEAF])
def test_tree_encoding_equals_the_library(word_library, leaf):
    with open(WORD_FILE, "rb") as f:
        enc = tb.TreeEncoder(f.read(), leaf)
    texts = [t or "" for t in odd_texts(random.Random(leaf))]
    for text, raw in zip(texts, enc.encode_batch(texts), strict=True):
        want = word_library.encode(text, add_special_tokens=False).ids
        ids = np.frombuffer(raw, "<u4").tolist()
        assert ids == want
        assert enc.decode(ids) == word_library.decode(want, skip_special_tokens=False)


def test_long_varied_word_takes_linear_time(word_library):
    with open(WORD_FILE, "rb") as f:
        enc = tb.TreeEncoder(f.read())
    rng = random.Random(5)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400_000))
    begin = time.time()
    (raw,) = enc.encode_batch([word])
    assert time.time() - begin < 30
    assert np.frombuffer(raw, "<u4").tolist() == word_library.encode(word, add_special_tokens=False).ids


def test_held_words_are_bounded(monkeypatch, word_library):
    monkeypatch.setattr(tb, "HELD_CHUNKS", 20)
    with open(WORD_FILE, "rb") as f:
        enc = tb.TreeEncoder(f.read(), 4)
    texts = [" ".join(f"w{k}x{j}" for j in range(9)) for k in range(30)]
    for _ in range(2):
        for t in texts:
            assert np.frombuffer(enc.encode_batch([t])[0], "<u4").tolist() == word_library.encode(t, add_special_tokens=False).ids


def test_encode_documents(spark, word_library):
    with open(WORD_FILE, "rb") as f:
        raw = f.read()
    texts = odd_texts(random.Random(9))
    df = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate([*texts, texts[3]])], "doc_id long, text string, input_ids int, row string")
    got = {r.doc_id: r for r in tb.encode_documents(df, raw, decoded=True).collect()}
    assert len(got) == len(texts) + 1 and all(r.row == "x" for r in got.values())
    for i, t in enumerate([*texts, texts[3]]):
        want = word_library.encode(t or "", add_special_tokens=False).ids
        assert (got[i].input_ids, got[i].decoded) == (want, word_library.decode(want, skip_special_tokens=False))
    assert tb.encode_documents(df.limit(0), raw).collect() == []
    assert [r.input_ids for r in tb.encode_documents(df.where("doc_id = 3").select("text"), raw).collect()] == [got[3].input_ids]


def test_registered_tree_bpe(spark, word_library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op12_tree_bpe"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = word_library.encode(docs[r.doc_id], add_special_tokens=False).ids
        text = word_library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


# --- 13: aligned tokens -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def two_models():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def aligned(texts, models):
    lib_a, lib_b = models
    as_byte = {c: b for b, c in enumerate(tb.bytes_as_chars())}
    docs = []
    for t in texts:
        a, b = (lib_a.encode(" " + t, add_special_tokens=False).ids, lib_b.encode(t)) if t else ([], [])
        ab = [bytes(as_byte[c] for c in lib_a.id_to_token(i)) for i in a]
        bb = [bytes([int(lib_b.id_to_piece(i)[3:5], 16)]) if lib_b.is_byte(i) else lib_b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or not b"".join(ab) == b"".join(bb) == (" " + t).encode():
            docs.append(None)
            continue
        sa, sb = ([(sum(map(len, x[:i])), sum(map(len, x[: i + 1]))) for i in range(len(x))] for x in (ab, bb))
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if sa[i][0] < sb[j][1] and sb[j][0] < sa[i][1]]
        groups, start = [], 0
        for cut in sorted({e for _, e in sa} & {e for _, e in sb}):
            inside = [",".join(str(i) for i, (x, y) in zip(ids, spans, strict=True) if start <= x and y <= cut) for ids, spans in ((a, sa), (b, sb))]
            groups.append("|".join(inside))
            start = cut
        docs.append((len(a), len(b), groups, links))
    held = collections.Counter(p for d in docs if d for p in set(d[3]))
    top = collections.Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if d is None else (d[0], d[1], len(d[2]), len(d[3]), sum(held[p] == top[p[0]] for p in d[3]), sum(held[p] for p in d[3]), ";".join(d[2]))
        for d in docs
    ]


def model_files():
    out = []
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        with open(public_tokenizers.path(name), "rb") as f:
            out.append(f.read())
    return out


def spaced_texts(rng):
    parts = ["the ", "cat", "\n", "  ", "ing", "é", "日", "\r", "\t", "\x85", "'s", "123", " ", "x", " And", "▁", "\x1c", "　"]
    texts = [None, "", " ", "a", "\n", " \n x", "hello  world\r\n<|endoftext|> <s> a▁b", "日本語 テキスト😀 é", "tab\there\x1cq \x85z\xa0 k  ", "a" * 300, "don't stop  \n\n 12345 cats' <0x0A>\t"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(90)]
    return texts + texts[5:15]


@pytest.mark.parametrize("segments", [250_000, 5])
def test_alignment_equals_brute_force(spark, monkeypatch, two_models, segments):
    monkeypatch.setattr(pj, "BLOCK_SEGMENTS", segments)
    texts = spaced_texts(random.Random(segments))
    df = spark.createDataFrame([(i, t, i, "y") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, block string").repartition(3)
    got = {r.doc_id: r for r in pj.align_documents(df, *model_files()).collect()}
    assert len(got) == len(texts) and all(r.block == "y" for r in got.values())
    for i, want in enumerate(aligned(texts, two_models)):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == want
    assert pj.align_documents(df.limit(0), *model_files()).collect() == []
    assert [r.n_links for r in pj.align_documents(df.where("doc_id < 2").select("text"), *model_files()).collect()] == [0, 0]


def test_pointer_doubling_on_random_covers():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, n + 1, int(rng.integers(1, 40))), n)) for _ in range(2)]
        starts = [np.concatenate([[0], e[:-1]]) for e in ends]
        in_a, in_b = pj.group_labels(starts[0], ends[0], starts[1], ends[1])
        cuts = np.intersect1d(*ends)
        for e, labels in zip(ends, (in_a, in_b), strict=True):
            assert np.array_equal(cuts[np.searchsorted(cuts, e)], ends[1][labels])
        a, b = pj.overlap_links(starts[0], ends[0], starts[1])
        want = [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_whole_texts_where_a_model_allows_no_cuts(two_models):
    tool = pj.Aligner(*model_files())
    assert tool.cuts
    texts = [t for t in spaced_texts(random.Random(1)) if t]
    for t in texts:
        assert "".join(tool.segments(t)) == " " + t
    by_segments = [";".join(x for x in tool.align(tool.segments(t)).texts) for t in texts if tool.align(tool.segments(t)).ok.all()]
    tool.cuts = False
    assert by_segments == [tool.align(tool.segments(t)).texts[0] for t in texts if tool.align(tool.segments(t)).ok.all()]


def test_registered_alignment(spark, two_models):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: w for d, w in zip(docs, aligned_fast([d.text for d in docs], two_models), strict=True)}
    rows = queries.QUERIES["op13_pointer_jumping"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == want[r.doc_id]


def aligned_fast(texts, models):
    """As ``aligned`` with merged scans instead of all pairs, for whole documents."""
    lib_a, lib_b = models
    as_byte = {c: b for b, c in enumerate(tb.bytes_as_chars())}
    docs = []
    for t in texts:
        a, b = (lib_a.encode(" " + t, add_special_tokens=False).ids, lib_b.encode(t)) if t else ([], [])
        ab = [bytes(as_byte[c] for c in lib_a.id_to_token(i)) for i in a]
        bb = [bytes([int(lib_b.id_to_piece(i)[3:5], 16)]) if lib_b.is_byte(i) else lib_b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or not b"".join(ab) == b"".join(bb) == (" " + t).encode():
            docs.append(None)
            continue
        links, groups, i, j, ea, eb, ga, gb = [], [], 0, 0, len(ab[0]), len(bb[0]), [a[0]], [b[0]]
        while True:
            links.append((a[i], b[j]))
            da, db = ea <= eb, eb <= ea
            if da and db:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                ga, gb = [], []
            i, j = i + da, j + db
            if i == len(a):
                break
            if da:
                ga.append(a[i])
            if db:
                gb.append(b[j])
            ea, eb = ea + (len(ab[i]) if da else 0), eb + (len(bb[j]) if db else 0)
        docs.append((len(a), len(b), groups, links))
    held = collections.Counter(p for d in docs if d for p in set(d[3]))
    top = collections.Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [
        (0, 0, 0, 0, 0, 0, "")
        if d is None
        else (d[0], d[1], len(d[2]), len(d[3]), sum(held[p] == top[p[0]] for p in d[3]), sum(held[p] for p in d[3]), hashlib.sha256(";".join(d[2]).encode()).hexdigest())
        for d in docs
    ]
