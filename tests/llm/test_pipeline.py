"""The corpus pipeline, stage by stage against plain Python, and on awkward rows."""

import collections
import glob
import os
import random
import string
import tempfile

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from test_near_duplicates import brute

import corpus_pipeline
from fleetlake.llm import crf_langid, guess_cost, pfair_mix, queries, stages

SF = "/root/testdata/sf0.001"


def written(df):
    """(rows in the order of the written files, the frame read again)."""
    path = os.path.join(tempfile.mkdtemp(prefix="fleetlake-pipe-", dir="/tmp"), "t")
    df.write.parquet(path)
    rows = [r for f in sorted(glob.glob(f"{path}/*.parquet")) for r in pq.read_table(f).to_pylist()]
    return rows, df.sparkSession.read.parquet(path)


def key(r):
    return tuple((r[c] is None, str(r[c])) for c in stages.COLUMNS)


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "secret_scan", "mix_sources", "tokenize"]


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage got and gave, each from the written result of the one before."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [
        (900001, None, "en", "src1", 5),
        (900002, "123 456 !!", None, None, None),
        (900003, "password = Xk29vQzL77pq and more words for this text", None, "src1", None),
        (900004, "", "fr", "src2", 0),
        (900005, "a unique document about nothing at all, " * 3000, "en", None, 1),
        (900006, "repeated row of some few words", "en", "src3", 30),
        (900006, "repeated row of some few words", "en", "src3", 30),
        (None, "a row without an id, kept where it is", "en", "src3", 37),
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.select(*stages.COLUMNS).schema))
    out = {}
    rows = [r.asDict() for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        got, docs = written(stage(spark, docs, SF))
        out[name] = (rows, got)
        rows = got
    return out


def test_language_stage(steps):
    before, after = steps["language_id"]
    want = [r for r in before if r["text"] is not None and any(c.isalpha() for c in r["text"])]
    assert sorted(map(key, ({**r, "lang": None} for r in after))) == sorted(map(key, ({**r, "lang": None} for r in want)))
    given = collections.Counter((r["doc_id"], r["lang"]) for r in want if r["lang"] is not None)
    assert not given - collections.Counter((r["doc_id"], r["lang"]) for r in after)
    assert all(r["lang"] for r in after)


def test_language_stage_decides_on_labelled_rows(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*stages.COLUMNS)
    real = {r.doc_id: r for r in docs.where("n_chars > 500").collect()}
    rng = random.Random(8)
    noise = {800000 + i: " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 9))) for _ in range(100)) for i in range(20)}
    wrong = sorted(d for d, r in real.items() if r.lang == "fr")[::20]
    rows = [(d, r.text, "en" if d in wrong else r.lang, r.source, r.n_chars) for d, r in real.items()]
    # labelled noise that is not in the sample, which would teach it
    model = crf_langid.fit_on(spark.createDataFrame(rows, docs.schema), calibrated=True)
    monkeypatch.setattr(stages.crf_langid, "fit_on", lambda docs, calibrated: model)
    rows += [(d, t, None if d % 2 else "en", "s", len(t)) for d, t in noise.items()]
    by_lang = {lang: [r.text for d, r in sorted(real.items()) if r.lang == lang and d not in wrong] for lang in ("en", "fr")}
    rows += [(700000 + i, a[:400] + " " + b[:400], "en", "s", 801) for i, (a, b) in enumerate(zip(by_lang["en"][:10], by_lang["fr"][:10], strict=True))]
    got = {r.doc_id: r.lang for r in stages.language_id(spark, spark.createDataFrame(rows, docs.schema), SF).collect()}
    assert len(noise.keys() & got) <= 4
    assert {700000 + i for i in range(10)} <= set(got)  # a text of two languages stays
    assert len(real.keys() & got) >= 0.99 * len(real)
    assert sum(got.get(d) == "fr" for d in wrong) >= 0.5 * len(wrong)
    assert sum(got.get(d, r.lang) != r.lang for d, r in real.items() if d not in wrong) <= 0.005 * len(real)


def test_language_stage_without_labels(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, "a", 0), (2, "12 !!", None, "a", 5), (3, "some words", None, "a", 10)]
    assert [r.doc_id for r in stages.language_id(spark, spark.createDataFrame(rows, schema), SF).collect()] == [3]


def test_dedup_stage(steps):
    before, after = steps["near_dedup"]
    _, comps = brute([(r["doc_id"], r["text"]) for r in before if r["doc_id"] is not None], 5, 80, 100)
    want = {key(r) for r in before if r["doc_id"] is None or comps[r["doc_id"]] == r["doc_id"]}
    assert sorted(map(key, after)) == sorted(want)
    assert len(after) < len(before)


def test_secret_stage(steps):
    before, after = steps["secret_scan"]
    want = []
    for r in before:
        text = guess_cost.redact(r["text"])
        want.append({**r, "text": text, "n_chars": r["n_chars"] if text == r["text"] else len(text)})
    assert sorted(map(key, after)) == sorted(map(key, want))
    assert any("[secret]" in r["text"] for r in after)


def test_mix_stage(spark, steps):
    before, after = steps["mix_sources"]
    assert sorted(map(key, after)) == sorted(map(key, before))
    schema = "doc_id long, text string, source string"
    frame = spark.createDataFrame([(r["doc_id"], r["text"], r["source"]) for r in before], schema)
    place = {r.doc_id: (r.slot, r.place, r.order_key) for r in pfair_mix.mix(frame).collect()}
    order = [place[r["doc_id"]] for r in after]
    assert order == sorted(order)
    assert len({s for s, _, _ in order}) > 1


def test_token_stage(steps):
    before, after = steps["tokenize"]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    want = collections.Counter((r["doc_id"], tuple(sp.encode(r["text"]))) for r in before)
    assert collections.Counter((r["doc_id"], tuple(r["input_ids"])) for r in after) == want
    assert all(r["n_tokens"] == len(r["input_ids"]) for r in after)


@pytest.mark.parametrize("broadcast_files", [stages.BROADCAST_FILES, 0])
def test_token_stage_keeps_the_order_of_the_mix(spark, monkeypatch, broadcast_files):
    monkeypatch.setattr(stages, "BROADCAST_FILES", broadcast_files)
    docs = spark.createDataFrame([(i, "some words " * (i * 7 % 90 + 1), "en", f"s{i % 5}", 1) for i in range(500)], "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 12):
        before, again = written(docs.repartition(parts, "doc_id"))
        assert len(again.inputFiles()) == parts
        got = sorted((r.position, r.doc_id) for r in stages.tokenize(spark, again, SF).collect())
        assert got == [(i, r["doc_id"]) for i, r in enumerate(before)]
    assert sorted(r.position for r in stages.tokenize(spark, docs, SF).collect()) == list(range(500))


def test_positions_of_the_run_are_the_mix(steps):
    before, after = steps["tokenize"]
    assert sorted(r["position"] for r in after) == list(range(len(before)))
    assert [r["doc_id"] for r in sorted(after, key=lambda r: r["position"])] == [r["doc_id"] for r in before]


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        _, docs = written(stage(spark, docs, SF))
    assert sorted((r.doc_id, r.n_tokens, r.lang) for r in rows) == sorted((r.doc_id, r.n_tokens, r.lang) for r in docs.collect())


def test_empty_documents_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0).selectExpr("*", "1 AS lang_pred", "2 AS findings", "'x' AS slot", "3 AS input_ids", "4 AS rep")
    for name, stage in corpus_pipeline.STAGES:
        rows, docs = written(stage(spark, docs, SF))
        assert rows == [], name
    some = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS lang_pred", "2 AS findings", "'x' AS slot", "3 AS place", "4 AS rep")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, some, SF).columns == list(stages.COLUMNS), name
