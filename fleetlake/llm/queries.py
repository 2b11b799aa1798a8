"""The registered ``opN_`` queries: each applies its operator, with production parameters, to its
whole table and derives the digest columns of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import (
    circulant_minhash,
    common,
    crf_langid,
    gru_lm,
    guess_cost,
    multi_index,
    order_minhash,
    pfair_mix,
    pointer_jumping,
    role_repair,
    tree_bpe,
    warc_zip,
    wavelet_ids,
    wfst_pieces,
)
from fleetlake.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents``: 3-word shingles, similarity 0.85."""
    return circulant_minhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=3, num=85, den=100)


ORACLES["op1_circulant_minhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  END AS s
  FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), comps AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN comps ON comps.a = sets.doc_id
"""


@register
def op3_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of ``embeddings``: cosine 0.95."""
    return multi_index.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.95)


ORACLES["op3_inverted_multi_index"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), fit AS (
  SELECT * FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), comps AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comps ON comps.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""


@register
def op7_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC records of ``pages`` written into ZIP packages and read back by range."""
    folder = common.as_uri(common.scratch_path(spark, "warc-packages"))
    manifest = warc_zip.write_packages(read_table(spark, sf_dir, "pages"), folder)
    records = warc_zip.read_packages(manifest, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op7_warc_zip"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (
  SELECT page_id, payload, CAST(octet_length(encode(payload)) AS BIGINT) AS n, sha1(payload) AS hex,
    max(page_id) OVER (PARTITION BY payload) AS top
  FROM p
), b AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT)) AS g FROM d
)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(g, lambda x:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (x >> 15) AS INTEGER), 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((x >> 10) & 31) AS INTEGER), 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((x >> 5) & 31) AS INTEGER), 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (x & 31) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM b
"""

#: The public tokenizer of op10, by its name in the installed tokenizer package.
BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op10_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of ``documents`` written as wavelet-matrix shards and read back."""
    return wavelet_ids.encode_and_read(spark, read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


@register
def op2_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in ``documents``: fixed patterns, and credential values by their guess cost."""
    return guess_cost.span_digest(read_table(spark, sf_dir, "documents"))


def remainder(modulus: int):
    """crc32 of the doc_id as text, modulo; null for a null doc_id."""
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % modulus


@register
def op9_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of ``documents``, learned where crc32(doc_id) mod 3 is not 1."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    model = crf_langid.fit_on(docs.where(~held_out))
    named = crf_langid.label_documents(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@register
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of ``documents`` and of their edited texts."""
    return order_minhash.fingerprint_edits(read_table(spark, sf_dir, "documents"))


@register
def op6_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all ``documents`` in a mix of their sources, weights by size to the power 0.7."""
    return pfair_mix.mix(read_table(spark, sf_dir, "documents"))


#: The public tokenizer of op8.
PIECES = "piece_bpe_32k.model"


def model_bytes(name: str) -> bytes:
    with open(tokenizer_path(name), "rb") as f:
        return f.read()


@register
def op8_wfst_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all ``documents`` and whether they decode to the text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "text")
    coded = wfst_pieces.encode_documents(docs, model_bytes(PIECES), check=True)
    return coded.select(
        "doc_id",
        F.size("input_ids").cast("long").alias("n_tokens"),
        F.hex(F.xxhash64("input_ids")).alias("ids_hash"),
        (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"),
    )


@register
def op4_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of all ``documents``, learned where crc32(doc_id) mod 10 is not 0."""
    held_out = F.coalesce(remainder(10) == 0, F.lit(False))
    return gru_lm.score_corpus(read_table(spark, sf_dir, "documents"), held_out).withColumn("held_out", held_out)


#: The public tokenizer of op12.
WORD_BPE = "word_bpe_49k.json"


@register
def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all ``documents`` by tree concatenation, and the texts that they decode to."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = tree_bpe.encode_documents(docs, model_bytes(WORD_BPE), decoded=True, packed=True)
    return coded.select(
        "doc_id",
        (F.octet_length("input_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("input_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@register
def op13_pointer_jumping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all ``documents`` by two tokenizers, aligned, with corpus-wide counts of linked ids."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = pointer_jumping.align_documents(docs, model_bytes(BYTE_BPE), model_bytes(PIECES), digest=True)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@register
def op11_glr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged ``conversations`` and their cheapest repair under the role grammar."""
    return role_repair.repair_conversations(role_repair.damaged(read_table(spark, sf_dir, "conversations")), digest=True)
