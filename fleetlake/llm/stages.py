"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm import circulant_minhash, common, crf_langid, guess_cost, pfair_mix, queries, wfst_pieces

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Files up to which their first positions (a row of about 100 bytes each) are broadcast.
BROADCAST_FILES = 100_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null text, no letter in it, or words that the model tells
    apart no better than random letters.  A null ``lang`` takes the predicted language, and so does
    a given one that differs where the model is clear; any other given one stays.  The model learns
    from the rows that have a ``lang``; without any, only the first two reasons count."""
    model = crf_langid.fit_on(docs, calibrated=True)
    named = crf_langid.label_documents(docs.select(*COLUMNS), model, known=True)
    clear = F.lit(bool(model.langs)) & (F.col("lang_score") >= F.lit(model.clear))
    lang = F.when(clear, F.col("lang_pred")).otherwise(F.coalesce("lang", "lang_pred"))
    return named.where("lang_known").withColumn("lang", lang).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (the one with the smallest doc_id): five-word
    shingles, similarity 0.8.  Rows without a doc_id stay; of rows that repeat a kept doc_id with
    the same text one stays."""
    groups = circulant_minhash.near_duplicates(docs, width=5, num=80, den=100, rows=5, bands=32)
    gone = groups.where("not kept").select("doc_id").distinct()
    kept = docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    return kept.join(repeated, "doc_id", "left_anti").unionByName(kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; the secrets in their texts are replaced and n_chars follows the text."""
    clean = guess_cost.redacted(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.size("findings") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: sorted by slot, and within it by place."""
    docs = docs.select(*COLUMNS)
    places = pfair_mix.mix(docs).select("doc_id", F.col("source").alias("mix_source"), "slot", "place", "order_key").dropDuplicates(["doc_id", "mix_source"])
    keyed = docs.withColumn("mix_source", F.coalesce(F.col("source").cast("string"), F.lit("")))
    same = keyed["doc_id"].eqNullSafe(places["doc_id"]) & (keyed["mix_source"] == places["mix_source"])
    placed = keyed.join(places, same, "left").select(*[keyed[c] for c in COLUMNS], "slot", "place", "order_key")
    return placed.repartitionByRange("slot", "place", "order_key").sortWithinPartitions("slot", "place", "order_key", "doc_id").select(*COLUMNS)


def with_position(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position``, the row's number in the written order: files by part number, rows
    as they lie in the file.  A frame that is not read from files: its partitions in order."""
    try:
        rows = docs.withColumns({"mix_file": F.col("_metadata.file_name"), "mix_row": F.col("_metadata.row_index")})
        part = F.regexp_extract("mix_file", "part-([0-9]+)", 1).try_cast("long")
    except AnalysisException:
        rows = docs.withColumn("mix_id", F.monotonically_increasing_id())
        rows = rows.withColumns({"mix_file": F.shiftright("mix_id", 33).cast("string"), "mix_row": F.col("mix_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("mix_id")
        part = F.col("mix_file").cast("long")
    files = rows.groupBy("mix_file").agg(F.count(F.lit(1)).alias("n"))  # a row per file, not per document
    before = F.sum("n").over(Window.orderBy(part, "mix_file").rowsBetween(Window.unboundedPreceding, -1))
    starts = common.written(files.select("mix_file", F.coalesce(before, F.lit(0)).alias("mix_start")), "mix-starts")
    if starts.count() <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    return rows.join(starts, "mix_file").withColumn("position", F.col("mix_start") + F.col("mix_row")).drop("mix_file", "mix_row", "mix_start")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids and its ``position`` in the mix, 0 to n - 1: readers of several
    files give no order of rows, so the order is a column."""
    placed = with_position(docs.select("doc_id", "lang", "source", "text"))
    coded = wfst_pieces.encode_documents(placed, queries.model_bytes(queries.PIECES))
    return coded.withColumn("n_tokens", F.size("input_ids").cast("long"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]
