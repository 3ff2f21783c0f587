"""Registered queries over ``documents``; each derives its digest columns from an operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.llm import fingerprints, language, language_model, licenses, line_dedup, ngram_join, packing, personal_data, pieces
from labelkit.llm.common import table
from labelkit.llm.registry import query

WORD_TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(narrow)


@query("op7_ngram_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


@query(
    "op6_line_dedup",
    """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, line, pos, keeper IS NOT NULL AND doc_id <> keeper AS dropped
  FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def held_out(modulus: int):
    """Whether the remainder that the contracts set aside is 0."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus == 0


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~held_out(5)))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(5).alias("held_out"), "lang_pred", "score", "byte_bits")


@query("op5_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    spans = personal_data.personal_spans(docs).withColumnsRenamed({"doc_id": "__doc"})
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    met = rows.join(spans, rows["doc_id"].eqNullSafe(F.col("__doc")) & (F.col("hash") == F.col("text_hash")), "left")
    every = F.coalesce(F.col("spans"), F.array())
    rules = F.filter(every, lambda s: s["rule"])

    def count(kind: int):
        return F.size(F.filter(rules, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(personal_data.KINDS)]
    return met.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.joined(rules), 256).alias("base_sha256"),
        personal_data.joined(every).alias("spans"),
        (F.size(every) - F.size(rules)).cast("long").alias("n_added"),
    )


@query("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    places = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(places, lambda s: s["start"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels(places).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


@query("op4_document_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = fingerprints.with_next(docs, buckets, "text", {"vector": fingerprints.vector(F.col("text"))})
    n = F.length("text")
    part = F.floor(n / 4).cast("int")
    edited = F.concat(F.left("text", n - part), F.left("next_text", part))
    rows = rows.withColumn("edited", edited).withColumn("edited_vector", fingerprints.vector(F.col("edited")))
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.written(F.col("vector")).alias("fingerprint"),
        fingerprints.written(F.col("edited_vector")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        fingerprints.likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, as a checksum of its ids in decimal, and whether they decode to the text."""
    model = pieces.PieceModel.load(public_tokenizers.path(PIECES))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return pieces.recode(model, docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.crc32(F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")).alias("ids_crc32"),
        F.col("same").alias("round_trip"),
    )


@query("op3_lm_scoring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = language_model.score(docs, ~held_out(10), public_tokenizers.path(WORD_TOKENIZER))
    return scored.withColumn("held_out", held_out(10))
