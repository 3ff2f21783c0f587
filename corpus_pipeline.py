"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of
``documents``.  ``run`` writes the result of each stage as Parquet to the shared folder and
reads it again, so a stage that fails can be repeated by itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.llm import language, line_dedup, ngram_join, packing, personal_data
from labelkit.llm.common import table
from labelkit.session import stage_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates: five words and a Jaccard similarity of 4 / 5 or more.
NEAR = {"k": 5, "num": 4, "den": 5}
TOKENIZER = "word_bpe_49k.json"
#: Ids from here on stand for rows without one; ids of documents are smaller.
NO_ID = 1 << 62


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` with ``n_chars`` of the text as it is now."""
    length: Column = F.length("text").cast("long")
    return docs.withColumn("n_chars", length).select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (null text or no letters); ``lang`` becomes the prediction."""
    found = language.identify(docs, language.fit(docs)).filter("lang_pred <> 'und'")
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents share stay in one of them; no document goes."""
    return _counted(line_dedup.line_dedup(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; texts without words all stay.

    Rows without an id are members of their groups as well and come behind all ids; of
    repeated rows with one id and text one stays.
    """
    spare = F.lit(NO_ID) + F.xxhash64("text").bitwiseAND(F.lit(NO_ID - 1))  # equal texts get equal ones
    named = docs.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), spare))
    # written: the join runs once, and the planner knows how few ids are repeated
    kept = stage_table(ngram_join.near_groups(named, **NEAR).filter("doc_id = component_id").select("doc_id").distinct(), "kept-ids")
    repeated = stage_table(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "repeated-ids")
    again = named.join(stage_table(kept.join(repeated, "doc_id", "left_semi"), "kept-repeated-ids"), "doc_id", "left_semi")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    once = again.filter(worded).dropDuplicates(["doc_id", "text"]).unionByName(again.filter(~worded))
    single = named.join(kept.join(repeated, "doc_id", "left_anti"), "doc_id", "left_semi")
    every = single.unionByName(once)
    return every.withColumn("doc_id", F.when(F.col("doc_id") < NO_ID, F.col("doc_id"))).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind in brackets; no document goes."""
    return _counted(personal_data.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence of 4,096 tokens."""
    pieces = packing.encode_pieces(docs, public_tokenizers.path(TOKENIZER))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("personal_data", redact_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: Code lengths of context trees, boosted trees and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
