"""Removal of lines that many documents share; DataFrame operations only.

Only hashes of long lines are exploded and shuffled.  Counting combines on the map side.
The few lines that make up a notable share of all rows are met by a broadcast, all others
by a shuffle on the hash.  What goes back to a document is a list of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import ascii_lower, bind, join_counted, unused
from labelkit.session import stage_table

BLANKS = " \t\n\x0b\x0c\r"
KEY = ["__h1", "__h2"]


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z as a-z."""
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def shared_lines(docs: DataFrame, text: str, min_chars: int, min_docs: int) -> DataFrame:
    """Positions ``(doc_id, __text, __dropped)`` of the lines that each document loses."""
    lines = docs.select(
        F.col("doc_id"), F.xxhash64(text).alias("__text"), F.posexplode(F.split(F.col(text), "\n")).alias("__pos", "__line")
    )
    long = lines.withColumn("__key", F.trim("__line", F.lit(BLANKS))).filter(F.length("__key") >= min_chars)
    key = ascii_lower(F.col("__key"))
    # 128 bits: at 10^12 lines, 64 would take different lines for the same
    rows = stage_table(
        long.select("doc_id", "__text", "__pos", F.xxhash64(key).alias("__h1"), F.xxhash64(F.lit("line"), key).alias("__h2")), "lines"
    )
    found = (
        rows.groupBy(*KEY, "doc_id")
        .agg(F.count(F.lit(1)).alias("__times"))
        .groupBy(*KEY)
        .agg(F.count("doc_id").alias("__docs"), F.max("doc_id").alias("__keeper"), F.sum("__times").alias("__rows"))
        .filter(F.col("__docs") >= min_docs)
    )
    found = stage_table(found, "shared-lines")
    hits = join_counted(rows, found, KEY, "__rows", rows.count())
    lost = hits.filter(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("__keeper")))
    return lost.groupBy("doc_id", "__text").agg(F.collect_set("__pos").alias("__dropped"))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rid of shared lines, and ``n_lines`` (before) and ``n_dropped``.

    Lines whose key has at least ``min_chars`` code points and is found in at least
    ``min_docs`` documents stay only in the document with the largest ``doc_id`` among
    them, there with all repetitions.  A null or empty text is one empty line.  Repeated
    rows of an id count as one document and are treated alike; a row without an id counts
    for nothing and loses shared lines.  Columns named ``n_lines`` or ``n_dropped`` in
    ``docs`` are replaced, all others stay as they are.
    """
    docs = docs.drop("n_lines", "n_dropped").withColumn(text, F.coalesce(F.col(text), F.lit("")))
    doc, own, dropped = unused(docs, "__doc", "__text", "__dropped")
    lost = shared_lines(docs, text, min_chars, min_docs).toDF(doc, own, dropped)
    met = docs.join(lost, docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs[text]) == F.col(own)), "left")
    lines = F.split(F.col(text), "\n")

    def without_dropped(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(dropped))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    return met.select(
        *[F.when(F.col(dropped).isNull(), F.col(text)).otherwise(bind(lines, without_dropped)).alias(text) if c == text else docs[c] for c in docs.columns],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
    )
