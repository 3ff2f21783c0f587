"""Licence scans by diagonal voting; DataFrame operations only.

Word n-grams of all texts are hashed in place and joined to the positions of the same
n-grams in a small, fixed set of templates.  Hits of a template with equal offset (document
position minus template position) lie on a diagonal; neighbouring diagonals, as an inserted
or a lost word makes them, are merged; a span counts if enough of the template is there.
Short phrases need all of their n-grams on one diagonal.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelkit.llm.common import ascii_lower, bind

# Phrases whose places are counted, with their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Customary notices, in lower case without punctuation.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
]
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHORT, LONG = 2, 3  # words per n-gram of phrases and of notices
NEIGHBOURS = 3  # diagonals this close are one, if closer than the template is long
COVERAGE = 0.7


def words_of(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z as a-z."""
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def gram(words: Column, i: Column, n: int) -> Column:
    """Hash of ``n`` words from position ``i``; null past the end of the text."""
    own = [F.get(words, i + j) for j in range(n)]
    return F.when(own[-1].isNotNull(), F.xxhash64(F.lit(n), *own))


def template_grams(spark: SparkSession) -> DataFrame:
    """One row per n-gram of a template; as many as the templates have words at most."""
    texts = [(t, label, True) for t, label in PHRASES] + [(t, label, False) for t, label in NOTICES]
    rows = [(k, re.sub(" +", " ", t), label, phrase) for k, (t, label, phrase) in enumerate(texts)]
    table = spark.createDataFrame(rows, "template int, text string, label string, phrase boolean")
    words = table.withColumn("words", words_of(F.col("text"))).withColumn("n_template", F.size("words"))
    grams = words.select("*", F.posexplode("words").alias("at", "word"))
    short, long = gram(F.col("words"), F.col("at"), SHORT), gram(F.col("words"), F.col("at"), LONG)
    size = F.when(F.col("phrase"), SHORT).otherwise(LONG)
    return (
        grams.withColumns({"t_short": short, "t_long": long, "n_grams": F.col("n_template") - size + 1})
        .filter(F.when(F.col("phrase"), F.col("t_short")).otherwise(F.col("t_long")).isNotNull())
        .select("template", "label", "phrase", "n_template", "n_grams", "at", "t_short", "t_long")
    )


def votes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Hits by template and diagonal: ``(doc_id, text_hash, template, ..., diagonal, at)``."""
    source = F.coalesce(F.col(text), F.lit(""))

    def grams(words: Column) -> Column:
        return F.transform(words, lambda _, i: F.struct(i.alias("pos"), gram(words, i, SHORT).alias("short"), gram(words, i, LONG).alias("long")))

    rows = docs.select("doc_id", F.xxhash64(source).alias("text_hash"), F.inline(bind(words_of(source), grams)))
    known = F.broadcast(template_grams(docs.sparkSession))
    same = (F.col("short") == F.col("t_short")) & (F.col("phrase") | (F.col("long") == F.col("t_long")))
    hits = rows.join(known, same)
    return hits.select("doc_id", "text_hash", "template", "label", "phrase", "n_template", "n_grams", (F.col("pos") - F.col("at")).alias("diagonal"), "at").distinct()


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Verified spans ``(doc_id, text_hash, label, phrase, start, end, score)`` in words."""
    key = ["doc_id", "text_hash", "template", "label", "phrase", "n_template", "n_grams"]
    diagonals = votes(docs, text).groupBy(*key, "diagonal").agg(F.collect_set("at").alias("seen"))
    phrases = diagonals.filter(F.col("phrase") & (F.size("seen") == F.col("n_grams")))
    exact = phrases.select("doc_id", "text_hash", "label", "phrase", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("n_template")).alias("end"), F.lit(1.0).alias("score"))
    order = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > F.least(F.lit(NEIGHBOURS), F.col("n_template") - 1), F.lit(True))
    runs = diagonals.filter(~F.col("phrase")).withColumn("far", far.cast("int")).withColumn("run", F.sum("far").over(order))
    merged = runs.groupBy(*key, "run").agg(
        F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"),
        F.min(F.col("diagonal") + F.array_min("seen")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("seen") + LONG).alias("end"),
    )
    score = F.size("seen") / F.col("n_grams")
    # enough of the template, and no more words around it than it has itself
    near = merged.filter((score >= COVERAGE) & (F.col("end") - F.col("start") <= 2 * F.col("n_template")))
    return exact.unionByName(near.select("doc_id", "text_hash", "label", "phrase", "start", "end", F.least(score, F.lit(1.0)).alias("score")))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row of ``docs`` its number of words and the list of licence spans found in it.

    A null or empty text has no words and no spans.  Repeated rows all get the same spans;
    rows without an id are told apart by their texts.
    """
    found = spans(docs, text).groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("label", "phrase", "start", "end", "score")).alias("spans")
    )
    source = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(source).alias("hash"), F.size(words_of(source)).cast("long").alias("n_words"))
    found = found.withColumnsRenamed({"doc_id": "__doc"})
    met = rows.join(found, rows["doc_id"].eqNullSafe(F.col("__doc")) & (F.col("hash") == F.col("text_hash")), "left")
    return met.select("doc_id", "n_words", F.coalesce("spans", F.array()).alias("spans"))
