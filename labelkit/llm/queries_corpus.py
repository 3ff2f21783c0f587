"""Registered queries on corpus statistics and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.llm import chat, divergence, importance
from labelkit.llm.common import table
from labelkit.llm.registry import query

LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, outside: str) -> str:
    return f"regexp_extract_all({LOWER.format(text)}, '[^{outside}]+')"


WORDS = _words("text", "\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F")
TERMS = _words("text", "\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F")


@query(
    "op11_importance_resampling",
    f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT {WORDS} AS w FROM benchmark),
du AS (SELECT doc_id, unnest(w) AS word FROM d),
bu AS (SELECT unnest(w) AS word FROM b),
steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), bucketed AS (
  SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT],
             list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: ('0x' || h)::BIGINT)),
             lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM du UNION SELECT word FROM bu), steps
), s AS (SELECT bucket, count(*) AS s FROM du JOIN bucketed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bu JOIN bucketed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM du) + 10000) AS DOUBLE)
                    / CAST((s + 1) * ((SELECT count(*) FROM bu) + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
), weighed AS (
  SELECT doc_id, sum(gain) AS total FROM du JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features,
         CASE WHEN len(w) = 0 THEN 0
              ELSE CAST((total - (((total % len(w)) + len(w)) % len(w))) // len(w) AS BIGINT) END AS weight,
         CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS noise
  FROM d LEFT JOIN weighed USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) AS place FROM scored
)
SELECT doc_id, n_features, weight::BIGINT AS weight, (weight + noise)::BIGINT AS score,
       CASE WHEN n_features >= 20 AND place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20)
            THEN place END AS rank
FROM placed
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _share(count: str, n: str, v: str) -> str:
    return f"CAST(1 + (1000000000::HUGEINT * ({count} + 1)) // ({n} + {v}) AS BIGINT)"


DEPARTURE = "CAST((p::HUGEINT - q) * (p::HUGEINT - q) // q AS BIGINT)"


@query(
    "op12_source_divergence",
    f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {TERMS} AS w FROM documents
), words AS (SELECT row_id, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
c AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
dense AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n, {_share("coalesce(c.n, 0)", "n.n", "v.v")} AS p
  FROM groups JOIN v USING (lang) JOIN kept USING (lang)
  LEFT JOIN (SELECT lang, source, coalesce(n.n, 0) AS n FROM groups LEFT JOIN n USING (lang, source)) n USING (lang, source)
  LEFT JOIN c USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum({DEPARTURE.replace("p::", "a.p::").replace("- q", "- b.p").replace("// q", "// b.p")}) AS BIGINT) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), whole AS (SELECT lang, term, {_share("sum(n)", "any_value(total)", "any_value(v)")} AS q
  FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS total FROM c GROUP BY lang) USING (lang) GROUP BY lang, term),
found AS (SELECT lang, source, term AS item, {DEPARTURE} AS value FROM dense JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM found
  QUALIFY rank <= 200
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


#: Fixed value: the text of the conversation that the query adds.
ADDED = r"\### Assistant: </turn> ok"

#: Length of a text as the template writes it.
_WRITTEN = "(length({0}) + length(regexp_replace({0}, '[^<>\\\\]', '', 'g')))"


@query(
    "op13_chat_formatting",
    rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{ADDED}' UNION ALL SELECT -7, 1, 'assistant', '{ADDED}'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(16 + {_WRITTEN.format("role")} + {_WRITTEN.format("text")}) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame([(-7, 0, "user", ADDED), (-7, 1, "assistant", ADDED)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    rows = rows.withColumn("parts", F.array(chat.text_part(F.coalesce("text", F.lit("")))))
    done = chat.format_conversations(rows)
    turns = chat.read_turns(F.col("formatted"))

    def said(turn: Column) -> Column:
        text = F.array_join(F.transform(chat.read_parts(turn["body"]), lambda p: p["text"]), "")
        return F.concat(turn["role"], F.lit("\n"), text, F.lit("\n"))

    read = done.select(
        "conv_id", "formatted", turns.alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss")).alias("learnt"), "expanded_tokens"
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", said), ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
