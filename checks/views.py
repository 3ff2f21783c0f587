"""The example views of FIXTURES.md, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.functions.keys import hash_int
from labelkit.operators.ranks import ordered_rank

# Class position of each ordinal label in the score arrays.
LABEL2ID = {"1": 3, "2": 17, "3": 29, "4": 41, "5": 60}
ID2LABEL = {i: label for label, i in LABEL2ID.items()}
LABEL_SQL = "CASE {} " + " ".join(f"WHEN {i} THEN '{label}'" for i, label in ID2LABEL.items()) + " END"

RATERS = ["model", "a", "b"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    task = F.substring("source", 4, 9).cast("int")
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select(
            F.col("doc_id").alias("example_id"),
            task.alias("task_id"),
            F.when(task < 10, "SRC").otherwise("TRG").alias("dataset_type"),
            F.col("lang").alias("dataset"),
            F.col("text").alias("input_text"),
            F.col("quality").cast("string").alias("label"),
        )
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master(spark, sf_dir).filter(F.col("label").isNotNull())


def _flipped(label):
    return F.when(label == "1", "0").otherwise("1")


def predictions(spark: SparkSession, sf_dir: str, salt: str = "p") -> DataFrame:
    wrong = hash_int(F.concat(F.lit(f"{salt}:"), F.col("example_id").cast("string"))) % 10 < 2
    label = F.col("label")
    return labelled(spark, sf_dir).select(
        "example_id",
        F.when(wrong, _flipped(label)).otherwise(label).alias("predicted"),
        label.alias("ground_truth"),
    )


def raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("example_id").cast("string")
    flip = (F.col("rater") == "b") & (hash_int(F.concat(F.lit("t:"), key)) % 50 == 0)
    return (
        labelled(spark, sf_dir)
        .select("example_id", "label", F.explode(F.array(*[F.lit(r) for r in RATERS])).alias("rater"))
        .select(
            "rater",
            "example_id",
            (hash_int(F.concat("rater", F.lit(":"), key)) % 3).cast("string").alias("predicted"),
            F.when(flip, _flipped(F.col("label"))).otherwise(F.col("label")).alias("ground_truth"),
        )
    )


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("example_id"), F.col("event_type").alias("label"), F.col("ts").alias("order")
    )


def digit_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    digit = F.floor("value") % 6
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("example_id"),
        F.when(digit == 0, "x").otherwise(digit.cast("string")).alias("label"),
        F.col("ts").alias("order"),
        (1 + F.col("user_id") % 5).cast("string").alias("ground_truth"),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("example_id"),
        F.transform("embedding", lambda z: z.cast("double") * 40).alias("logits"),
        F.element_at(F.array(*map(F.lit, LABEL2ID.values())), F.col("label") % 5 + 1).alias("target"),
    )


def step_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logits(spark, sf_dir).select(
        F.floor(F.col("example_id") / 8).alias("example_id"),
        (F.col("example_id") % 8).alias("step"),
        "logits",
        "target",
    )


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "ts", F.col("event_type").alias("metric"), "value"
    )
    return ordered_rank(events, ["ts"], ["run_id"], "step").select(
        "run_id", "step", F.floor((F.col("step") - 1) / 10).alias("epoch"), "metric", "value"
    )


def h(text: str, digits: int = 7) -> str:
    """SQL of the leading hex digits of md5 as BIGINT."""
    return f"('0x' || substr(md5({text}), 1, {digits}))::BIGINT"


SQL = {
    "master": """
        SELECT d.doc_id AS example_id, CAST(substr(d.source, 4) AS BIGINT) AS task_id,
               CASE WHEN CAST(substr(d.source, 4) AS BIGINT) < 10 THEN 'SRC' ELSE 'TRG' END AS dataset_type,
               d.lang AS dataset, d.text AS input_text, CAST(l.quality AS VARCHAR) AS label
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "labelled": "SELECT * FROM master WHERE label IS NOT NULL",
    "predictions": f"""
        SELECT example_id, CASE WHEN {h("'p:' || example_id")} % 10 < 2
                                THEN CASE label WHEN '1' THEN '0' ELSE '1' END ELSE label END AS predicted,
               label AS ground_truth
        FROM labelled""",
    "raters": f"""
        SELECT rater, example_id, CAST({h("rater || ':' || example_id")} % 3 AS VARCHAR) AS predicted,
               CASE WHEN rater = 'b' AND {h("'t:' || example_id")} % 50 = 0
                    THEN CASE label WHEN '1' THEN '0' ELSE '1' END ELSE label END AS ground_truth
        FROM labelled, (SELECT unnest(['model', 'a', 'b']) AS rater)""",
    "votes": 'SELECT user_id AS example_id, event_type AS label, ts AS "order" FROM events',
    "digit_votes": """
        SELECT user_id AS example_id,
               CASE WHEN CAST(floor(value) AS BIGINT) % 6 = 0 THEN 'x'
                    ELSE CAST(CAST(floor(value) AS BIGINT) % 6 AS VARCHAR) END AS label,
               ts AS "order", CAST(1 + user_id % 5 AS VARCHAR) AS ground_truth
        FROM events""",
    "logits": """
        SELECT vec_id AS example_id, list_transform(embedding, lambda z: CAST(z AS DOUBLE) * 40) AS logits,
               [3, 17, 29, 41, 60][label % 5 + 1] AS target
        FROM embeddings""",
    "step_logits": """
        SELECT example_id // 8 AS example_id, example_id % 8 AS step, logits, target FROM logits""",
    "metric_log": """
        SELECT run_id, step, (step - 1) // 10 AS epoch, metric, value
        FROM (SELECT user_id AS run_id, event_type AS metric, value,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts) AS step FROM events)""",
    # Confidence of each example and the predictions they belong to.
    "confidence": f"""
        SELECT example_id, list_position(logits, list_max(logits)) - 1 AS token,
               {LABEL_SQL.format("list_position(logits, list_max(logits)) - 1")} AS label,
               1e0 / list_sum(list_transform(logits, lambda z: exp(z - list_max(logits)))) AS score
        FROM logits""",
    "judged": f"""
        SELECT c.example_id, c.label AS predicted, {LABEL_SQL.format("l.target")} AS ground_truth
        FROM confidence c JOIN logits l ON l.example_id = c.example_id""",
}

_NEEDS = {
    "labelled": ["master"],
    "predictions": ["labelled"],
    "raters": ["labelled"],
    "step_logits": ["logits"],
    "confidence": ["logits"],
    "judged": ["confidence", "logits"],
}


def with_views(body: str, *names: str, **extra: str) -> str:
    """``WITH`` the named views and what they need, then ``extra`` queries, then ``body``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({SQL[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
