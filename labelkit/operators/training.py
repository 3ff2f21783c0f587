"""A distributed label model: TF-IDF features and logistic regression.

This stands where a neural text-to-text model would be fine-tuned; it is a different
model, trained by Spark over the partitions of the training table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.functions.encoding import SEPARATOR
from labelkit.operators.stats import class_weights
from labelkit.session import stage_table

#: Version of the saved form.
FORMAT = 1


@dataclass(frozen=True)
class LabelModel:
    """Fitted stages, from ``input_text`` to ``_prediction``, and the labels by index."""

    stages: PipelineModel
    labels: Sequence[str]


def train_label_model(
    train: DataFrame,
    balanced: bool = True,
    features: int = 1 << 16,
    max_iter: int = 50,
    reg: float = 0.01,
    source: LabelModel | None = None,
    key: str = "example_id",
) -> LabelModel:
    """Fit on ``(key, input_text, label)``; ``balanced`` weights rows by N / count(label).

    With a ``source`` model its class probabilities become additional features.  The
    training rows are staged once, spread over all cores: every stage reads them, and the
    iterations are worth far more work than their size suggests.
    """
    rows = train.filter(F.col("label").isNotNull()).select(
        key, F.coalesce("input_text", F.lit("")).alias("input_text"), F.col("label").cast("string").alias("label")
    )
    rows = class_weights(rows, key=key) if balanced else rows.withColumn("weight", F.lit(1.0))
    cores = train.sparkSession.sparkContext.defaultParallelism
    rows = stage_table(rows.repartition(cores, key), "train")
    index = StringIndexer(inputCol="label", outputCol="_label", stringOrderType="alphabetAsc").fit(rows)
    stages = [
        *([] if source is None else _belief(source)),
        RegexTokenizer(inputCol="input_text", outputCol="_words", pattern=SEPARATOR, toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        VectorAssembler(
            inputCols=["_tfidf"] if source is None else ["_tfidf", "_belief"], outputCol="_features"
        ),
        LogisticRegression(
            featuresCol="_features",
            labelCol="_label",
            weightCol="weight",
            predictionCol="_prediction",
            probabilityCol="_probability",
            rawPredictionCol="_raw",
            maxIter=max_iter,
            regParam=reg,
        ),
    ]
    return LabelModel(Pipeline(stages=stages).fit(index.transform(rows)), index.labels)


def _belief(source: LabelModel) -> list[Transformer]:
    """The source model, with everything but its class probabilities removed again."""
    keep = SQLTransformer(
        statement="SELECT * EXCEPT (_words, _tf, _tfidf, _features, _raw, _probability, _prediction),"
        " _probability AS _belief FROM __THIS__"
    )
    nested = "SELECT * EXCEPT (_belief) FROM __THIS__"
    has_belief = any(isinstance(s, SQLTransformer) for s in source.stages.stages)
    return [source.stages, *([SQLTransformer(statement=nested)] if has_belief else []), keep]


def transfer_train(source: DataFrame, target: DataFrame, key: str = "example_id", **options) -> LabelModel:
    """Fit on source tasks, then on the target with the source model's belief as input."""
    return train_label_model(target, source=train_label_model(source, key=key, **options), key=key, **options)


def apply_label_model(model: LabelModel, df: DataFrame, key: str = "example_id") -> DataFrame:
    """``(key, predicted, ground_truth)`` for any rows, labelled or not."""
    rows = df.select(key, F.coalesce("input_text", F.lit("")).alias("input_text"), F.col("label").cast("string").alias("_truth"))
    names = F.array(*[F.lit(n) for n in model.labels])
    return model.stages.transform(rows).select(
        key,
        F.get(names, F.col("_prediction").cast("int")).alias("predicted"),
        F.col("_truth").alias("ground_truth"),
    )


def save_label_model(spark: SparkSession, model: LabelModel, path: str) -> None:
    """Stages and labels as one bundle; its document is written last, so a bundle that has it is whole."""
    model.stages.save(f"{path}/stages")
    document = json.dumps({"format": FORMAT, "labels": list(model.labels)})
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/model")


def load_label_model(spark: SparkSession, path: str) -> LabelModel:
    """A saved bundle; an unknown version ends with an error."""
    document = json.loads(spark.read.text(f"{path}/model").first()["value"])
    if document["format"] != FORMAT:
        raise ValueError(f"format {document['format']} of a model is not known")
    return LabelModel(PipelineModel.load(f"{path}/stages"), document["labels"])
