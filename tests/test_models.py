"""Model application and training on a small separable corpus."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from labelkit.operators import inference as I
from labelkit.operators import training as TR
from labelkit.operators.metrics import accuracy
from labelkit.operators.splits import SplitSpec
from labelkit.plans.experiments import target_experiment, transfer_experiment


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.sql(
        """SELECT id AS example_id, CAST(id % 2 AS INT) AS task_id, IF(id % 2 = 0, 'SRC', 'TRG') AS dataset_type,
                  'en' AS dataset, IF(id % 5 = 0, 'No', 'Yes') AS label,
                  concat('w', id, IF(id % 5 = 0, ' bad awful', ' good nice')) AS input_text
           FROM range(120)"""
    )


def test_predict_counts_loads_and_keeps_columns(spark, corpus):
    def load():
        import numpy as np

        return lambda texts: np.array(["No" if "bad" in t else "Yes" for t in texts], dtype=object)

    got = I.predict(corpus, load, batch_size=16, keep=["task_id"])
    assert got.columns == ["example_id", "predicted", "ground_truth", "task_id"]
    assert accuracy(got).first()["accuracy"] == 1.0


def test_scores_are_keyed_by_step(spark, corpus):
    def load():
        import numpy as np

        return lambda texts: np.array([[len(t), 1.0, 2.0, 3.0] for t in texts])

    got = I.predict_scores(corpus, load, steps=2, classes=2)
    row = got.filter("example_id = 7 AND step = 1").first()
    assert row["logits"] == [2.0, 3.0] and got.count() == 240


def test_label_model_learns(spark, corpus):
    train, test = corpus.filter("example_id < 90"), corpus.filter("example_id >= 90")
    model = TR.train_label_model(train, features=1 << 10, max_iter=15)
    assert list(model.labels) == ["No", "Yes"]
    assert accuracy(TR.apply_label_model(model, test)).first()["accuracy"] == 1.0
    unlabelled = test.withColumn("label", F.lit(None).cast("string"))
    assert TR.apply_label_model(model, unlabelled).filter("predicted IS NULL").count() == 0


def test_transfer_from_another_task(spark, corpus):
    out = transfer_experiment(
        corpus, SplitSpec(task_ids=[0]), SplitSpec(task_ids=[1]), labeled=20, features=1 << 10
    )
    assert accuracy(out).first()["n_examples"] == 12
    assert accuracy(out).first()["accuracy"] > 0.9


def test_target_experiment_scores_every_trial(spark, corpus):
    def load():
        import numpy as np

        return lambda texts: np.array(["Yes"] * len(texts), dtype=object)

    (row,) = target_experiment(corpus, SplitSpec(dataset="en", test_frac=0.3), 3, load, "r").collect()
    assert len(row["accuracies"]) == 3 and 0.5 < row["avg_acc"] < 1.0
