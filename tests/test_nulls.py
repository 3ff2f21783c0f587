"""NULL, malformed and odd input loses no row and spoils no figure."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import registry, scoring  # noqa: F401
from labelkit.operators import confidence as C
from labelkit.operators import inference as I
from labelkit.operators import metrics as M
from labelkit.operators import stats
from labelkit.operators.ranks import ordered_rank
from labelkit.operators.splits import SplitSpec, source_pool
from labelkit.sources import tables
from tests.conftest import SMALL


def test_best_checkpoint_is_a_number(spark):
    log = spark.createDataFrame([("a", 1, 0.5), ("a", 2, None), ("a", 3, 0.2), ("a", 4, float("nan"))], "run_id string, step int, value double")
    assert [tuple(r) for r in M.best_checkpoint(log.withColumn("metric", F.lit("val_loss"))).collect()] == [("a", 3, 0.2)]


def test_epoch_loss_weighs_values_only(spark):
    log = spark.createDataFrame([(1, 0, "m", 0.35, 2), (1, 0, "m", None, 1), (2, 0, "m", 1.0, 0)], "run_id int, epoch int, metric string, value double, w int")
    assert sorted((r["run_id"], r["mean_value"], r["n_steps"]) for r in stats.epoch_loss(log, "w").collect()) == [(1, 0.35, 2), (2, None, 1)]


def test_regression_of_text_and_nulls(spark):
    df = spark.createDataFrame([("1", "1"), (None, "9"), ("3", "2"), ("x", "5")], "predicted string, ground_truth string")
    row = M.regression_scores(df).first()
    assert (row["mse"], row["r2"]) == (0.5, -1.0)


def test_cross_entropy_counts_what_it_averages(spark):
    df = spark.createDataFrame([([0.0, 0.0], 1), ([0.0, 0.0], 7)], "logits array<double>, target int")
    row = M.cross_entropy(df).first()
    assert row["n_positions"] == 1 and row["loss"] == pytest.approx(np.log(2))


def test_ranks_keep_null_groups_and_put_null_scores_last(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), (None, 2)], "g string, x int")
    assert sorted((str(r["g"]), r["x"], r["rank"]) for r in ordered_rank(df, ["x"], ["g"]).collect()) == [("None", 1, 1), ("None", 2, 2), ("a", 1, 1)]
    scores = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.9)], "example_id long, score double")
    for ascending, order in ((True, [1, 3, 2]), (False, [3, 1, 2])):
        found = C.rank_by_confidence(scores, ascending).orderBy("rank").collect()
        assert [r["example_id"] for r in found] == order


def test_row_key_keeps_null_order_values(spark):
    df = spark.createDataFrame([(None, "x"), (1, "y"), (2, "z")], "k int, v string")
    assert sorted(r["example_id"] for r in tables.with_row_key(df, ["k"]).collect()) == [0, 1, 2]


def test_broken_files_raise(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"m": {"index": [1, 2], "predicted": ["a"], "ground_truth": ["a", "b"]}}\n')
    with pytest.raises(Exception, match="unequal length"):
        tables.read_raters(spark, str(tmp_path / "r.json"), ["m"]).collect()
    (tmp_path / "s.json").write_text("{broken\n")
    with pytest.raises(Exception):
        tables.read_raters(spark, str(tmp_path / "s.json"), ["m"]).collect()


def test_short_model_output_raises(spark):
    df = spark.createDataFrame([(1, "t")], "example_id long, input_text string")
    with pytest.raises(Exception, match="must give 6 scores"):
        I.predict_scores(df, lambda: lambda texts: np.zeros((len(texts), 4)), steps=2, classes=3).collect()


def test_source_pool_uses_every_row_by_default(examples):
    spec = SplitSpec(task_ids=[0, 1, 2], test_frac=0.2, val_frac=0.1)
    assert source_pool(examples, spec).count() == spec.select(examples).count()


def test_label_probabilities_are_of_the_full_softmax(spark):
    rows = registry.QUERIES["label_probabilities"](spark, SMALL).collect()
    sums = [sum(r[f"p_{i}"] for i in range(1, 6)) for r in rows]
    assert len(rows) == 500 and np.mean(sums) < 0.5 and max(sums) <= 1.000001
