"""Hand-made cases of confidences, votes, metrics and logs."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from labelkit.functions import scores
from labelkit.operators import confidence as C
from labelkit.operators import inference as I
from labelkit.operators import metrics as M
from labelkit.operators import stats
from labelkit.operators import votes as W


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def test_softmax_is_stable_and_sums_to_one(spark):
    df = table(spark, "example_id long, logits array<double>", (1, [1000.0, 1000.0, -1000.0]), (2, [0.0, 1.0, 2.0]))
    got = {r[0]: r[1] for r in df.select("example_id", scores.softmax(F.col("logits"))).collect()}
    assert got[1] == pytest.approx([0.5, 0.5, 0.0])
    total = sum(math.exp(i) for i in range(3))
    assert got[2] == pytest.approx([math.exp(i) / total for i in range(3)])


def test_best_label_takes_the_first_of_equal_scores(spark):
    df = table(spark, "example_id long, logits array<double>", (1, [0.0, 3.0, 3.0]), (2, [9.0, 0.0, 0.0]))
    got = {r["example_id"]: r for r in C.best_label(df, {1: "a", 2: "b"}).collect()}
    assert (got[1]["token"], got[1]["label"]) == (1, "a")
    assert (got[2]["token"], got[2]["label"]) == (0, None)


def test_label_probability_outside_the_scores_is_null(spark):
    df = table(spark, "example_id long, logits array<double>", (1, [0.0, 0.0]))
    assert rows(C.label_probabilities(df, {"x": 1, "y": 9})) == [(1, 0.5, None)]


def test_theta_is_inclusive_and_empty_subset_has_no_accuracy(spark):
    conf = table(spark, "example_id long, score double", (1, 0.4), (2, 0.39), (3, 0.9))
    pred = table(spark, "example_id long, predicted string, ground_truth string", (1, "a", "a"), (2, "a", "a"), (3, "a", "b"))
    assert rows(C.auto_label_accuracy(conf, pred, 0.4)) == [(0.5, 2)]
    assert rows(C.auto_label_accuracy(conf, pred, 0.95)) == [(None, 0)]


def test_coverage_curve_equals_separate_filters(spark):
    conf = spark.range(200).select(F.col("id").alias("example_id"), (F.col("id") / 200).alias("score"))
    pred = spark.range(180).select(
        F.col("id").alias("example_id"), F.lit("a").alias("predicted"), F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("ground_truth")
    )
    grid = C.threshold_grid() + [0.995, 2.0]
    curve = {r["theta"]: r for r in C.coverage_curve(conf, pred, grid).collect()}
    assert len(curve) == len(grid)
    for theta in grid:
        acc, n = rows(C.auto_label_accuracy(conf, pred, theta))[0]
        assert curve[theta]["kept"] == n and curve[theta]["coverage"] == n / 200
        assert curve[theta]["accuracy"] == (pytest.approx(acc) if n else None)


def test_threshold_grid_ends():
    grid = C.threshold_grid()
    assert len(grid) == 20 and grid[0] == 0.1 and grid[-1] == 0.77


def test_confidence_sorts_numbers_not_text(spark):
    df = table(spark, "example_id long, score double", (1, 9e-05), (2, 0.5), (3, 0.5))
    assert rows(C.rank_by_confidence(df).select("rank", "example_id")) == [(1, 1), (2, 2), (3, 3)]
    assert rows(C.rank_by_confidence(df, ascending=False).select("rank", "example_id")) == [(1, 2), (2, 3), (3, 1)]


def test_sequence_tokens_stay_in_step_order(spark):
    df = table(
        spark, "example_id long, step int, logits array<double>", (1, 10, [0.0, 9.0]), (1, 2, [9.0, 0.0]), (1, 0, [0.0, 1.0])
    ).repartition(3)
    (row,) = C.sequence_confidence(df).collect()
    assert row["tokens"] == [1, 0, 1]


def test_vote_tie_goes_to_the_first_seen_label(spark):
    votes = table(
        spark, "example_id long, label string, ord int", (1, "b", 0), (1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "z", 5), (2, "y", 4)
    ).repartition(5)
    assert rows(W.majority_vote(votes, "ord")) == [(1, "b", 2, 4), (2, "y", 1, 2)]


def test_ensemble_disagreement_goes_to_the_model(spark):
    ratings = table(
        spark, "rater string, example_id long, predicted string, ground_truth string",
        ("m", 1, "1", "2"), ("a", 1, "2", "2"), ("b", 1, "3", "2"),
        ("m", 2, "1", "2"), ("a", 2, "2", "2"), ("b", 2, "2", "2"),
        ("m", 3, "1", "2"), ("a", 3, "2", "2"),
    )
    assert rows(W.rater_ensemble(ratings, ["m", "a", "b"], "a")) == [(1, "1", "2", 1), (2, "2", "2", 2)]


def test_second_row_of_a_rater_is_an_error(spark):
    ratings = table(
        spark, "rater string, example_id long, predicted string, ground_truth string", ("a", 1, "1", "2"), ("a", 1, "2", "2")
    )
    with pytest.raises(Exception, match="several rows of rater a"):
        W.align_raters(ratings, ["a"]).collect()
    assert rows(W.align_raters(ratings, ["a"], strict=False)) == [(1, "2", "2")]


def test_truth_conflicts_are_null_safe(spark):
    ratings = table(
        spark, "rater string, example_id long, predicted string, ground_truth string",
        ("a", 1, "1", None), ("b", 1, "1", None), ("a", 2, "1", None), ("b", 2, "1", "x"),
    )
    master = table(spark, "example_id long, label string", (1, None), (2, "x"))
    assert [r[0] for r in rows(W.truth_conflicts(ratings, master, ["a", "b"]))] == [2]


def test_missing_prediction_counts_as_wrong(spark):
    df = table(spark, "example_id long, predicted string, ground_truth string", (1, None, "a"), (2, "a", "a"))
    assert rows(M.accuracy(df)) == [(0.5, 2)]


def test_r2_of_constant_truth_is_null(spark):
    df = table(spark, "predicted string, ground_truth string", ("1", "2"), ("3", "2"))
    assert rows(M.regression_scores(df)) == [(1.0, None)]


def test_trial_summary_uses_population_deviation(spark):
    df = table(spark, "run string, trial int, accuracy double", ("r", 2, 0.5), ("r", 1, 1.0)).repartition(2)
    (row,) = M.trial_summary(df).collect()
    assert row["accuracies"] == [1.0, 0.5] and row["avg_acc"] == 0.75 and row["std"] == 0.25


def test_cross_entropy_ignores_masked_positions(spark):
    df = table(spark, "example_id long, logits array<double>, target int", (1, [0.0, 0.0], 1), (1, [0.0, 50.0], -100))
    loss, n = rows(M.cross_entropy(df))[0]
    assert loss == pytest.approx(math.log(2)) and n == 1


def expected_stop(values, patience):
    best, wait = math.inf, 0
    for i, v in enumerate(values, 1):
        if v < best:
            best, wait = v, 0
        else:
            wait += 1
            if wait >= patience:
                return i
    return None


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_early_stop_for_any_block_size(spark, block):
    import random

    draw = random.Random(block)
    runs = {r: [draw.randint(0, 30) / (1 + i / 10) for i in range(draw.randint(1, 40))] for r in range(12)}
    runs[50] = [float(-i) for i in range(30)]  # always better
    runs[51] = [1.0] * 30  # never better
    log = [(r, 10 * i, "val_loss", float(v)) for r, vs in runs.items() for i, v in enumerate(vs)]
    df = table(spark, "run_id long, step long, metric string, value double", *log).repartition(4)
    for patience in (1, 4):
        got = {r["run_id"]: r for r in M.early_stop_point(df, patience, block=block).collect()}
        for r, vs in runs.items():
            want = expected_stop(vs, patience)
            assert got[r]["stop_check"] == want and got[r]["n_checks"] == len(vs)
            assert got[r]["stop_step"] == (None if want is None else 10 * (want - 1))


def test_best_checkpoint_is_the_earliest_minimum(spark):
    df = table(spark, "run_id long, step long, metric string, value double", (1, 5, "val_loss", 0.1), (1, 3, "val_loss", 0.1), (1, 1, "x", 0.0))
    assert rows(M.best_checkpoint(df)) == [(1, 3, 0.1)]


def test_class_weights_with_and_without_broadcast(spark, examples, monkeypatch):
    few = rows(stats.class_weights(examples).select("example_id", "weight"))
    monkeypatch.setattr(stats, "SMALL_SIDE_ROWS", 1)
    assert rows(stats.class_weights(examples).select("example_id", "weight")) == few
    assert len(few) == 360


def test_label_shares_leave_nulls_out(spark, examples):
    shares = stats.label_distribution(examples, normalize=True).collect()
    assert [r["label"] for r in shares] == ["common", "rare"]
    assert sum(r["share"] for r in shares) == pytest.approx(1.0)


def test_sampled_labels_follow_the_tempered_distribution(spark):
    df = table(spark, "example_id long, logits array<double>", (1, [0.0, 1.0, 0.5, -3.0]))
    n = 4000
    got = {r["token"]: r["count"] for r in I.sample_labels(df, n, seed=1, temperature=0.5, top_k=3).groupBy("token").count().collect()}
    weights = {0: math.exp(0), 1: math.exp(2), 2: math.exp(1)}
    assert set(got) == set(weights) and sum(got.values()) == n
    for token, w in weights.items():
        p = w / sum(weights.values())
        assert abs(got[token] - n * p) < 4 * math.sqrt(n * p * (1 - p))


def test_sampling_one_of_one(spark):
    df = table(spark, "example_id long, logits array<double>", (1, [0.0, 1.0]), (2, [3.0, 1.0]))
    assert rows(I.sample_labels(df, 2, seed=1, top_k=1)) == [(1, 0, 1), (1, 1, 1), (2, 0, 0), (2, 1, 0)]
