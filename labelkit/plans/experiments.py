"""The experiments: one target over trials, source to target, self-training, confidence study."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.operators.bayes import BayesModel, fit_bayes, predict_bayes
from labelkit.operators.confidence import (
    auto_label_accuracy,
    best_label,
    coverage_curve,
    first_step_scores,
    threshold_grid,
)
from labelkit.operators.inference import Model, predict
from labelkit.operators.metrics import accuracy, trial_summary
from labelkit.operators.relations import confident, keep_keys, minus_keys, union_examples
from labelkit.operators.splits import SplitSpec, pseudo_split, review_partition, source_pool, trial_splits
from labelkit.operators.training import apply_label_model, transfer_train
from labelkit.session import stage_table


def target_experiment(
    df: DataFrame, spec: SplitSpec, trials: int, load: Callable[[], Model], run: str, key: str = "example_id"
) -> DataFrame:
    """Split, predict and score one target over seeded trials: one summary row.

    All trials share one plan.  An example that several trials test is predicted once.
    """
    tested = trial_splits(df, spec, trials, key).filter(F.col("split") == "test")
    needed = tested.groupBy(key).agg(F.collect_set("trial").alias("_trials"))  # at most `trials` per example
    scored = predict(df.join(needed, key), load, key=key, keep=["_trials"])
    scored = scored.withColumn("trial", F.explode("_trials"))
    results = accuracy(scored, ["trial"]).select(F.lit(run).alias("run"), "trial", "accuracy")
    return trial_summary(results)


def transfer_experiment(
    df: DataFrame,
    source: SplitSpec,
    target: SplitSpec,
    labeled: int,
    example_threshold: int | None = None,
    key: str = "example_id",
    **options,
) -> DataFrame:
    """Train on a source pool, then on a few labelled target rows; predictions of the test set."""
    pool = source_pool(df, source, example_threshold, key=key)
    splits = pseudo_split(df, target, labeled, key=key)
    model = transfer_train(
        pool.filter(F.col("split") == "train"),
        splits.filter(F.col("split") == "train_labeled"),
        key=key,
        **options,
    )
    return apply_label_model(model, splits.filter(F.col("split") == "test"), key)


def transfer_trials(
    df: DataFrame,
    source: SplitSpec,
    target: SplitSpec,
    trials: int,
    run: str,
    source_weight: float = 0.1,
    alpha: float = 1.0,
    key: str = "example_id",
) -> DataFrame:
    """Source to target over seeded trials: per run the accuracies, their mean and deviation.

    The source model is fitted once.  The trial is a dimension of the target fit: one scan
    counts for the models of all trials, and an example that several trials test is read
    once and scored by each.
    """
    pool = source_pool(df, source, key=key).filter(F.col("split") == "train")
    prior = fit_bayes(pool, alpha)
    splits = stage_table(trial_splits(df, target, trials, key), "trials")
    texts = target.select(df).select(key, "input_text", "label")
    train = splits.filter(F.col("split") == "train").join(texts, key)
    model = fit_bayes(train, alpha, ["trial"], prior, source_weight)
    tested = splits.filter(F.col("split") == "test").select("trial", key)
    scored = predict_bayes(model, keep_keys(texts, tested, key), key=key)
    results = accuracy(scored.join(tested, ["trial", key], "left_semi"), ["trial"])
    return trial_summary(results.select(F.lit(run).alias("run"), "trial", "accuracy"))


@dataclass(frozen=True)
class SelfTraining:
    """The last model, and ``pseudo (key, round, predicted, ground_truth, score, margin)``."""

    model: BayesModel
    pseudo: DataFrame
    rounds: int


def self_training(
    labeled: DataFrame,
    unlabeled: DataFrame,
    theta: float,
    max_rounds: int = 10,
    alpha: float = 1.0,
    by: str = "margin",
    key: str = "example_id",
) -> SelfTraining:
    """Label the confident rows of the pool, learn from them as well, and go on with the others.

    A round scores what is still unlabelled and keeps the rows whose ``by`` (``margin``, the
    log odds per token, or ``score``, the probability) reaches ``theta``; their counts are
    added to the model, which reads the new rows only.  It ends when a round finds none, or
    after ``max_rounds``.  The kept rows of each round are written.
    """
    model = fit_bayes(labeled, alpha)
    pool = unlabeled.select(key, "input_text", "label")
    found: list[DataFrame] = []
    empty = None
    while len(found) < max_rounds:
        left = minus_keys(pool, union_examples(found), key) if found else pool
        scored = predict_bayes(model, left, key=key, keep=["input_text"])
        sure = confident(scored, theta, by).withColumn("round", F.lit(len(found) + 1))
        sure = stage_table(sure, f"pseudo-{len(found) + 1}")
        if sure.isEmpty():
            empty = sure
            break
        found.append(sure)
        model = fit_bayes(sure, alpha, source=model, source_weight=1.0, label="predicted")
    every = union_examples(found) if found else empty
    columns = [key, "round", "predicted", "ground_truth", "score", "margin"]
    return SelfTraining(model, every.select(*columns), len(found))


@dataclass(frozen=True)
class ConfidenceStudy:
    confidence: DataFrame
    review: DataFrame
    auto_labeled: DataFrame
    curve: DataFrame


def confidence_study(
    step_scores: DataFrame,
    predictions: DataFrame,
    id2label: Mapping[int, str],
    theta: float = 0.4,
    thresholds: Sequence[float] | None = None,
    review_size: int = 1000,
    seed: int = 1,
    key: str = "example_id",
) -> ConfidenceStudy:
    """Confidence per example, the review sets, the auto-label score and the coverage curve."""
    confidence = best_label(first_step_scores(step_scores), id2label, key=key)
    return ConfidenceStudy(
        confidence=confidence,
        review=review_partition(confidence, confidence, review_size, seed, key),
        auto_labeled=auto_label_accuracy(confidence, predictions, theta, key),
        curve=coverage_curve(confidence, predictions, thresholds or threshold_grid(), key),
    )
