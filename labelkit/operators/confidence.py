"""From class scores to confidences, auto-labels and the coverage curve."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.functions import scores as S
from labelkit.operators.metrics import accuracy
from labelkit.operators.ranks import lowest, ordered_rank
from labelkit.operators.relations import confident, keep_keys
from labelkit.session import SMALL_SIDE_ROWS, stage_table


def threshold_grid(start: float = 0.1, stop: float = 0.77, count: int = 20) -> list[float]:
    """Evenly spaced thresholds, both ends included."""
    step = (stop - start) / (count - 1)
    return [start + i * step for i in range(count - 1)] + [stop]


def label_of(token: Column, id2label: Mapping[int, str]) -> Column:
    """Label of a token id; NULL for an unknown id."""
    pairs = chain.from_iterable((F.lit(i), F.lit(str(label))) for i, label in sorted(id2label.items()))
    return F.try_element_at(F.create_map(*pairs), token)


def best_label(
    df: DataFrame,
    id2label: Mapping[int, str],
    logits: str = "logits",
    key: str = "example_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(key, token, label, score, *keep)``: the most probable class, its label and probability."""
    token, score = S.best_of(F.col(logits), S.is_sparse(df, logits))
    return df.select(
        key,
        token.alias("token"),
        label_of(token, id2label).alias("label"),
        score.alias("score"),
        *keep,
    )


def label_probabilities(
    df: DataFrame, label2id: Mapping[str, int], logits: str = "logits", key: str = "example_id", prefix: str = "p_"
) -> DataFrame:
    """One column per named label with its probability under the full softmax.

    A sparse row gives NULL for a label that it does not hold.
    """
    z, norm = F.col(logits), F.col("_norm")
    if S.is_sparse(df, logits):
        held = [F.exp(S.score_at(z, F.lit(i)) - z["lse"]).alias(f"{prefix}{label}") for label, i in sorted(label2id.items())]
        return df.select(key, *held)
    return df.select(key, logits, S.normalizer(z).alias("_norm")).select(
        key,
        *[S.probability_at(z, F.lit(i), norm).alias(f"{prefix}{label}") for label, i in sorted(label2id.items())],
    )


def map_tokens(df: DataFrame, id2label: Mapping[int, str], token: str = "token") -> DataFrame:
    """Adds ``label``; an id outside the map gives NULL and ``unknown_token`` = 1."""
    label = label_of(F.col(token), id2label)
    return df.withColumn("label", label).withColumn("unknown_token", F.col("label").isNull().cast("int"))


def first_step_scores(steps: DataFrame, step: str = "step") -> DataFrame:
    """Scores of the first generated token of each example."""
    return steps.filter(F.col(step) == 0)


def sequence_confidence(steps: DataFrame, logits: str = "logits", key: str = "example_id", step: str = "step") -> DataFrame:
    """Highest probability over all steps, and the argmax token of every step in order.

    Softmax happens per row before the shuffle, which carries one (step, token, score)
    per step.  A group holds one example's generation steps.
    """
    token, score = S.best_of(F.col(logits), S.is_sparse(steps, logits))
    per_step = steps.select(key, step, token.alias("_token"), score.alias("_score"))
    return per_step.groupBy(key).agg(
        F.max("_score").alias("score"),
        F.sort_array(F.collect_list(F.struct(step, "_token")))["_token"].alias("tokens"),
    )


def rank_by_confidence(df: DataFrame, ascending: bool = True, score: str = "score", key: str = "example_id") -> DataFrame:
    """``(key, score, rank)``, least confident first or last; ties by key, NULL scores last either way."""
    narrow = stage_table(df.select(key, score), "scores").withColumn("_unknown", F.col(score).isNull())
    if ascending:
        return ordered_rank(narrow, ["_unknown", score, key]).drop("_unknown")
    flipped = narrow.withColumn("_flipped", -F.col(score))
    return ordered_rank(flipped, ["_unknown", "_flipped", key]).drop("_unknown", "_flipped")


def least_confident(
    confidence: DataFrame, examples: DataFrame, k: int, score: str = "score", key: str = "example_id"
) -> DataFrame:
    """The ``k`` examples with the lowest scores, with the score."""
    chosen = lowest(confidence, k, [score, key])
    if k <= SMALL_SIDE_ROWS:
        chosen = F.broadcast(chosen)
    return examples.join(chosen, key)


def auto_label(confidence: DataFrame, predictions: DataFrame, theta: float, key: str = "example_id") -> DataFrame:
    """Predictions of the examples whose score is at least ``theta``."""
    return keep_keys(predictions, confident(confidence, theta), key)


def auto_label_accuracy(confidence: DataFrame, predictions: DataFrame, theta: float, key: str = "example_id") -> DataFrame:
    """Number and accuracy of the auto-labelled examples; NULL accuracy when there are none."""
    return accuracy(auto_label(confidence, predictions, theta, key))


def coverage_curve(
    confidence: DataFrame, predictions: DataFrame, thresholds: Sequence[float], key: str = "example_id", score: str = "score"
) -> DataFrame:
    """Per threshold: kept examples, coverage (kept / all scored) and accuracy of the kept.

    One pass for all thresholds: each row counts how many thresholds it reaches, rows are
    aggregated by that level, and each threshold sums the at most len(thresholds) + 1
    level rows above it.
    """
    grid = sorted(float(t) for t in thresholds)
    reached = reduce(add, [F.coalesce(F.col(score) >= t, F.lit(False)).cast("int") for t in grid])
    right = F.coalesce(F.col("predicted") == F.col("ground_truth"), F.lit(False)).cast("bigint")
    scored = confidence.select(key, reached.alias("_level"))
    judged = predictions.select(key, right.alias("_right"))
    levels = (
        scored.join(judged, key, "left")
        .groupBy("_level")
        .agg(
            F.count(F.lit(1)).alias("_scored"),
            F.count("_right").alias("_n"),
            F.coalesce(F.sum("_right"), F.lit(0)).alias("_hits"),
        )
    )
    # A level row counts for thresholds 0 .. level-1.  Every threshold keeps its row, even
    # when nothing reaches it.
    spine = levels.groupBy().agg(
        F.sum("_scored").alias("_all"), F.collect_list(F.struct("_level", "_n", "_hits")).alias("_levels")
    )
    points = spine.select(
        F.posexplode(F.array(*[F.lit(t) for t in grid])).alias("_i", "theta"), "_all", "_levels"
    )
    above = F.filter("_levels", lambda x: x["_level"] > F.col("_i"))
    none = F.lit(0).cast("bigint")
    kept = F.coalesce(F.aggregate(above, none, lambda acc, x: acc + x["_n"]), none)
    hits = F.aggregate(above, none, lambda acc, x: acc + x["_hits"])
    return points.select(
        F.col("_i").cast("bigint").alias("point"),
        "theta",
        kept.alias("kept"),
        (kept / F.col("_all")).alias("coverage"),
        F.when(kept > 0, hits / kept).alias("accuracy"),
    )
