"""Majority votes over repeated samples and over several raters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.operators.metrics import accuracy
from labelkit.operators.relations import numeric_labels_only


def majority_vote(
    votes: DataFrame, order: str, label: str = "label", key: str = "example_id", carry: Sequence[str] = ()
) -> DataFrame:
    """``(key, label, n_votes, total_votes)``: most frequent label, first seen on a tie.

    Two aggregations, both combined on the map side; an example with any number of
    votes reaches the second one as one row per distinct label.  ``carry`` names columns
    that are constant per example.
    """
    kept = [F.max(c).alias(c) for c in carry]
    per_label = votes.groupBy(key, label).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"), *kept)
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_first").alias("first"), F.col(label).alias("label")))
    return (
        per_label.groupBy(key)
        .agg(best.alias("_best"), F.sum("_n").alias("total_votes"), *kept)
        .select(key, F.col("_best.label").alias(label), (-F.col("_best.n")).alias("n_votes"), "total_votes", *carry)
    )


def align_raters(ratings: DataFrame, raters: Sequence[str], key: str = "example_id", strict: bool = True) -> DataFrame:
    """One row per example that all raters judged: ``<rater>_predicted``, ``<rater>_truth``.

    ``ratings`` is the long form ``(rater, key, predicted, ground_truth)``.  The lookup of
    every rater is one aggregation on the key.  A rater with several rows for an example
    is an error (``strict``) or contributes its largest label.
    """
    columns = []
    for rater in raters:
        mine = F.col("rater") == rater
        columns += [
            F.max(F.when(mine, F.col("predicted"))).alias(f"{rater}_predicted"),
            F.max(F.when(mine, F.col("ground_truth"))).alias(f"{rater}_truth"),
            F.count(F.when(mine, 1)).alias(f"_n_{rater}"),
        ]
    wide = ratings.groupBy(key).agg(*columns)
    complete = F.lit(True)
    for rater in raters:
        n = F.col(f"_n_{rater}")
        if strict:
            n = F.when(n > 1, F.raise_error(F.concat(F.lit(f"several rows of rater {rater} for "), F.col(key).cast("string"))).cast("bigint")).otherwise(n)
        complete = complete & (n > 0)
    return wide.filter(complete).drop(*[f"_n_{r}" for r in raters])


def rater_ensemble(
    ratings: DataFrame, raters: Sequence[str], truth_of: str, key: str = "example_id"
) -> DataFrame:
    """Vote of the raters, in their order of precedence: ``(key, predicted, ground_truth, n_votes)``.

    When all disagree the first rater's label wins.  After the alignment an example's
    ballots are in one row, so the vote itself needs no further shuffle.
    """
    ballots = F.array(
        *[F.struct(F.lit(i).alias("order"), F.col(f"{r}_predicted").alias("label")) for i, r in enumerate(raters)]
    )
    ranked = F.transform(
        "_ballots",
        lambda b: F.struct(
            (-F.size(F.filter("_ballots", lambda x: x["label"].eqNullSafe(b["label"])))).alias("n"),
            b["order"].alias("order"),
            b["label"].alias("label"),
        ),
    )
    return (
        align_raters(ratings, raters, key)
        .withColumn("_ballots", ballots)
        .withColumn("_best", F.array_min(ranked))
        .select(
            key,
            F.col("_best.label").alias("predicted"),
            F.col(f"{truth_of}_truth").alias("ground_truth"),
            (-F.col("_best.n")).cast("bigint").alias("n_votes"),
        )
    )


def truth_conflicts(ratings: DataFrame, master: DataFrame, raters: Sequence[str], key: str = "example_id") -> DataFrame:
    """Examples on which the raters' ground truths or the master label differ (NULL-safe)."""
    aligned = align_raters(ratings, raters, key).drop(*[f"{r}_predicted" for r in raters])
    joined = aligned.join(master.select(key, F.col("label").cast("string").alias("master_truth")), key)
    chain = [F.col(f"{r}_truth") for r in raters] + [F.col("master_truth")]
    agree = F.lit(True)
    for left, right in zip(chain, chain[1:]):
        agree = agree & left.eqNullSafe(right)
    return joined.filter(~agree)


def vote_accuracy(votes: DataFrame, order: str, key: str = "example_id") -> DataFrame:
    """Accuracy of the majority label over the examples where that label is a number."""
    voted = majority_vote(votes, order, key=key, carry=["ground_truth"])
    return accuracy(numeric_labels_only(voted).withColumnRenamed("label", "predicted"))
