"""Scores of predictions, trials, losses and training logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelkit.functions import scores as S
from labelkit.functions.encoding import IGNORE_ID
from labelkit.operators.ranks import ordered_rank

CHECKS_PER_BLOCK = 65_536


def accuracy(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of exact matches and row count; a missing prediction counts as wrong."""
    right = F.when(F.col("predicted") == F.col("ground_truth"), 1.0).otherwise(0.0)
    return predictions.groupBy(*by).agg(F.avg(right).alias("accuracy"), F.count(F.lit(1)).alias("n_examples"))


def trial_summary(results: DataFrame) -> DataFrame:
    """Per run: accuracies in trial order, their mean and population deviation."""
    listed = F.sort_array(F.collect_list(F.struct("trial", "accuracy")))["accuracy"]
    return results.groupBy("run").agg(
        listed.alias("accuracies"), F.avg("accuracy").alias("avg_acc"), F.stddev_pop("accuracy").alias("std")
    )


def regression_scores(predictions: DataFrame) -> DataFrame:
    """MSE and R² over the pairs in which both labels are numbers.

    Model text that is no number is left out of both; R² is NULL when the truth is constant.
    """
    y, p = F.expr("try_cast(ground_truth AS DOUBLE)"), F.expr("try_cast(predicted AS DOUBLE)")
    both = y.isNotNull() & p.isNotNull()
    y, p = F.when(both, y), F.when(both, p)
    sums = predictions.agg(
        F.avg((p - y) * (p - y)).alias("mse"),
        F.sum((y - p) * (y - p)).alias("_residual"),
        (F.var_pop(y) * F.count(y)).alias("_spread"),
    )
    r2 = F.when(F.col("_spread") > 0, 1 - F.col("_residual") / F.col("_spread"))
    return sums.select("mse", r2.alias("r2"))


def cross_entropy(scores: DataFrame, logits: str = "logits", target: str = "target", by: Sequence[str] = ()) -> DataFrame:
    """Mean of ``-log p(target)`` over the positions whose target is neither ignored nor NULL.

    A target outside of the scores has no loss and is not counted as a position.  Sparse
    rows have to hold their target, or the job ends with an error.
    """
    z = F.col(logits)
    if S.is_sparse(scores, logits):
        held = F.array_contains(z["ids"], F.col(target))
        missing = F.raise_error(F.lit("a row of scores does not hold its target")).cast("double")
        loss = F.when(held, z["lse"] - S.score_at(z, F.col(target))).otherwise(missing)
    else:
        loss = S.log_sum_exp(z) - F.get(z, F.col(target))
    return (
        scores.filter(F.col(target) != IGNORE_ID)
        .groupBy(*by)
        .agg(F.avg(loss).alias("loss"), F.count(loss).alias("n_positions"))
    )


def best_checkpoint(log: DataFrame, monitor: str = "val_loss") -> DataFrame:
    """Per run the step with the lowest monitored value, the earliest one on a tie.

    Checks without a number (NULL or NaN) cannot be the best; a run of such checks only is left out.
    """
    best = F.min(F.struct("value", "step"))
    return (
        log.filter((F.col("metric") == monitor) & F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("run_id")
        .agg(best.alias("_best"))
        .select("run_id", F.col("_best.step").alias("step"), F.col("_best.value").alias("value"))
    )


def early_stop_point(log: DataFrame, patience: int, monitor: str = "val_loss", block: int = CHECKS_PER_BLOCK) -> DataFrame:
    """Per run the first check that ends ``patience`` checks without a new minimum.

    ``(run_id, n_checks, stop_check, stop_step)``; the stop is NULL for a run that never
    runs out of patience.

    Checks are numbered per run and cut into blocks of ``block`` consecutive ones.  A
    window inside a block finds its improvements, given the minimum of earlier blocks; a
    window over block summaries links the last improvement so far with the next one.  No
    task holds more than a block, or one row per block of a run.
    """
    checks = log.filter(F.col("metric") == monitor).select("run_id", "step", "value")
    checks = ordered_rank(checks, ["step"], ["run_id"], "_check").withColumn(
        "_block", F.floor((F.col("_check") - 1) / F.lit(block))
    )
    earlier_blocks = Window.partitionBy("run_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("run_id", "_block").orderBy("_check").rowsBetween(Window.unboundedPreceding, -1)
    floors = (
        checks.groupBy("run_id", "_block")
        .agg(F.min("value").alias("_low"))
        .select("run_id", "_block", F.min("_low").over(earlier_blocks).alias("_floor"))
    )
    low = F.least(F.col("_floor"), F.min("value").over(earlier))
    better = F.when(F.col("_low").isNull() | (F.col("value") < F.col("_low")), F.col("_check"))
    previous = F.col("_previous")
    blocks = (
        checks.join(floors, ["run_id", "_block"])
        .withColumn("_low", low)
        .withColumn("_better", better)
        .withColumn("_previous", F.max("_better").over(earlier))
        .groupBy("run_id", "_block")
        .agg(
            F.min("_better").alias("_first"),
            F.max("_better").alias("_last"),
            F.min(F.when(F.col("_better") - previous > patience, previous + patience)).alias("_stop"),
            F.max("_check").alias("_end"),
        )
        .withColumn("_previous", F.max("_last").over(earlier_blocks))
    )
    across = F.when(F.col("_first") - previous > patience, previous + patience)
    runs = blocks.groupBy("run_id").agg(
        F.max("_end").alias("n_checks"),
        F.max("_last").alias("_last"),
        F.min(F.least("_stop", across)).alias("_stop"),
    )
    at_end = F.when(F.col("_last") + patience <= F.col("n_checks"), F.col("_last") + patience)
    stops = runs.select("run_id", "n_checks", F.least("_stop", at_end).alias("stop_check"))
    steps = checks.select("run_id", F.col("_check").alias("stop_check"), F.col("step").alias("stop_step"))
    return stops.join(steps, ["run_id", "stop_check"], "left").select("run_id", "n_checks", "stop_check", "stop_step")
