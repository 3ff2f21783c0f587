"""Counts, label shares, class weights and epoch averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.session import SMALL_SIDE_ROWS, sized_table

SALTS = 32


def label_distribution(df: DataFrame, label: str = "label", normalize: bool = False) -> DataFrame:
    """``(label, count)`` or ``(label, share)``, most frequent first; NULL labels are left out."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return counts.orderBy(F.desc("count"), label)
    total = counts.agg(F.sum("count")).scalar()
    return counts.orderBy(F.desc("count"), label).select(label, (F.col("count") / total).alias("share"))


def class_weights(df: DataFrame, label: str = "label", key: str = "example_id", name: str = "weight") -> DataFrame:
    """Every labelled row with weight N / count(its label).

    Counts are broadcast when there really are few labels.  Otherwise the join shuffles
    on (label, salt), so that a label holding a third of the rows is spread as well.
    """
    labelled = df.filter(F.col(label).isNotNull())
    counts, n_labels = sized_table(labelled.groupBy(label).agg(F.count(F.lit(1)).alias("_count")), "labels")
    total = counts.agg(F.sum("_count")).scalar()
    weights = counts.select(label, (total / F.col("_count")).alias(name))
    if n_labels <= SMALL_SIDE_ROWS:
        return labelled.join(F.broadcast(weights), label).select(*df.columns, name)
    spread = weights.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = labelled.withColumn("_salt", F.pmod(F.hash(key), F.lit(SALTS)))
    return salted.join(spread, [label, "_salt"]).select(*df.columns, name)


def split_sizes(splits: DataFrame, batch_size: int) -> DataFrame:
    """Rows per split, with the number of batches when the last one is kept or dropped."""
    n = F.count(F.lit(1))
    return splits.groupBy("split").agg(
        n.alias("n_rows"),
        F.ceil(n / F.lit(batch_size)).alias("n_batches"),
        F.floor(n / F.lit(batch_size)).alias("n_full_batches"),
    )


def epoch_loss(log: DataFrame, weight: str | None = None) -> DataFrame:
    """Step values averaged per run, epoch and metric, weighted by batch size if given.

    A step without a value counts in ``n_steps`` but has no weight; the mean is NULL if no weight is left.
    """
    w = F.when(F.col("value").isNotNull(), F.lit(1.0) if weight is None else F.col(weight).cast("double"))
    return log.groupBy("run_id", "epoch", "metric").agg(
        F.try_divide(F.sum(F.col("value") * w), F.sum(w)).alias("mean_value"),
        F.count(F.lit(1)).alias("n_steps"),
    )
