"""Exact-size seeded samples, balanced resampling and pool growth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkit.functions.keys import hash_int, keyed_text, order_key
from labelkit.operators.ranks import at_or_before, cut_point, hashed_rank, ordered_rank
from labelkit.operators.relations import minus_keys, union_examples
from labelkit.session import SMALL_SIDE_ROWS, sized_table

DRAW_DIGITS = 15  # 60 random bits: even over classes of many billions of rows


def truncated(fraction: float) -> Callable[[Column], Column]:
    """``int(fraction * n)`` on doubles, as a function of the row count ``n``."""
    return lambda n: F.floor(F.lit(float(fraction)) * n.cast("double"))


def _sample(df: DataFrame, size: Callable[[Column], Column], seed: int, stage: str, key: str) -> DataFrame:
    order = order_key(seed, stage, F.col(key))
    (cut,) = cut_point(df, key, order, [size])
    return df.filter(at_or_before(order, F.col(key), cut))


def sample_exact(df: DataFrame, n: int, seed: int, stage: str = "sample", key: str = "example_id") -> DataFrame:
    """Exactly ``n`` rows without replacement, or all rows when there are fewer.

    ``key`` must be unique.  The sampled rows are found by a filter against one
    threshold, so no row is shuffled, however large ``n`` is.
    """
    return _sample(df, lambda _: F.lit(n), seed, stage, key)


def sample_fraction(
    df: DataFrame, fraction: float, seed: int, stage: str = "sample", key: str = "example_id"
) -> DataFrame:
    """``int(fraction * count)`` rows without replacement."""
    return _sample(df, truncated(fraction), seed, stage, key)


def grow_pool(
    labeled: DataFrame, unlabeled: DataFrame, n: int, seed: int, key: str = "example_id"
) -> DataFrame:
    """``labeled`` plus ``n`` random rows of ``unlabeled`` that are not in it already."""
    fresh = minus_keys(unlabeled, labeled, key)
    return union_examples([sample_exact(fresh, n, seed, "grow", key), labeled])


def balanced_resample(
    df: DataFrame, seed: int, n: int | None = None, label: str = "label", key: str = "example_id"
) -> DataFrame:
    """Draws with replacement in which every label is equally likely: ``(draw, key, label)``.

    A row's weight is N / count(label), so drawing a label uniformly and then a row of
    it uniformly has the same distribution.  ``n`` draws, or one per labelled row by
    default (then draw ids are the row keys).  Draws meet rows on (label, ordinal), where
    ordinals are uniform: no reducer depends on the size of a class.
    """
    rows = df.select(key, label).filter(F.col(label).isNotNull())
    ranked = hashed_rank(rows, key, order_key(seed, "ordinal", F.col(key)), [label], "_ordinal")
    classes, n_classes = sized_table(rows.groupBy(label).agg(F.count(F.lit(1)).alias("_size")), "classes")
    few = n_classes <= SMALL_SIDE_ROWS
    if few:
        classes = classes.withColumn("_rank", F.row_number().over(Window.orderBy(label)))
    else:
        classes = ordered_rank(classes, [label], name="_rank")
    classes = classes.select(label, "_size", (F.col("_rank") - 1).cast("bigint").alias("_class"))
    if n is None:
        draws = rows.select(F.col(key).alias("draw"))
    else:
        draws = df.sparkSession.range(n).select(F.col("id").alias("draw"))
    pick = hash_int(keyed_text(seed, "class", F.col("draw")), DRAW_DIGITS)
    place = hash_int(keyed_text(seed, "place", F.col("draw")), DRAW_DIGITS)
    chosen = draws.withColumn("_class", F.pmod(pick, F.lit(max(n_classes, 1))))
    # With more classes than that each gets few draws: a shuffle on the class number is even.
    side = F.broadcast(classes) if few else classes
    chosen = chosen.join(side, "_class").withColumn("_ordinal", F.pmod(place, F.col("_size")) + 1)
    return chosen.join(ranked, [label, "_ordinal"]).select("draw", key, label)
