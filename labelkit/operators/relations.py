"""Filters, projections, key joins, unions and prefixes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.operators.ranks import lowest


def select_target(df: DataFrame, dataset: str | None = None, dataset_type: str = "TRG") -> DataFrame:
    """Rows of one role (``TRG`` / ``SRC``), of one dataset or of all of them."""
    keep = F.col("dataset_type") == dataset_type
    if dataset is not None:
        keep = keep & (F.col("dataset") == dataset)
    return df.filter(keep)


def select_tasks(df: DataFrame, task_ids: Iterable[int]) -> DataFrame:
    return df.filter(F.col("task_id").isin(list(task_ids)))


def numeric_labels_only(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose label consists of ASCII digits (other Unicode digits are not accepted)."""
    return df.filter(F.col(label).rlike("^[0-9]+$"))


def confident(df: DataFrame, theta: float, score: str = "score") -> DataFrame:
    """Scores at or above ``theta``."""
    return df.filter(F.col(score) >= F.lit(float(theta)))


def project_examples(df: DataFrame, key: str = "example_id") -> DataFrame:
    """Key, input text and the label as text: what a model or a scorer needs."""
    return df.select(key, "input_text", F.col("label").cast("string").alias("label"))


def prediction_table(
    df: DataFrame, predicted: str, ground_truth: str, key: str = "example_id"
) -> DataFrame:
    """``(key, predicted, ground_truth)`` with both labels as text."""
    return df.select(
        key,
        F.col(predicted).cast("string").alias("predicted"),
        F.col(ground_truth).cast("string").alias("ground_truth"),
    )


def minus_keys(df: DataFrame, other: DataFrame, key: str = "example_id") -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``, of which only the key is read; both sides are shuffled unless it is small."""
    return df.join(other.select(key), key, "left_anti")


def keep_keys(df: DataFrame, other: DataFrame, key: str = "example_id") -> DataFrame:
    """Rows of ``df`` whose key is in ``other``, each once."""
    return df.join(other.select(key), key, "left_semi")


def take_first(df: DataFrame, n: int, key: str = "example_id") -> DataFrame:
    """The ``n`` rows with the lowest keys.

    The cut is found on the key column alone and applied as a scan filter, so wide
    rows are never gathered in the final merge of a top-n.
    """
    last = lowest(df, n, [key]).agg(F.max(key)).scalar()
    return df.filter(F.col(key) <= last)


def union_examples(dfs: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; missing columns become NULL, duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
