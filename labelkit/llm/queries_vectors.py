"""Registered query over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.llm.common import table
from labelkit.llm.neighbours import nearest
from labelkit.llm.registry import query


@query("op10_nearest_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
