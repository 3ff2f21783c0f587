from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def examples(spark):
    """400 rows: 300 of the target, half of them in task 1; task 2 lies outside of it."""
    return spark.sql(
        """SELECT id AS example_id, CAST(id % 4 AS INT) AS task_id,
                  CASE WHEN id % 4 = 3 THEN 'SRC' ELSE 'TRG' END AS dataset_type,
                  CASE WHEN id % 4 = 3 THEN 'other' ELSE 'en' END AS dataset,
                  concat('text ', id) AS input_text,
                  CASE WHEN id % 10 = 0 THEN NULL WHEN id % 3 = 0 THEN 'rare' ELSE 'common' END AS label
           FROM range(400)"""
    ).cache()
