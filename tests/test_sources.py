"""Round trips and row keys."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from labelkit.operators import relations as R
from labelkit.session import scratch_root, sized_table
from labelkit.sources import tables as io

AWKWARD = ['plain', ' blanks ', 'two\nlines', 'quote " and, comma', '', None, 'back\\slash', '"', "tab\tand\rreturn", "中文 é"]


def test_csv_keeps_awkward_text(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, i % 3, "TRG", "en", t, None if i % 2 else "1") for i, t in enumerate(AWKWARD)], io.EXAMPLE_SCHEMA
    )
    io.write_examples(df, str(tmp_path / "csv"))
    back = io.read_examples(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_raters_from_one_nested_document(spark, tmp_path):
    path = tmp_path / "raters.json"
    path.write_text(json.dumps({
        "model-a": {"index": [4, 9], "predicted": ["1", "2"], "ground_truth": ["1", "3"]},
        "model.b": {"index": [9], "predicted": ["5"], "ground_truth": ["3"]},
    }, indent=1))
    got = io.read_raters(spark, str(path), ["model-a", "model.b"], multi_line=True)
    assert sorted(map(tuple, got.collect())) == [("model-a", 4, "1", "1"), ("model-a", 9, "2", "3"), ("model.b", 9, "5", "3")]


def test_file_row_key_over_several_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(path)
    got = io.read_with_row_key(spark, path)
    assert got.filter("example_id <> id").count() == 0 and got.count() == 1000


def test_row_key_on_wide_rows(spark):
    df = spark.range(50).select((50 - F.col("id")).alias("k"), F.lit("x").alias("text"))
    got = sorted(map(tuple, io.with_row_key(df, ["k"]).select("example_id", "k", "text").collect()))
    assert got == [(i, i + 1, "x") for i in range(50)]


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_split_bundle(spark, tmp_path, format):
    df = spark.createDataFrame([(1, "a\nb", "train"), (2, "c", "test")], "example_id long, input_text string, split string")
    io.write_split_bundle(df, str(tmp_path / "bundle"), format)
    back = io.read_split_bundle(spark, str(tmp_path / "bundle"), df.schema, format)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    plan = back.filter("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_scratch_folder_is_the_clusters_own(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_sized_table(spark):
    table, n = sized_table(spark.range(12), "t")
    assert n == 12 and table.count() == 12


def test_union_fills_missing_columns_and_keeps_duplicates(spark):
    a, b = spark.sql("SELECT 1 AS x, 'k' AS y"), spark.sql("SELECT 1 AS x")
    assert sorted(map(str, R.union_examples([a, b, b]).collect())) == ["Row(x=1, y='k')", "Row(x=1, y=None)", "Row(x=1, y=None)"]


def test_numeric_labels(spark):
    df = spark.createDataFrame([("12",), ("",), ("1a",), ("-1",), (None,)], "label string")
    assert [r[0] for r in R.numeric_labels_only(df).collect()] == ["12"]


def test_take_first(spark):
    df = spark.range(20).select((19 - F.col("id")).alias("example_id"))
    assert sorted(r[0] for r in R.take_first(df, 4).collect()) == [0, 1, 2, 3]
    assert R.take_first(df, 0).count() == 0 and R.take_first(df, 99).count() == 20
