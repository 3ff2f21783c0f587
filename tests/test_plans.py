"""Shapes of the physical plans."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from checks import views as V
from labelkit.functions.keys import order_key
from labelkit.operators import confidence as C
from labelkit.operators import ranks
from labelkit.operators import relations as R
from labelkit.operators import sampling as P
from labelkit.operators import splits as S
from labelkit.operators import text as T
from labelkit.operators import votes as W
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def master(spark):
    return V.master(spark, SMALL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sampling_shuffles_nothing(spark):
    docs = V.table(spark, SMALL, "documents").withColumnRenamed("doc_id", "example_id")
    assert "Exchange" not in plan(P.sample_exact(docs, 50, seed=1))


def test_splitting_shuffles_nothing_but_broadcasts(spark, master):
    for df in (
        S.normal_split(master, S.SplitSpec(dataset="en")),
        S.source_pool(master, S.SplitSpec(task_ids=[1, 2])),
        S.transfer_split(master, S.SplitSpec(dataset="en"), [1, 12]),
    ):
        assert "Exchange hashpartitioning" not in plan(df)
        assert "Exchange SinglePartition" not in plan(df)
        assert plan(df).count("FileScan") == 2  # documents and labels, once each


def test_cut_reads_only_what_orders_the_rows(spark):
    docs = V.table(spark, SMALL, "documents").withColumnRenamed("doc_id", "example_id")
    cuts = ranks.cut_keys(docs, "example_id", order_key(1, "s", F.col("example_id")), [lambda n: F.lit(5)])
    schemas = re.findall(r"ReadSchema: (\S+)", plan(cuts))
    assert schemas and set(schemas) == {"struct<doc_id:bigint>"}


def test_single_partition_only_above_aggregated_rows(spark):
    docs = V.table(spark, SMALL, "documents").withColumnRenamed("doc_id", "example_id")
    cuts = ranks.cut_keys(docs, "example_id", order_key(1, "s", F.col("example_id")), [lambda n: F.lit(5)])
    text = plan(cuts).splitlines()
    for i, line in enumerate(text):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in text[i + 1] or "SortAggregate" in text[i + 1]


def test_filters_and_columns_reach_the_scan(spark, master):
    text = plan(R.select_target(master, "en").select("example_id"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in text
    assert "text:string" not in text


def test_dictionary_encoding_is_row_local(spark, master):
    vocab = T.compact(T.build_vocab(master, ["input_text", "label"], 100))
    docs = V.table(spark, SMALL, "documents").select(F.col("doc_id").alias("example_id"), F.col("text").alias("input_text"))
    text = plan(T.encode_text(docs, vocab))
    assert "Exchange" not in text and "from_json" not in text  # the literal is folded


def test_votes_combine_before_the_shuffle(spark):
    text = plan(W.majority_vote(V.votes(spark, SMALL), "order"))
    assert "Window" not in text and text.count("partial_") >= 2


def test_scores_need_no_python_and_no_shuffle(spark):
    text = plan(C.best_label(V.logits(spark, SMALL), V.ID2LABEL))
    assert "Python" not in text and "Exchange" not in text


def test_curve_aggregates_before_any_single_partition(spark):
    df = V.logits(spark, SMALL)
    conf = C.best_label(df, V.ID2LABEL)
    judged = conf.select("example_id", F.col("label").alias("predicted"), F.col("label").alias("ground_truth"))
    text = plan(C.coverage_curve(conf, judged, C.threshold_grid()))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def jobs(spark, build):
    name = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(name, "counted")
    build()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(name)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(found)


def test_dependent_cuts_take_few_jobs(spark, master):
    spec = S.SplitSpec(dataset="en", train_frac=0.5)
    assert jobs(spark, lambda: S.transfer_split(master, spec, [1, 2, 12], sample_train_to=20)) <= 8
    assert jobs(spark, lambda: S.transfer_split(master, spec, [1, 2, 12], exclude_test=False)) <= 7
    assert jobs(spark, lambda: S.source_pool(master, S.SplitSpec(task_ids=[1, 2]), 30)) <= 8
    assert jobs(spark, lambda: S.source_pool(master, S.SplitSpec(task_ids=[1, 2]))) <= 6
