"""Filters, projections, joins, unions, counts and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query, tidy
from checks.views import with_views
from labelkit.operators import relations as R
from labelkit.operators import stats
from labelkit.operators.metrics import accuracy, trial_summary
from labelkit.operators.splits import SplitSpec, normal_split
from labelkit.session import scratch_path
from labelkit.sources import tables as io

EXAMPLES = "example_id, task_id, dataset_type, dataset, input_text, label"


@query("select_target", with_views(
    f"SELECT {EXAMPLES} FROM master WHERE dataset_type = 'TRG' AND dataset = 'en'", "master"))
def select_target(spark, sf_dir):
    return tidy(R.select_target(V.master(spark, sf_dir), "en"))


@query("select_source", with_views(
    f"SELECT {EXAMPLES} FROM master WHERE dataset_type = 'SRC'", "master"))
def select_source(spark, sf_dir):
    return tidy(R.select_target(V.master(spark, sf_dir), dataset_type="SRC"))


@query("select_tasks", with_views(
    f"SELECT {EXAMPLES} FROM master WHERE task_id IN (3, 5, 14)", "master"))
def select_tasks(spark, sf_dir):
    return tidy(R.select_tasks(V.master(spark, sf_dir), [3, 5, 14]))


@query("numeric_votes", with_views(
    "SELECT label, count(*) AS n FROM digit_votes WHERE regexp_full_match(label, '[0-9]+') GROUP BY label", "digit_votes"))
def numeric_votes(spark, sf_dir):
    kept = R.numeric_labels_only(V.digit_votes(spark, sf_dir))
    return tidy(kept.groupBy("label").agg(F.count(F.lit(1)).alias("n")))


@query("project_examples", with_views("SELECT example_id, input_text, label FROM master", "master"))
def project_examples(spark, sf_dir):
    return tidy(R.project_examples(V.master(spark, sf_dir)))


@query("remaining_examples", with_views(
    f"SELECT {EXAMPLES} FROM master WHERE example_id NOT IN (SELECT example_id FROM predictions WHERE predicted = '0')",
    "master", "predictions"))
def remaining_examples(spark, sf_dir):
    drawn = V.predictions(spark, sf_dir).filter("predicted = '0'")
    return tidy(R.minus_keys(V.master(spark, sf_dir), drawn))


@query("keep_examples", with_views(
    f"SELECT {EXAMPLES} FROM master WHERE example_id IN (SELECT example_id FROM predictions WHERE predicted = '0')",
    "master", "predictions"))
def keep_examples(spark, sf_dir):
    drawn = V.predictions(spark, sf_dir).filter("predicted = '0'")
    return tidy(R.keep_keys(V.master(spark, sf_dir), drawn))


@query("first_examples", with_views(
    f"SELECT {EXAMPLES} FROM master ORDER BY example_id LIMIT 150", "master"))
def first_examples(spark, sf_dir):
    return tidy(R.take_first(V.master(spark, sf_dir), 150))


@query("union_pools", with_views(
    """SELECT example_id, task_id, label, NULL::VARCHAR AS predicted FROM master WHERE dataset_type = 'SRC'
       UNION ALL SELECT example_id, task_id, label, NULL FROM master WHERE dataset = 'en'
       UNION ALL SELECT example_id, NULL, NULL, predicted FROM predictions""", "master", "predictions"))
def union_pools(spark, sf_dir):
    narrow = V.master(spark, sf_dir).select("example_id", "task_id", "label", "dataset", "dataset_type")
    pools = [
        narrow.filter("dataset_type = 'SRC'").drop("dataset", "dataset_type"),
        narrow.filter("dataset = 'en'").drop("dataset", "dataset_type"),
        V.predictions(spark, sf_dir).drop("ground_truth"),
    ]
    return tidy(R.union_examples(pools))


@query("label_distribution", with_views(
    """SELECT label, count(*) AS n, round(count(*) / (SELECT count(*) FROM labelled)::DOUBLE, 6) AS share
       FROM labelled GROUP BY label""", "labelled"))
def label_distribution(spark, sf_dir):
    df = V.master(spark, sf_dir)
    shares = stats.label_distribution(df, normalize=True)
    return tidy(shares.join(stats.label_distribution(df).withColumnRenamed("count", "n"), "label"))


@query("class_weights", with_views(
    """SELECT example_id, label, round((SELECT count(*) FROM labelled)::DOUBLE / count(*) OVER (PARTITION BY label), 6) AS weight
       FROM labelled""", "labelled"))
def class_weights(spark, sf_dir):
    return tidy(stats.class_weights(V.master(spark, sf_dir)).select("example_id", "label", "weight"))


@query("epoch_loss", with_views(
    """SELECT run_id, epoch, metric, round(sum(value * (1 + step % 4)) / sum(1 + step % 4), 6) AS mean_value,
              count(*) AS n_steps
       FROM metric_log GROUP BY run_id, epoch, metric""", "metric_log"))
def epoch_loss(spark, sf_dir):
    log = V.metric_log(spark, sf_dir).withColumn("batch_rows", 1 + F.col("step") % 4)
    return tidy(stats.epoch_loss(log, weight="batch_rows"))


@query("read_examples", with_views(f"SELECT {EXAMPLES} FROM master", "master"))
def read_examples(spark, sf_dir):
    path = scratch_path(spark, "examples")
    io.write_examples(V.master(spark, sf_dir), path)
    return tidy(io.read_examples(spark, path))


IDS_PER_DOCUMENT = 10_000


@query("read_raters", with_views("SELECT rater, example_id, predicted, ground_truth FROM raters", "raters"))
def read_raters(spark, sf_dir):
    """Nested documents of at most 10,000 ids each, written as JSON and read back."""
    path = scratch_path(spark, "raters")
    row = F.struct("example_id", "predicted", "ground_truth")
    lists = [F.collect_list(F.when(F.col("rater") == r, row)).alias(r) for r in V.RATERS]
    chunks = V.raters(spark, sf_dir).groupBy(F.floor(F.col("example_id") / IDS_PER_DOCUMENT).alias("chunk")).agg(*lists)
    chunks.select(
        *[
            F.struct(
                F.col(r)["example_id"].alias("index"), F.col(r)["predicted"].alias("predicted"), F.col(r)["ground_truth"].alias("ground_truth")
            ).alias(r)
            for r in V.RATERS
        ]
    ).write.json(path)
    return tidy(io.read_raters(spark, path, V.RATERS))


@query("with_row_key", with_views(
    """SELECT row_number() OVER (ORDER BY task_id, example_id) - 1 AS row_key, example_id, task_id, input_text
       FROM master""", "master"))
def with_row_key(spark, sf_dir):
    df = V.master(spark, sf_dir).select("example_id", "task_id", "input_text")
    return tidy(io.with_row_key(df, ["task_id", "example_id"], "row_key"))


@query("file_row_key", "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_key, doc_id, text FROM documents")
def file_row_key(spark, sf_dir):
    """The given file is in ``doc_id`` order, so the place in the file is the rank by it."""
    return tidy(io.read_with_row_key(spark, f"{sf_dir}/documents.parquet", "row_key").select("row_key", "doc_id", "text"))


SPLIT_EN = """
    SELECT example_id, input_text, label,
           CASE WHEN rk <= t THEN 'test' WHEN rk <= t + v THEN 'val' WHEN rk <= t + k THEN 'train' END AS split
    FROM (SELECT *, floor(0.15e0 * k) AS v FROM (
            SELECT *, floor(1e0 * (n - t)) AS k FROM (
              SELECT *, floor(0.2e0 * n) AS t FROM (
                SELECT *, count(*) OVER () AS n,
                       row_number() OVER (ORDER BY md5('1:split:' || example_id), example_id) AS rk
                FROM master WHERE dataset_type = 'TRG' AND dataset = 'en'))))"""


@query("split_bundle_roundtrip", with_views("SELECT * FROM splits", "master", splits=SPLIT_EN))
def split_bundle_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bundle")
    splits = normal_split(V.master(spark, sf_dir), SplitSpec(dataset="en")).select(
        "example_id", "input_text", "label", "split"
    )
    io.write_split_bundle(splits, path)
    return tidy(io.read_split_bundle(spark, path, splits.schema))


@query("fixed_splits", with_views("SELECT example_id, input_text, label, split FROM splits", "master", splits=SPLIT_EN))
def fixed_splits(spark, sf_dir):
    splits = normal_split(V.master(spark, sf_dir), SplitSpec(dataset="en"))
    paths = {name: scratch_path(spark, name) for name in ("train", "val", "test")}
    for name, path in paths.items():
        io.write_examples(splits.filter(F.col("split") == name).drop("split"), path)
    return tidy(io.read_fixed_splits(spark, paths).select("example_id", "input_text", "label", "split"))


@query("split_sizes", with_views(
    """SELECT split, count(*) AS n_rows, CAST(ceil(count(*) / 16e0) AS BIGINT) AS n_batches,
              CAST(floor(count(*) / 16e0) AS BIGINT) AS n_full_batches
       FROM splits GROUP BY split""", "master", splits=SPLIT_EN))
def split_sizes(spark, sf_dir):
    return tidy(stats.split_sizes(normal_split(V.master(spark, sf_dir), SplitSpec(dataset="en")), 16))


@query("predictions_roundtrip", with_views("SELECT example_id, predicted, ground_truth FROM predictions", "predictions"))
def predictions_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    df = V.predictions(spark, sf_dir)
    io.write_predictions(df, path)
    return tidy(io.read_examples(spark, path, df.schema))


TRIALS = " UNION ALL ".join(
    f"""SELECT 'target_en' AS run, {t} AS trial, avg(CASE WHEN {V.h(f"'p{t}:' || example_id")} % 10 < 2
        THEN 0e0 ELSE 1e0 END) AS accuracy FROM labelled""" for t in (1, 2, 3))


@query("trial_summary", with_views(
    """SELECT run, round(avg(accuracy), 6) AS avg_acc, round(stddev_pop(accuracy), 6) AS std,
              round(max(CASE WHEN trial = 1 THEN accuracy END), 6) AS acc_1,
              round(max(CASE WHEN trial = 2 THEN accuracy END), 6) AS acc_2,
              round(max(CASE WHEN trial = 3 THEN accuracy END), 6) AS acc_3
       FROM trials GROUP BY run""", "labelled", trials=TRIALS))
def trial_report(spark, sf_dir):
    """Accuracies of three trials, summarised, written as JSON and read back."""
    per_trial = [
        accuracy(V.predictions(spark, sf_dir, f"p{t}")).select(
            F.lit("target_en").alias("run"), F.lit(t).alias("trial"), "accuracy"
        )
        for t in (1, 2, 3)
    ]
    summary = trial_summary(R.union_examples(per_trial))
    path = scratch_path(spark, "summary")
    io.write_trial_summary(summary, path)
    back = spark.read.schema(summary.schema).json(path)
    return tidy(back.select("run", "avg_acc", "std", *[F.get("accuracies", F.lit(i)).alias(f"acc_{i + 1}") for i in range(3)]))
