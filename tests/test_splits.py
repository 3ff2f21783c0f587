"""Properties of samples and splits."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from labelkit.functions.keys import order_key
from labelkit.operators import ranks
from labelkit.operators import sampling as P
from labelkit.operators import splits as S

SPEC = S.SplitSpec(dataset="en", test_frac=0.2, val_frac=0.15, seed=3)


def ids(df, where="true"):
    return sorted(r["example_id"] for r in df.filter(where).select("example_id").collect())


def by_split(df):
    out = {}
    for r in df.select("example_id", "split").collect():
        out.setdefault(r["split"], []).append(r["example_id"])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("n", [0, 1, 57, 400, 1000])
def test_sample_exact_size(examples, n):
    got = ids(P.sample_exact(examples, n, seed=1))
    assert len(got) == len(set(got)) == min(n, 400)


@pytest.mark.parametrize("fraction", [0.0, 0.29, 0.57, 1.0])
def test_sample_fraction_truncates(examples, fraction):
    hundred = examples.filter("example_id < 100")
    assert len(ids(P.sample_fraction(hundred, fraction, seed=1))) == int(fraction * 100)


def test_sample_ignores_partitioning_and_depends_on_seed_and_stage(examples):
    base = ids(P.sample_exact(examples, 50, seed=1))
    for parts in (1, 7, 64):
        assert ids(P.sample_exact(examples.repartition(parts), 50, seed=1)) == base
    assert ids(P.sample_exact(examples, 50, seed=2)) != base
    assert ids(P.sample_exact(examples, 50, seed=1, stage="other")) != base


def test_sample_of_empty_table(examples):
    assert ids(P.sample_exact(examples.filter("false"), 5, seed=1)) == []


def test_shared_buckets_are_ranked_exactly(spark):
    """Several rows with the same order key: the key column decides."""
    df = spark.range(20).select(F.col("id").alias("example_id"))
    order = F.md5(F.lit("same"))
    (cut,) = ranks.cut_point(df, "example_id", order, [lambda n: F.lit(7)])
    assert ids(df.filter(ranks.at_or_before(order, F.col("example_id"), cut))) == list(range(7))


def test_normal_split_is_a_partition_with_truncated_sizes(examples):
    parts = by_split(S.normal_split(examples, SPEC))
    n = 300
    test = int(0.2 * n)
    val = int(0.15 * (n - test))
    assert {k: len(v) for k, v in parts.items()} == {"test": test, "val": val, "train": n - test - val}
    assert sorted(sum(parts.values(), [])) == ids(SPEC.select(examples))


def test_normal_split_train_fraction_drops_rows_but_not_test(examples):
    whole = by_split(S.normal_split(examples, SPEC))
    half = by_split(S.normal_split(examples, S.SplitSpec(dataset="en", train_frac=0.5, seed=3)))
    kept = int(0.5 * 240)
    assert half["test"] == whole["test"]
    assert len(half["val"]) == int(0.15 * kept)
    assert len(half["val"]) + len(half["train"]) == kept


def test_normal_split_of_a_few_rows(examples):
    for n in range(4):
        few = examples.filter(F.col("task_id") == 1).limit(n)
        parts = by_split(S.normal_split(few, SPEC))
        assert sum(len(v) for v in parts.values()) == n


def test_pseudo_split_counts(examples):
    for k in (0, 10, 10_000):
        parts = by_split(S.pseudo_split(examples, SPEC, k))
        labeled, unlabeled = len(parts.get("train_labeled", [])), len(parts.get("train_unlabeled", []))
        assert labeled == min(k, 204) and labeled + unlabeled == 204


def test_spec_needs_a_selector():
    with pytest.raises(ValueError):
        S.SplitSpec()


@pytest.mark.parametrize("trigger,cap", [(10, 5), (10, 1000), (1000, 5)])
@pytest.mark.parametrize("threshold", [20, 150, 10_000])
def test_source_pool_caps(examples, trigger, cap, threshold):
    spec = S.SplitSpec(task_ids=[0, 1, 2], test_frac=0.3, val_frac=0.3, seed=5)
    got = by_split(S.source_pool(examples, spec, threshold, trigger, cap))
    test = int(0.3 * 300)
    val = int(0.3 * (300 - test))
    train = min(300 - test - val, threshold) + test
    assert len(got["val"]) == (min(cap, val) if val >= trigger else val)
    assert len(got["train"]) == min(train, threshold)
    assert not set(got["val"]) & set(got["train"])


def transfer(examples, **options):
    spec = S.SplitSpec(dataset="en", val_frac=0.15, train_frac=0.5, seed=3)
    return S.transfer_split(examples, spec, **options)


def test_transfer_split_has_no_leaks(examples):
    parts = by_split(transfer(examples, source_ids=[1, 3]))
    every = sum(parts.values(), [])
    assert len(every) == len(set(every)) == 400  # the target and task 3
    assert len(parts["test"]) == 60
    assert len(parts["val"]) == int(0.15 * 340 * 0.5)


def test_transfer_split_literal_keeps_copies(examples):
    out = transfer(examples, source_ids=[1, 3], exclude_test=False)
    parts = by_split(out)
    assert len(parts["val"]) == int(0.15 * (240 + 100 + 100) * 0.5)
    assert set(parts["test"]) & set(parts["train"])  # test rows of task 1 return
    assert not set(parts["val"]) & set(parts["train"])
    copies = out.filter("split = 'train' AND task_id = 1").groupBy("example_id").count()
    assert copies.agg(F.max("count")).first()[0] == 2


def test_transfer_split_cap_and_use_all(examples):
    assert len(by_split(transfer(examples, source_ids=[3], sample_train_to=25))["train"]) == 25
    parts = by_split(transfer(examples, use_all=True))
    assert sorted(sum(parts.values(), [])) == list(range(400))


def test_trials_match_single_splits(examples):
    trials = S.trial_splits(examples, S.SplitSpec(dataset="en"), 3)
    for t in (1, 2, 3):
        assert by_split(trials.filter(F.col("trial") == t)) == by_split(
            S.normal_split(examples, S.SplitSpec(dataset="en", seed=t))
        )


def test_grow_pool_adds_new_rows_only(examples):
    labeled = examples.filter("example_id < 30")
    got = ids(P.grow_pool(labeled, examples, 50, seed=1))
    assert len(got) == len(set(got)) == 80 and set(range(30)) <= set(got)


def test_review_partition(spark, examples):
    confidence = examples.select("example_id", (F.col("example_id") % 50 / 50).alias("score"))
    out = S.review_partition(examples, confidence, 40, seed=2)
    parts = {p: ids(out, f"part = '{p}'") for p in ("random", "least_confident", "remainder")}
    assert len(parts["random"]) == len(parts["least_confident"]) == 40
    assert {i % 50 for i in parts["least_confident"]} == set(range(5))
    assert sorted(set(parts["random"]) | set(parts["least_confident"]) | set(parts["remainder"])) == list(range(400))
    assert not set(parts["remainder"]) & (set(parts["random"]) | set(parts["least_confident"]))


def test_balanced_resample_draws_labels_evenly(examples):
    n = 4000
    draws = P.balanced_resample(examples, seed=9, n=n)
    counts = {r["label"]: r["count"] for r in draws.groupBy("label").count().collect()}
    assert sum(counts.values()) == n
    assert abs(counts["rare"] - n / 2) < 4 * math.sqrt(n / 4)
    # Every row of the rare class is equally likely.
    rare = draws.filter("label = 'rare'").groupBy("example_id").count().collect()
    members = examples.filter("label = 'rare'").count()
    expected = counts["rare"] / members
    assert len(rare) == members
    assert max(r["count"] for r in rare) < expected + 5 * math.sqrt(expected)


def test_balanced_resample_default_is_one_draw_per_labelled_row(examples):
    assert P.balanced_resample(examples, seed=9).count() == examples.filter("label IS NOT NULL").count()


def test_balanced_resample_with_many_labels(examples, monkeypatch):
    few = sorted(map(tuple, P.balanced_resample(examples, seed=9).collect()))
    monkeypatch.setattr(P, "SMALL_SIDE_ROWS", 1)
    assert sorted(map(tuple, P.balanced_resample(examples, seed=9).collect())) == few


def test_hashed_rank_matches_a_window(spark, examples):
    from pyspark.sql import Window

    order = order_key(1, "x", F.col("example_id"))
    got = ranks.hashed_rank(examples.select("example_id", "task_id"), "example_id", order, ["task_id"])
    want = examples.select(
        "example_id", "task_id", F.row_number().over(Window.partitionBy("task_id").orderBy(order)).alias("rank")
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("groups", [[], ["task_id"]])
@pytest.mark.parametrize("limit", [0, 200_000])
def test_ordered_rank_with_one_value_for_most_rows(spark, examples, groups, limit, monkeypatch):
    """A tie holding most of the rows is ranked by the second column across partitions."""
    from pyspark.sql import Window

    monkeypatch.setattr(ranks, "OFFSETS_LIMIT", limit)
    df = examples.select("example_id", "task_id", F.when(F.col("example_id") % 3 == 0, F.col("example_id")).otherwise(7).alias("v"))
    got = ranks.ordered_rank(df, ["v", "example_id"], groups)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy("v", "example_id")))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_lowest_by_rank_equals_top_n(examples, monkeypatch):
    df = examples.select((F.col("example_id") % 7).alias("v"), "example_id")
    top = sorted(map(tuple, ranks.lowest(df, 33, ["v", "example_id"]).collect()))
    monkeypatch.setattr(ranks, "TOP_N_LIMIT", 5)
    assert sorted(map(tuple, ranks.lowest(df, 33, ["v", "example_id"]).collect())) == top


def test_balanced_resample_of_nothing(examples):
    assert P.balanced_resample(examples, seed=9, n=0).count() == 0
    assert P.balanced_resample(examples.filter("label IS NULL"), seed=9, n=5).count() == 0
