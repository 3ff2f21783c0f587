"""Naive Bayes, self-training, trials, fits with validation, saved models, resumable labelling."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelkit.functions import lookup
from labelkit.operators import bayes, epochs, training
from labelkit.operators import inference as I
from labelkit.operators.metrics import accuracy, best_checkpoint, early_stop_point
from labelkit.operators.splits import SplitSpec
from labelkit.plans.experiments import self_training, transfer_trials

ROWS = [
    (1, 1, "Good good film", "yes"),
    (2, 1, "bad film\tBAD", "no"),
    (3, 1, None, "yes"),
    (4, 2, "good plot", "yes"),
    (5, 2, "bad plot bad", "no"),
    (5, 2, "bad plot bad", "no"),
    (6, 2, "odd", None),
    (7, None, "", "maybe"),
]
SCHEMA = "example_id long, trial int, input_text string, label string"
TESTS = [(10, 1, "good bad unseen film", "yes"), (11, 1, "", "no"), (12, 1, None, None), (13, 1, "bad bad plot", "no")]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def test(spark):
    return spark.createDataFrame(TESTS, SCHEMA)


def tokens(text):
    return [t for t in re.split(r"[ \t\n\r\f]+", (text or "").lower()) if t]


def brute(rows, tests, alpha, extra=None, weight=0.0):
    """{example: (predicted, score, margin)} of a model of ``rows``, with ``extra`` rows counted ``weight`` times."""
    docs, counts = Counter(), {}
    for source, w in ((rows, 1.0), (extra or [], weight)):
        for _, _, text, label in source:
            if label is not None:
                docs[label] += w
                own = counts.setdefault(label, Counter())
                for t in tokens(text):
                    own[t] += w
    vocabulary = {t for c in counts.values() for t in c}
    out = {}
    for key, _, text, _ in tests:
        known = [t for t in tokens(text) if t in vocabulary]
        scores = {}
        for label in docs:
            total = sum(counts[label].values()) + alpha * len(vocabulary)
            scores[label] = round(math.log(docs[label] / sum(docs.values())) + sum(math.log((counts[label][t] + alpha) / total) for t in known), 9)
        order = sorted(scores, key=lambda x: (-scores[x], x))
        margin = (scores[order[0]] - scores[order[1]]) / max(len(known), 1) if len(order) > 1 else None
        out[key] = (order[0], 1 / sum(math.exp(s - scores[order[0]]) for s in scores.values()), margin)
    return out


def found(predictions):
    return {r["example_id"]: (r["predicted"], r["score"], r["margin"]) for r in predictions.collect()}


def same(a, b):
    assert set(a) == set(b)
    for k in a:
        assert a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1]) and a[k][2] == pytest.approx(b[k][2], abs=1e-8), k


@pytest.mark.parametrize("alpha", [1.0, 0.3])
def test_bayes(train, test, alpha):
    same(found(bayes.predict_bayes(bayes.fit_bayes(train, alpha), test)), brute(ROWS, TESTS, alpha))


def test_bayes_with_a_source(train, test):
    few = train.filter("example_id IN (1, 2)")
    model = bayes.fit_bayes(few, source=bayes.fit_bayes(train), source_weight=0.25)
    same(found(bayes.predict_bayes(model, test)), brute([r for r in ROWS if r[0] in (1, 2)], TESTS, 1.0, ROWS, 0.25))


def test_groups_are_models_of_their_own(train, test):
    model = bayes.fit_bayes(train, groups=["trial"], source=bayes.fit_bayes(train.filter("trial = 2")), source_weight=0.5)
    got = bayes.predict_bayes(model, test).cache()
    for trial in (1, 2, None):
        own = [r for r in ROWS if r[1] == trial]
        same(found(got.filter(F.col("trial").eqNullSafe(F.lit(trial)))), brute(own, TESTS, 1.0, [r for r in ROWS if r[1] == 2], 0.5))


def test_a_large_model_joins_its_rare_tokens(train, test, monkeypatch):
    model = bayes.fit_bayes(train, groups=["trial"])
    whole = {(r["trial"], r["example_id"]): tuple(r) for r in bayes.predict_bayes(model, test).collect()}
    monkeypatch.setattr(bayes, "CELLS_LIMIT", 2 * len(model.slots))
    parted = {(r["trial"], r["example_id"]): tuple(r) for r in bayes.predict_bayes(model, test).collect()}
    assert whole.keys() == parted.keys()
    for k in whole:
        assert whole[k][:4] == parted[k][:4] and whole[k][4] == pytest.approx(parted[k][4])


def test_bayes_bundle(spark, train, test, tmp_path):
    model = bayes.fit_bayes(train, groups=["trial"])
    bayes.save_bayes(model, str(tmp_path / "m"))
    again = bayes.load_bayes(spark, str(tmp_path / "m"))
    assert (again.groups, again.slots, again.vocabulary, again.alpha) == (model.groups, model.slots, model.vocabulary, model.alpha)
    first, second = (sorted(map(str, bayes.predict_bayes(m, test).collect())) for m in (model, again))
    assert first == second
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        bayes.save_bayes(model, str(tmp_path / "m"))
    (tmp_path / "n").mkdir()
    spark.createDataFrame([('{"format": 99}',)], "value string").write.text(str(tmp_path / "n" / "model"))
    with pytest.raises(ValueError, match="format 99"):
        bayes.load_bayes(spark, str(tmp_path / "n"))


def test_bayes_without_rows(train, test):
    model = bayes.fit_bayes(train.filter("false"))
    assert bayes.predict_bayes(model, test).count() == 0
    assert bayes.predict_bayes(bayes.fit_bayes(train), test.filter("false")).count() == 0
    with pytest.raises(ValueError, match="alpha"):
        bayes.fit_bayes(train, alpha=0)


def corpus(spark, n=240):
    return spark.sql(
        f"""SELECT id AS example_id, CAST(id % 2 AS INT) AS task_id, IF(id % 2 = 0, 'SRC', 'TRG') AS dataset_type, 'en' AS dataset,
                   IF(id % 5 = 0, 'No', 'Yes') AS label,
                   concat('w', id % 17, IF(id % 5 = 0, ' bad', ' good'), IF(id % 3 = 0, IF(id % 5 = 0, ' awful', ' nice'), '')) AS input_text
            FROM range({n})"""
    )


def test_trials_of_transfer_learn(spark):
    (row,) = transfer_trials(corpus(spark), SplitSpec(task_ids=[0]), SplitSpec(task_ids=[1]), 3, "t").collect()
    assert row["accuracies"] == [1.0, 1.0, 1.0] and row["std"] == 0


def test_self_training_goes_on_until_nothing_is_sure(spark):
    labeled = spark.createDataFrame([(1, "a a a a b", "x"), (2, "z z z z y", "w")], "example_id long, input_text string, label string")
    pool = spark.createDataFrame(
        [(10, "a a c c", "x"), (11, "c c d d", "x"), (12, "z z q q", "w"), (13, "q q r r", None), (14, "nothing", "w"), (15, None, "x")],
        labeled.schema,
    )
    done = self_training(labeled, pool, theta=0.3, max_rounds=9)
    rounds = {r["example_id"]: (r["round"], r["predicted"]) for r in done.pseudo.collect()}
    assert rounds == {10: (1, "x"), 12: (1, "w"), 11: (2, "x"), 13: (2, "w")} and done.rounds == 2
    assert self_training(labeled, pool, theta=0.3, max_rounds=1).pseudo.count() == 2
    none = self_training(labeled, pool, theta=99.0)
    assert none.pseudo.count() == 0 and none.rounds == 0 and none.pseudo.columns == done.pseudo.columns
    # the counts of the rounds add up to a fit of all rows
    every = labeled.unionByName(pool.drop("label").join(done.pseudo.select("example_id", F.col("predicted").alias("label")), "example_id"))
    whole = bayes.fit_bayes(every)
    test = spark.createDataFrame([(20, "a c d q", "x"), (21, "r", "w")], labeled.schema)
    same(found(bayes.predict_bayes(done.model, test)), found(bayes.predict_bayes(whole, test)))


def splits(spark):
    return corpus(spark).withColumn("split", F.expr("CASE id_ WHEN 0 THEN 'val' WHEN 1 THEN 'test' ELSE 'train' END".replace("id_", "example_id % 7")))


def test_a_fit_agrees_with_the_checkpoint_operators(spark):
    fit = epochs.fit_epochs(splits(spark), features=64, rate=60.0, max_epochs=30, patience=3)
    steps = sorted({r["step"] for r in fit.log.collect()})
    assert best_checkpoint(fit.log).first()["step"] == fit.best
    stop = early_stop_point(fit.log, 3).first()
    assert stop["n_checks"] == len(steps)
    assert stop["stop_step"] == (steps[-1] if len(steps) < 31 else None)
    if stop["stop_step"] is not None:
        assert steps[-1] == fit.best + 3


def test_a_fit_learns_and_its_gradient_is_that_of_the_loss(spark):
    rows = splits(spark)
    fit = epochs.fit_epochs(rows, features=64, rate=2.0, max_epochs=40, patience=5)
    predicted = epochs.apply_epochs(fit.model, rows.filter("split = 'test'"))
    assert accuracy(predicted).first()["accuracy"] == 1.0
    losses = [r["value"] for r in fit.log.filter("metric = 'train_loss'").orderBy("step").collect()]
    assert losses[0] == pytest.approx(math.log(2)) and all(b < a for a, b in zip(losses, losses[1:]))
    narrow = rows.filter("split = 'train'").select((F.col("label") == "Yes").cast("int").alias("y"), F.lit(1.0).alias("weight"), F.lit(True).alias("train"), "input_text")
    staged = epochs.hashed_counts(narrow, 64, ["y", "weight", "train"]).cache()
    weights = np.random.default_rng(0).normal(size=(65, 2))
    gradient, _ = epochs._epoch(staged, weights)
    for i, j in ((64, 0), (64, 1), *[(int(k), 0) for k in np.argsort(-np.abs(gradient[:, 0]))[:3]]):
        moved = []
        for step in (1e-5, -1e-5):
            w = weights.copy()
            w[i, j] += step
            moved.append(epochs._epoch(staged, w)[1][0])
        assert (moved[0] - moved[1]) / 2e-5 == pytest.approx(gradient[i, j], abs=1e-6)


def test_a_fit_without_validation_and_odd_rows(spark):
    rows = spark.createDataFrame(
        [(1, "a b", "x", "train"), (2, None, "y", "train"), (3, "", "x", "train"), (4, "b", None, "train"), (5, "a", "new", "val")],
        "example_id long, input_text string, label string, split string",
    )
    fit = epochs.fit_epochs(rows, features=8, max_epochs=4)
    assert fit.model.labels == ["x", "y"] and fit.best == 4
    assert epochs.apply_epochs(fit.model, rows).count() == 5
    with pytest.raises(ValueError, match="labels among"):
        epochs.fit_epochs(rows.filter("split = 'val'"))


def test_epoch_bundle(spark, tmp_path):
    fit = epochs.fit_epochs(splits(spark), features=64, max_epochs=3)
    epochs.save_epochs(spark, fit.model, str(tmp_path / "m"))
    again = epochs.load_epochs(spark, str(tmp_path / "m"))
    assert again.labels == fit.model.labels and (again.weights == fit.model.weights).all()


def test_label_model_bundle(spark, tmp_path):
    rows = corpus(spark, 60)
    model = training.train_label_model(rows, features=1 << 8, max_iter=5)
    training.save_label_model(spark, model, str(tmp_path / "m"))
    again = training.load_label_model(spark, str(tmp_path / "m"))
    first, second = (sorted(map(tuple, training.apply_label_model(m, rows).collect())) for m in (model, again))
    assert first == second and list(again.labels) == list(model.labels)


def test_labelling_goes_on_where_it_ended(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("example_id"), F.concat(F.lit("t"), "id").alias("input_text"), F.lit(None).cast("string").alias("label"))
    calls = tmp_path / "calls"
    calls.mkdir()

    def counting(stop_after):
        def load():
            import os
            import uuid

            def model(texts):
                (calls / f"{len(texts)}-{uuid.uuid4().hex}").touch()
                if stop_after is not None and len(os.listdir(calls)) > stop_after:
                    raise RuntimeError("killed")
                return np.array([t.upper() for t in texts], dtype=object)

            return model

        return load

    def predicted():
        return sum(int(p.name.split("-")[0]) for p in calls.iterdir())

    path = str(tmp_path / "labels")
    options = {"buckets": 8, "per_job": 1, "batch_size": 1000}
    with pytest.raises(Exception, match="killed"):
        I.label_in_buckets(rows, counting(4), path, **options)
    finished = [p.name for p in (tmp_path / "labels" / "manifest").iterdir() if p.name != "pool"]
    assert 0 < len(finished) < 8
    kept = spark.read.parquet(*[f"{path}/labels/{n}" for n in finished]).count()
    for p in calls.iterdir():
        p.unlink()
    done = I.label_in_buckets(rows, counting(None), path, **options)
    assert predicted() == 400 - kept  # rows of finished buckets are not predicted again
    assert sorted(r["predicted"] for r in done.collect()) == sorted(f"T{i}" for i in range(400))
    I.label_in_buckets(rows, counting(0), path, **options)  # all done: no call
    with pytest.raises(ValueError, match="another number"):
        I.label_in_buckets(rows, counting(None), path, buckets=9)


def test_sparse_rows_of_a_model(spark):
    def load():
        return lambda texts: np.array([[1.0, 5.0, 5.0, 2.0] * 2 for _ in texts])

    rows = spark.createDataFrame([(1, "a", "x"), (2, None, None)], "example_id long, input_text string, label string")
    got = I.predict_sparse_scores(rows, load, 2, 4, top=2, wanted=[3, 1, 99]).collect()
    assert len(got) == 4
    for r in got:
        assert (r["logits"]["ids"], r["logits"]["z"], r["logits"]["top"]) == ([1, 2, 3], [5.0, 5.0, 2.0], 2)
        assert r["logits"]["lse"] == pytest.approx(math.log(2 * math.exp(5) + math.exp(1) + math.exp(2)))
    with pytest.raises(Exception, match="must give 10 scores"):
        I.predict_sparse_scores(rows, load, 2, 5, top=2).collect()
    few = I.predict_sparse_scores(rows, load, 2, 4, top=2)
    with pytest.raises(Exception, match="must hold the 3 best"):
        I.sample_labels(few, 2, 1, top_k=3).collect()


def test_table_of_tokens():
    rng = np.random.default_rng(5)
    names = sorted({"".join(map(chr, rng.integers(97, 101, rng.integers(1, 7)))) + "é" * int(rng.integers(0, 2)) for _ in range(4000)})
    held = names[::2]
    table = lookup.TokenTable(pa.array(held))
    texts = [" ".join(rng.choice(names, 50)).encode() + b"\t\n", None, b"", b" ", b"one-long-" + b"x" * 3_000_000]
    words = lookup.Words.of(texts)
    asked = [t for x in texts for t in re.split(rb"[ \t\n\r\f]+", x or b"") if t]
    places = {t.encode(): i for i, t in enumerate(held)}
    assert table.find(words).tolist() == [places.get(t, -1) for t in asked]
    assert words.counts.tolist() == [50, 0, 0, 0, 1]
    assert table.joined(np.array([3, 1, 0]), np.array([0, 2, 0, 1])).to_pylist() == ["", f"{held[3]} {held[1]}", "", held[0]]


def test_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(lookup.Words, "hashes", lambda self: np.zeros(len(self.starts), dtype=np.uint64))
    table = lookup.TokenTable(pa.array(["ab", "cd", "abc"]))
    assert table.find(lookup.Words.of([b"abc cd xy ab abcd"])).tolist() == [2, 1, -1, 0, -1]


def test_token_counts_by_group(spark, train, monkeypatch):
    monkeypatch.setattr(lookup, "HELD_TOKENS", 2)
    got = {tuple(r)[:3]: r["count"] for r in lookup.count_tokens(train, "input_text", ["trial", "label"]).collect()}
    expected = Counter((t, label, w) for _, t, text, label in ROWS for w in tokens(text))
    assert got == expected
