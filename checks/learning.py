"""Models that SQL can follow: naive Bayes, transfer, trials, self-training, a fit with validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.models import FIT, TOKENS
from checks.registry import query, tidy
from checks.sampling import ranked, sizes
from checks.views import h, with_views
from labelkit.operators import bayes, epochs, training
from labelkit.operators.metrics import accuracy, best_checkpoint, early_stop_point
from labelkit.operators.splits import SplitSpec, normal_split, pseudo_split, source_pool
from labelkit.plans.experiments import self_training, transfer_trials
from labelkit.session import scratch_path

SOURCE = SplitSpec(task_ids=range(10), test_frac=0.3, val_frac=0.3)
TARGET = SplitSpec(task_ids=range(10, 20))


def bayes_sql(name: str, train: str, rows: str, alpha: float, groups: str = "", source: str | None = None, weight: float = 0.0) -> dict[str, str]:
    """CTEs of a model of ``train`` (label, input_text) applied to ``rows`` (example_id, input_text, label).

    ``{name}_best`` has the best label of each row.  ``source`` names another model, whose
    counts are added ``weight`` times.
    """
    g = f"{groups}, " if groups else ""
    on = f"USING ({g}label)"
    same = f"USING ({groups})" if groups else "ON true"
    cte = {
        f"{name}_d": f"SELECT {g}label, count(*)::DOUBLE AS d FROM {train} WHERE label IS NOT NULL GROUP BY {g}label",
        f"{name}_t": f"""SELECT {g}label, token, count(*)::DOUBLE AS n FROM (
            SELECT {g}label, unnest({TOKENS.format("coalesce(input_text, '')")}) AS token FROM {train} WHERE label IS NOT NULL) GROUP BY {g}label, token""",
    }
    if source is not None:
        every = f"(SELECT DISTINCT {groups} FROM {name}_d)" if groups else "(SELECT 1)"
        cte |= {
            f"{name}_docs": f"""SELECT {g}label, sum(d) AS d FROM (SELECT {g}label, d FROM {name}_d
                UNION ALL SELECT {g}label, d * {weight!r}::DOUBLE FROM {source}_docs, {every}) GROUP BY {g}label""",
            f"{name}_n": f"""SELECT {g}label, token, sum(n) AS n FROM (SELECT {g}label, token, n FROM {name}_t
                UNION ALL SELECT {g}label, token, n * {weight!r}::DOUBLE FROM {source}_n, {every}) GROUP BY {g}label, token""",
        }
    else:
        cte |= {f"{name}_docs": f"SELECT * FROM {name}_d", f"{name}_n": f"SELECT * FROM {name}_t"}
    total = f"(PARTITION BY {groups})" if groups else "()"
    cte |= {
        f"{name}_v": f"SELECT {g}count(*) AS v FROM (SELECT DISTINCT {g}token FROM {name}_n) " + (f"GROUP BY {groups}" if groups else ""),
        f"{name}_labels": f"""SELECT *, ln(d / sum(d) OVER {total}) AS prior FROM {name}_docs
            LEFT JOIN (SELECT {g}label, sum(n) AS total FROM {name}_n GROUP BY {g}label) {on} JOIN {name}_v {same}""",
        f"{name}_w": f"""SELECT {g}label, token, ln((coalesce(n, 0) + {alpha!r}::DOUBLE) / (coalesce(total, 0) + {alpha!r}::DOUBLE * v)) AS w
            FROM {name}_labels JOIN (SELECT DISTINCT {g}token FROM {name}_n) {same} LEFT JOIN {name}_n USING ({g}label, token)""",
        f"{name}_i": f"""SELECT example_id, token, count(*) AS c FROM (
            SELECT example_id, unnest({TOKENS.format("coalesce(input_text, '')")}) AS token FROM {rows}) GROUP BY example_id, token""",
        f"{name}_s": f"""SELECT {g}example_id, label, sum(c * w) AS s, sum(c) AS known FROM {name}_i JOIN {name}_w USING (token)
            GROUP BY {g}example_id, label""",
        f"{name}_p": f"""SELECT {g}r.example_id, r.label AS truth, l.label, round(prior + coalesce(s, 0), 9) AS s, greatest(coalesce(known, 0), 1) AS known
            FROM {rows} r JOIN {name}_labels l ON true LEFT JOIN {name}_s x ON x.example_id = r.example_id AND x.label = l.label
            {"AND x." + groups + " = l." + groups if groups else ""}""".replace(f"{g}r.example_id", f"{'l.' + g if groups else ''}r.example_id"),
        f"{name}_best": f"""SELECT {g}example_id, list(label ORDER BY s DESC, label)[1] AS predicted, any_value(truth) AS ground_truth,
            1e0 / sum(exp(s - m)) AS score, (max(s) - list(s ORDER BY s DESC, label)[2]) / any_value(known)::DOUBLE AS margin
            FROM (SELECT *, max(s) OVER (PARTITION BY {g}example_id) AS m FROM {name}_p) GROUP BY {g}example_id""",
    }
    return cte


def _split(name: str, where: str, seed: int, test: str, val: str, source: str = "labelled") -> dict[str, str]:
    """``{name}_sized``: rows of a split with their rank rk, t test rows, v validation rows, k kept rows."""
    return {f"{name}_ranked": ranked(source, seed, "split", where), f"{name}_sized": sizes(test, val, "1e0", f"{name}_ranked")}


BEST = "SELECT example_id, predicted, ground_truth, round(score, 6) AS score, round(margin, 6) AS margin FROM {}"
OF_TARGET = "task_id >= 10 AND task_id < 20"
OF_SOURCE = "task_id < 10"


def _whole(best):
    return tidy(best.select("example_id", "predicted", "ground_truth", "score", "margin"))


NORMAL = _split("tg", OF_TARGET, 1, "0.2e0", "0.15e0") | {
    "tg_train": "SELECT * FROM tg_sized WHERE rk > t + v AND rk <= t + k",
    "tg_val": "SELECT * FROM tg_sized WHERE rk > t AND rk <= t + v",
    "tg_test": "SELECT * FROM tg_sized WHERE rk <= t",
}


@query("bayes_label_model", with_views(BEST.format("m_best"), "labelled", **NORMAL, **bayes_sql("m", "tg_train", "tg_test", 0.5)))
def bayes_label_model(spark, sf_dir):
    rows = normal_split(V.labelled(spark, sf_dir), TARGET)
    model = bayes.fit_bayes(rows.filter("split = 'train'"), alpha=0.5)
    return _whole(bayes.predict_bayes(model, rows.filter("split = 'test'")))


@query("bayes_model_roundtrip", with_views(BEST.format("m_best"), "labelled", **NORMAL, **bayes_sql("m", "tg_train", "tg_test", 0.5)))
def bayes_model_roundtrip(spark, sf_dir):
    """As above, with the model read back from a saved bundle."""
    rows = normal_split(V.labelled(spark, sf_dir), TARGET)
    path = scratch_path(spark, "bayes")
    bayes.save_bayes(bayes.fit_bayes(rows.filter("split = 'train'"), alpha=0.5), path)
    return _whole(bayes.predict_bayes(bayes.load_bayes(spark, path), rows.filter("split = 'test'")))


POOL = _split("sr", OF_SOURCE, 1, "0.3e0", "0.3e0") | {
    "sr_train": "SELECT * FROM sr_sized WHERE rk <= t OR (rk > t + v AND rk <= t + k)",
}
FEW = _split("fw", OF_TARGET, 1, "0.2e0", "0.15e0") | {
    "fw_test": "SELECT * FROM fw_sized WHERE rk <= t",
    "fw_labeled": "SELECT * FROM fw_sized WHERE rk > t + v AND rk <= t + least(v + 50, k)",
    "fw_unlabeled": "SELECT * FROM fw_sized WHERE rk > t + least(v + 50, k) AND rk <= t + k",
}


@query("bayes_transfer", with_views(
    BEST.format("m_best"), "labelled", **POOL, **FEW,
    **bayes_sql("s", "sr_train", "(SELECT * FROM fw_test LIMIT 0)", 1.0),
    **bayes_sql("m", "fw_labeled", "fw_test", 1.0, source="s", weight=0.1)))
def bayes_transfer(spark, sf_dir):
    """Few labelled target rows, with the counts of the source pool as pseudo-counts."""
    df = V.labelled(spark, sf_dir)
    splits = pseudo_split(df, TARGET, 50)
    source = bayes.fit_bayes(source_pool(df, SOURCE).filter("split = 'train'"))
    model = bayes.fit_bayes(splits.filter("split = 'train_labeled'"), source=source, source_weight=0.1)
    return _whole(bayes.predict_bayes(model, splits.filter("split = 'test'")))


TRIALS = {
    "tr_ranked": f"""SELECT *, count(*) OVER (PARTITION BY trial) AS n,
            row_number() OVER (PARTITION BY trial ORDER BY md5(trial || ':split:' || example_id), example_id) AS rk
        FROM labelled, (SELECT unnest([1, 2, 3])::BIGINT AS trial) WHERE {OF_TARGET}""",
    "tr_sized": sizes("0.2e0", "0.15e0", "1e0", "tr_ranked"),
    "tr_train": "SELECT * FROM tr_sized WHERE rk > t + v AND rk <= t + k",
    "tr_rows": "SELECT DISTINCT example_id, input_text, label FROM tr_sized WHERE rk <= t",
}


@query("transfer_trials", with_views(
    """SELECT 'transfer' AS run, round(avg(a), 6) AS avg_acc, round(stddev_pop(a), 6) AS std,
              string_agg(CAST(round(a, 6) AS VARCHAR), ',' ORDER BY trial) AS accuracies
       FROM (SELECT trial, avg(CASE WHEN predicted = ground_truth THEN 1e0 ELSE 0e0 END) AS a
             FROM m_best JOIN (SELECT trial, example_id FROM tr_sized WHERE rk <= t) USING (trial, example_id) GROUP BY trial)""",
    "labelled", **POOL, **TRIALS,
    **bayes_sql("s", "sr_train", "(SELECT * FROM tr_rows LIMIT 0)", 1.0),
    **bayes_sql("m", "tr_train", "tr_rows", 1.0, "trial", "s", 0.1)))
def trials_of_transfer(spark, sf_dir):
    summary = transfer_trials(V.labelled(spark, sf_dir), SOURCE, TARGET, trials=3, run="transfer")
    return tidy(summary.withColumn("accuracies", F.transform("accuracies", lambda a: F.round(a, 6))).select("run", "avg_acc", "std", "accuracies"))


THETA, ROUNDS = 0.02, 4


def _self_training_sql() -> dict[str, str]:
    """Round after round of the loop, unrolled."""
    ctes = {"r0_pseudo": "SELECT example_id, input_text, label, 0 AS round, '' AS ground_truth, 0e0 AS score, 0e0 AS margin FROM fw_unlabeled LIMIT 0"}
    for r in range(1, ROUNDS + 1):
        before = " UNION ALL ".join(f"SELECT * FROM r{i}_pseudo" for i in range(r))
        ctes[f"r{r}_train"] = f"SELECT label, input_text FROM fw_labeled UNION ALL SELECT label, input_text FROM ({before})"
        ctes[f"r{r}_left"] = f"SELECT * FROM fw_unlabeled WHERE example_id NOT IN (SELECT example_id FROM ({before}))"
        ctes |= bayes_sql(f"r{r}", f"r{r}_train", f"r{r}_left", 1.0)
        ctes[f"r{r}_pseudo"] = f"""SELECT b.example_id, input_text, predicted AS label, {r} AS round, ground_truth, score, margin
            FROM r{r}_best b JOIN fw_unlabeled USING (example_id) WHERE margin >= {THETA!r}::DOUBLE"""
    return ctes


PSEUDO = " UNION ALL ".join(f"SELECT * FROM r{r}_pseudo" for r in range(1, ROUNDS + 1))


@query("self_training", with_views(
    f"""SELECT example_id, CAST(round AS BIGINT) AS round, label AS predicted, ground_truth, round(score, 6) AS score, round(margin, 6) AS margin
        FROM ({PSEUDO})""", "labelled", **FEW, **_self_training_sql()))
def rounds_of_self_training(spark, sf_dir):
    splits = pseudo_split(V.labelled(spark, sf_dir), TARGET, 50)
    done = self_training(splits.filter("split = 'train_labeled'"), splits.filter("split = 'train_unlabeled'"), THETA, ROUNDS)
    return tidy(done.pseudo)


@query("self_training_model", with_views(
    BEST.format("m_best"), "labelled", **FEW, **_self_training_sql(),
    last=f"SELECT label, input_text FROM fw_labeled UNION ALL SELECT label, input_text FROM ({PSEUDO})",
    **bayes_sql("m", "last", "fw_test", 1.0)))
def model_of_self_training(spark, sf_dir):
    """Test rows under the model that learnt from its own confident labels."""
    splits = pseudo_split(V.labelled(spark, sf_dir), TARGET, 50)
    done = self_training(splits.filter("split = 'train_labeled'"), splits.filter("split = 'train_unlabeled'"), THETA, ROUNDS)
    return _whole(bayes.predict_bayes(done.model, splits.filter("split = 'test'")))


FEATURES, RATE, EPOCHS, PATIENCE = 256, 2.0, 6, 2


def _epochs_sql() -> dict[str, str]:
    """Gradient steps of a softmax regression on hashed features, unrolled."""
    ctes = {
        "fit_rows": "SELECT example_id, label, input_text, rk > t + v AS train FROM tg_sized WHERE rk > t AND rk <= t + k",
        "names": "SELECT label, row_number() OVER (ORDER BY label) AS c FROM (SELECT DISTINCT label FROM fit_rows WHERE train)",
        "cells": f"""SELECT example_id, cell, count(*)::DOUBLE AS n FROM (SELECT example_id, {h('token')} % {FEATURES} AS cell FROM (
            SELECT example_id, unnest({TOKENS.format("coalesce(input_text, '')")}) AS token FROM tg_sized)) GROUP BY example_id, cell""",
        "x": "SELECT example_id, cell, n / sqrt(sum(n * n) OVER (PARTITION BY example_id)) AS x FROM cells",
        "w0": f"SELECT cell, label, 0e0 AS w FROM (SELECT unnest(range({FEATURES + 1})) AS cell), names",
    }
    for e in range(EPOCHS + 1):
        ctes |= _scores_sql(f"e{e}", f"w{e}", "fit_rows")
        ctes[f"l{e}"] = f"""SELECT {e} AS step, avg(l) FILTER (train) AS train_loss, avg(l) FILTER (NOT train) AS val_loss
            FROM (SELECT train, -ln(p) AS l FROM e{e}_p JOIN fit_rows USING (example_id) WHERE e{e}_p.name = fit_rows.label)"""
        ctes[f"g{e}"] = f"""SELECT cell, name AS label, sum(x * d) / (SELECT count(*) FROM fit_rows WHERE train) AS g FROM (
              SELECT example_id, name, p - CASE WHEN name = fit_rows.label THEN 1e0 ELSE 0e0 END AS d
              FROM e{e}_p JOIN fit_rows USING (example_id) WHERE train)
            JOIN (SELECT * FROM x UNION ALL SELECT example_id, {FEATURES}, 1e0 FROM fit_rows) USING (example_id) GROUP BY cell, name"""
        ctes[f"w{e + 1}"] = f"SELECT cell, label, w - {RATE!r}::DOUBLE * coalesce(g, 0) AS w FROM w{e} LEFT JOIN g{e} USING (cell, label)"
    every = " UNION ALL ".join(f"SELECT * FROM l{e}" for e in range(EPOCHS + 1))
    ctes["losses"] = f"SELECT *, min(val_loss) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM ({every})"
    ctes["better"] = "SELECT *, max(CASE WHEN low IS NULL OR val_loss < low THEN step END) OVER (ORDER BY step) AS best FROM losses"
    ctes["ran"] = f"SELECT * FROM better WHERE step <= coalesce((SELECT min(step) FROM better WHERE step - best >= {PATIENCE}), {EPOCHS})"
    return ctes


def _scores_sql(name: str, weights: str, rows: str) -> dict[str, str]:
    return {
        f"{name}_z": f"""SELECT r.example_id, b.label AS name, b.w + coalesce(z, 0) AS z
            FROM {rows} r JOIN (SELECT * FROM {weights} WHERE cell = {FEATURES}) b ON true
            LEFT JOIN (SELECT example_id, label, sum(x * w) AS z FROM x JOIN {weights} USING (cell) GROUP BY example_id, label) s
              ON s.example_id = r.example_id AND s.label = b.label""",
        f"{name}_p": f"""SELECT example_id, name, exp(z - m) / sum(exp(z - m)) OVER (PARTITION BY example_id) AS p
            FROM (SELECT *, max(z) OVER (PARTITION BY example_id) AS m FROM {name}_z)""",
    }


def _fit(spark, sf_dir):
    rows = normal_split(V.labelled(spark, sf_dir), TARGET)
    return rows, epochs.fit_epochs(rows, FEATURES, RATE, max_epochs=EPOCHS, patience=PATIENCE)


@query("fit_with_validation", with_views(
    """SELECT step::BIGINT AS step, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss,
              CAST(step = (SELECT max(best) FROM ran) AS BIGINT) AS is_best FROM ran""", "labelled", **NORMAL, **_epochs_sql()))
def fit_with_validation(spark, sf_dir):
    """Losses of every epoch, with the best one as the checkpoint operator finds it."""
    _, fit = _fit(spark, sf_dir)
    best = best_checkpoint(fit.log).select(F.col("step").alias("best"))  # one run, one row
    wide = fit.log.groupBy("step").pivot("metric", ["train_loss", "val_loss"]).agg(F.first("value"))
    return tidy(wide.join(F.broadcast(best.withColumnRenamed("best", "step").withColumn("is_best", F.lit(1))), "step", "left").fillna(0, ["is_best"]))


@query("fit_stops_early", with_views(
    """SELECT 1::BIGINT AS run_id, count(*) AS n_checks, max(best)::BIGINT AS best_step,
              CASE WHEN max(step) - max(best) >= 2 THEN max(step) END::BIGINT AS stop_step FROM ran""", "labelled", **NORMAL, **_epochs_sql()))
def fit_stops_early(spark, sf_dir):
    """The log of the fit as the two checkpoint operators read it."""
    _, fit = _fit(spark, sf_dir)
    stop = early_stop_point(fit.log, PATIENCE).select("run_id", "n_checks", "stop_step")
    return tidy(stop.join(best_checkpoint(fit.log).select("run_id", F.col("step").alias("best_step")), "run_id"))


@query("validated_predictions", with_views(
    "SELECT example_id, list(name ORDER BY round(p, 12) DESC, name)[1] AS predicted, any_value(label) AS ground_truth, round(max(p), 6) AS score"
    " FROM f_p JOIN tg_test USING (example_id) GROUP BY example_id",
    "labelled", **NORMAL, **_epochs_sql(),
    kept=" UNION ALL ".join(f"SELECT * FROM w{e} WHERE {e} = (SELECT max(best) FROM ran)" for e in range(EPOCHS + 1)),
    **_scores_sql("f", "kept", "tg_test")))
def validated_predictions(spark, sf_dir):
    """Test rows under the weights of the best epoch, read back from a saved bundle."""
    rows, fit = _fit(spark, sf_dir)
    path = scratch_path(spark, "epochs")
    epochs.save_epochs(spark, fit.model, path)
    return tidy(epochs.apply_epochs(epochs.load_epochs(spark, path), rows.filter("split = 'test'")))


@query("label_model_beats_majority", with_views(
    """SELECT count(*) AS n_examples, round(max(n) / sum(n)::DOUBLE, 6) AS majority, 1::BIGINT AS beats, 0::BIGINT AS n_changed
       FROM (SELECT label, count(*) AS n FROM all_labelled GROUP BY label)""".replace("count(*) AS n_examples", "sum(n)::BIGINT AS n_examples"),
    "labelled", all_labelled="SELECT * FROM labelled WHERE task_id < 20"))
def label_model_beats_majority(spark, sf_dir):
    """The regression, saved and loaded, against the most frequent label on the rows it learnt from."""
    rows = V.labelled(spark, sf_dir).filter("task_id < 20")
    model = training.train_label_model(rows, balanced=False, **FIT)
    path = scratch_path(spark, "label-model")
    training.save_label_model(spark, model, path)
    own = training.apply_label_model(model, rows)
    again = training.apply_label_model(training.load_label_model(spark, path), rows).select("example_id", F.col("predicted").alias("_again"))
    right = accuracy(own).select(F.col("accuracy").alias("_own"), "n_examples")
    most = rows.groupBy("label").count().agg((F.max("count") / F.sum("count")).alias("majority"))
    changed = own.join(again, "example_id").filter(~F.col("predicted").eqNullSafe(F.col("_again"))).agg(F.count(F.lit(1)).alias("n_changed"))
    one = F.lit(1)
    joined = right.withColumn("_k", one).join(most.withColumn("_k", one), "_k").join(changed.withColumn("_k", one), "_k")  # one row each
    return tidy(joined.select("n_examples", "majority", (F.col("_own") >= F.col("majority")).cast("long").alias("beats"), "n_changed"))
