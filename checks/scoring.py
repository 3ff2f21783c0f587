"""Confidences, votes, accuracies and training logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query, tidy
from checks.views import with_views
from labelkit.functions import scores
from labelkit.functions.encoding import IGNORE_ID
from labelkit.operators import confidence as C
from labelkit.operators import metrics as M
from labelkit.operators import votes as W
from labelkit.operators.relations import prediction_table

EXPS = "list_transform(logits, lambda z: exp(z - list_max(logits)))"


def _scored(spark, sf_dir):
    return C.best_label(V.logits(spark, sf_dir), V.ID2LABEL)


def _judged(spark, sf_dir):
    best = C.best_label(V.logits(spark, sf_dir), V.ID2LABEL, keep=["target"])
    labels = F.create_map(*[F.lit(x) for pair in V.ID2LABEL.items() for x in pair])
    return prediction_table(best.withColumn("truth", F.element_at(labels, F.col("target"))), "label", "truth")


WANTED = sorted(V.ID2LABEL)


def _sparse(spark, sf_dir, top=3):
    """Logits as rows of the best classes and those of the labels."""
    return V.logits(spark, sf_dir).withColumn("logits", scores.sparse(F.col("logits"), top, WANTED))


def _sparse_steps(spark, sf_dir):
    return V.step_logits(spark, sf_dir).withColumn("logits", scores.sparse(F.col("logits"), 1, WANTED))


@query("sparse_softmax", with_views(
    f"""SELECT example_id, id, round(e[id + 1] / list_sum(e), 6) AS p FROM (
          SELECT example_id, e, unnest(range(64)) AS id FROM x)
        QUALIFY row_number() OVER (PARTITION BY example_id ORDER BY e[id + 1] DESC, id) <= 3 OR id IN ({', '.join(map(str, WANTED))})""",
    "logits", x=f"SELECT example_id, {EXPS} AS e FROM logits"))
def sparse_softmax(spark, sf_dir):
    p = _sparse(spark, sf_dir).select("example_id", F.explode(scores.sparse_softmax(F.col("logits"))).alias("_p"))
    return tidy(p.select("example_id", "_p.id", "_p.p"))


@query("sparse_best_label", with_views(
    "SELECT example_id, CAST(token AS BIGINT) AS token, label, round(score, 6) AS score FROM confidence", "confidence"))
def sparse_best_label(spark, sf_dir):
    return tidy(C.best_label(_sparse(spark, sf_dir), V.ID2LABEL))


@query("sparse_label_probabilities", with_views(
    f"SELECT example_id, {', '.join(f'round(e[{i + 1}] / list_sum(e), 6) AS p_{label}' for label, i in V.LABEL2ID.items())} FROM x",
    "logits", x=f"SELECT example_id, {EXPS} AS e FROM logits"))
def sparse_label_probabilities(spark, sf_dir):
    return tidy(C.label_probabilities(_sparse(spark, sf_dir), V.LABEL2ID))


@query("sparse_sequence_confidence", with_views(
    f"""SELECT example_id, round(max(1e0 / list_sum({EXPS})), 6) AS score,
               string_agg(CAST(list_position(logits, list_max(logits)) - 1 AS VARCHAR), ',' ORDER BY step) AS tokens
        FROM step_logits GROUP BY example_id""", "step_logits"))
def sparse_sequence_confidence(spark, sf_dir):
    return tidy(C.sequence_confidence(_sparse_steps(spark, sf_dir)))


@query("sparse_cross_entropy", with_views(
    f"""SELECT example_id, round(avg(ln(list_sum({EXPS})) + list_max(logits) - logits[target + 1]), 6) AS loss,
               count(*) AS n_positions
        FROM step_logits WHERE step % 3 <> 2 GROUP BY example_id""", "step_logits"))
def sparse_cross_entropy(spark, sf_dir):
    masked = _sparse_steps(spark, sf_dir).withColumn(
        "target", F.when(F.col("step") % 3 == 2, IGNORE_ID).otherwise(F.col("target"))
    )
    return tidy(M.cross_entropy(masked, by=["example_id"]))


@query("softmax", with_views(
    f"SELECT example_id, {', '.join(f'round(e[{i + 1}] / list_sum(e), 6) AS p_{i}' for i in range(64))} FROM x",
    "logits", x=f"SELECT example_id, {EXPS} AS e FROM logits"))
def softmax(spark, sf_dir):
    p = V.logits(spark, sf_dir).select("example_id", scores.softmax(F.col("logits")).alias("p"))
    return tidy(p.select("example_id", *[F.get("p", F.lit(i)).alias(f"p_{i}") for i in range(64)]))


@query("best_label", with_views(
    "SELECT example_id, CAST(token AS BIGINT) AS token, label, round(score, 6) AS score FROM confidence", "confidence"))
def best_label(spark, sf_dir):
    return tidy(_scored(spark, sf_dir))


@query("label_probabilities", with_views(
    f"SELECT example_id, {', '.join(f'round(e[{i + 1}] / list_sum(e), 6) AS p_{label}' for label, i in V.LABEL2ID.items())} FROM x",
    "logits", x=f"SELECT example_id, {EXPS} AS e FROM logits"))
def label_probabilities(spark, sf_dir):
    return tidy(C.label_probabilities(V.logits(spark, sf_dir), V.LABEL2ID))


@query("map_tokens", with_views(
    """SELECT example_id, CAST(token AS BIGINT) AS token, CASE WHEN label <> '5' THEN label END AS label,
              CASE WHEN label <> '5' THEN 0::BIGINT ELSE 1::BIGINT END AS unknown_token
       FROM confidence""", "confidence"))
def map_tokens(spark, sf_dir):
    known = {i: label for i, label in V.ID2LABEL.items() if label != "5"}
    return tidy(C.map_tokens(_scored(spark, sf_dir).select("example_id", "token"), known))


@query("sequence_confidence", with_views(
    f"""SELECT example_id, round(max(1e0 / list_sum({EXPS})), 6) AS score,
               string_agg(CAST(list_position(logits, list_max(logits)) - 1 AS VARCHAR), ',' ORDER BY step) AS tokens
        FROM step_logits GROUP BY example_id""", "step_logits"))
def sequence_confidence(spark, sf_dir):
    return tidy(C.sequence_confidence(V.step_logits(spark, sf_dir)))


@query("first_step_scores", with_views(
    f"SELECT example_id, {', '.join(f'round(logits[{i + 1}], 6) AS z_{i}' for i in range(64))} FROM step_logits WHERE step = 0",
    "step_logits"))
def first_step_scores(spark, sf_dir):
    first = C.first_step_scores(V.step_logits(spark, sf_dir))
    return tidy(first.select("example_id", *[F.get("logits", F.lit(i)).alias(f"z_{i}") for i in range(64)]))


@query("confidence_rank", with_views(
    """SELECT example_id, round(score, 6) AS score, row_number() OVER (ORDER BY score, example_id) AS rank_low,
              row_number() OVER (ORDER BY score DESC, example_id) AS rank_high
       FROM confidence""", "confidence"))
def confidence_rank(spark, sf_dir):
    df = _scored(spark, sf_dir)
    low = C.rank_by_confidence(df).withColumnRenamed("rank", "rank_low")
    high = C.rank_by_confidence(df, ascending=False).select("example_id", F.col("rank").alias("rank_high"))
    return tidy(low.join(high, "example_id"))


@query("least_confident", with_views(
    """SELECT c.example_id, l.target::BIGINT AS target, round(c.score, 6) AS score
       FROM confidence c JOIN logits l ON l.example_id = c.example_id ORDER BY c.score, c.example_id LIMIT 100""",
    "confidence"))
def least_confident(spark, sf_dir):
    examples = V.logits(spark, sf_dir).select("example_id", "target")
    return tidy(C.least_confident(_scored(spark, sf_dir), examples, 100))


@query("auto_label", with_views(
    """SELECT j.example_id, predicted, ground_truth FROM judged j JOIN confidence c ON c.example_id = j.example_id
       WHERE c.score >= 0.4e0""", "judged"))
def auto_label(spark, sf_dir):
    return tidy(C.auto_label(_scored(spark, sf_dir), _judged(spark, sf_dir), 0.4))


@query("auto_label_accuracy", with_views(
    """SELECT round(avg(CASE WHEN predicted = ground_truth THEN 1e0 ELSE 0e0 END), 6) AS accuracy, count(*) AS n_examples
       FROM judged j JOIN confidence c ON c.example_id = j.example_id WHERE c.score >= 0.4e0""", "judged"))
def auto_label_accuracy(spark, sf_dir):
    return tidy(C.auto_label_accuracy(_scored(spark, sf_dir), _judged(spark, sf_dir), 0.4))


GRID = C.threshold_grid()
GRID_SQL = ", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(GRID))


@query("coverage_curve", with_views(
    """SELECT CAST(t.point AS BIGINT) AS point, round(t.theta, 6) AS theta, count(s.score) AS kept,
              round(count(s.score) / (SELECT count(*) FROM scored)::DOUBLE, 6) AS coverage,
              round(avg(CASE WHEN s.score IS NULL THEN NULL WHEN s.predicted = s.ground_truth THEN 1e0 ELSE 0e0 END), 6) AS accuracy
       FROM thresholds t LEFT JOIN scored s ON s.score >= t.theta GROUP BY t.point, t.theta""",
    "judged",
    thresholds=f"SELECT * FROM (VALUES {GRID_SQL}) AS t(point, theta)",
    scored="SELECT c.score, j.predicted, j.ground_truth FROM confidence c JOIN judged j ON j.example_id = c.example_id"))
def coverage_curve(spark, sf_dir):
    return tidy(C.coverage_curve(_scored(spark, sf_dir), _judged(spark, sf_dir), GRID))


@query("cross_entropy", with_views(
    f"""SELECT example_id, round(avg(ln(list_sum({EXPS})) + list_max(logits) - logits[target + 1]), 6) AS loss,
               count(*) AS n_positions
        FROM step_logits WHERE step % 3 <> 2 GROUP BY example_id""", "step_logits"))
def cross_entropy(spark, sf_dir):
    masked = V.step_logits(spark, sf_dir).withColumn(
        "target", F.when(F.col("step") % 3 == 2, IGNORE_ID).otherwise(F.col("target"))
    )
    return tidy(M.cross_entropy(masked, by=["example_id"]))


@query("accuracy", with_views(
    """SELECT round(avg(CASE WHEN predicted = ground_truth THEN 1e0 ELSE 0e0 END), 6) AS accuracy, count(*) AS n_examples
       FROM predictions""", "predictions"))
def accuracy(spark, sf_dir):
    return tidy(M.accuracy(V.predictions(spark, sf_dir)))


@query("regression_scores", with_views(
    """SELECT round(avg((p - y) * (p - y)), 6) AS mse,
              round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
       FROM (SELECT predicted::DOUBLE AS p, ground_truth::DOUBLE AS y FROM predictions)""", "predictions"))
def regression_scores(spark, sf_dir):
    return tidy(M.regression_scores(V.predictions(spark, sf_dir)))


@query("majority_vote", with_views(
    """SELECT example_id, label, n AS n_votes, total_votes::BIGINT AS total_votes FROM (
         SELECT *, sum(n) OVER (PARTITION BY example_id) AS total_votes,
                row_number() OVER (PARTITION BY example_id ORDER BY n DESC, first) AS place
         FROM (SELECT example_id, label, count(*) AS n, min("order") AS first FROM votes GROUP BY example_id, label))
       WHERE place = 1""", "votes"))
def majority_vote(spark, sf_dir):
    return tidy(W.majority_vote(V.votes(spark, sf_dir), "order"))


WIDE = """
    SELECT m.example_id, m.predicted AS model_predicted, m.ground_truth AS model_truth,
           a.predicted AS a_predicted, a.ground_truth AS a_truth, b.predicted AS b_predicted, b.ground_truth AS b_truth
    FROM raters m JOIN raters a ON a.example_id = m.example_id AND a.rater = 'a'
                  JOIN raters b ON b.example_id = m.example_id AND b.rater = 'b'
    WHERE m.rater = 'model'"""


@query("align_raters", with_views("SELECT * FROM wide", "raters", wide=WIDE))
def align_raters(spark, sf_dir):
    return tidy(W.align_raters(V.raters(spark, sf_dir), V.RATERS))


@query("rater_ensemble", with_views(
    """SELECT example_id, a_truth AS ground_truth,
              CASE WHEN a_predicted = b_predicted THEN a_predicted ELSE model_predicted END AS predicted,
              CASE WHEN model_predicted = a_predicted AND a_predicted = b_predicted THEN 3::BIGINT
                   WHEN model_predicted = a_predicted OR a_predicted = b_predicted OR model_predicted = b_predicted
                   THEN 2::BIGINT ELSE 1::BIGINT END AS n_votes
       FROM wide""", "raters", wide=WIDE))
def rater_ensemble(spark, sf_dir):
    return tidy(W.rater_ensemble(V.raters(spark, sf_dir), V.RATERS, truth_of="a"))


@query("truth_conflicts", with_views(
    """SELECT w.example_id, model_truth, a_truth, b_truth, m.label AS master_truth
       FROM wide w JOIN master m ON m.example_id = w.example_id
       WHERE model_truth IS DISTINCT FROM a_truth OR a_truth IS DISTINCT FROM b_truth OR b_truth IS DISTINCT FROM m.label""",
    "raters", wide=WIDE))
def truth_conflicts(spark, sf_dir):
    return tidy(W.truth_conflicts(V.raters(spark, sf_dir), V.master(spark, sf_dir), V.RATERS))


@query("vote_accuracy", with_views(
    """SELECT round(avg(CASE WHEN label = ground_truth THEN 1e0 ELSE 0e0 END), 6) AS accuracy, count(*) AS n_examples
       FROM (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY n DESC, first) AS place
             FROM (SELECT example_id, ground_truth, label, count(*) AS n, min("order") AS first
                   FROM digit_votes GROUP BY example_id, ground_truth, label))
       WHERE place = 1 AND label <> 'x'""", "digit_votes"))
def vote_accuracy(spark, sf_dir):
    return tidy(W.vote_accuracy(V.digit_votes(spark, sf_dir), "order"))


@query("best_checkpoint", with_views(
    """SELECT run_id, step, round(value, 6) AS value FROM (
         SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY value, step) AS place
         FROM metric_log WHERE metric = 'click') WHERE place = 1""", "metric_log"))
def best_checkpoint(spark, sf_dir):
    return tidy(M.best_checkpoint(V.metric_log(spark, sf_dir), "click"))


@query("early_stop_point", with_views(
    """SELECT run_id, max(check_no) AS n_checks, min(CASE WHEN waited >= 5 THEN check_no END) AS stop_check,
              min(CASE WHEN waited >= 5 THEN step END) AS stop_step
       FROM (SELECT *, check_no - max(CASE WHEN better THEN check_no END) OVER (PARTITION BY run_id ORDER BY step) AS waited
             FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) AS check_no,
                          coalesce(value < min(value) OVER (PARTITION BY run_id ORDER BY step
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS better
                   FROM metric_log WHERE metric = 'click'))
       GROUP BY run_id""", "metric_log"))
def early_stop_point(spark, sf_dir):
    return tidy(M.early_stop_point(V.metric_log(spark, sf_dir), 5, "click"))
