"""Text encoding, model application, label sampling, training and whole experiments."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query, tidy
from checks.views import h, with_views
from labelkit.functions.encoding import mask_targets as mask_padding
from labelkit.functions.encoding import tokens
from labelkit.functions.scores import sparse
from labelkit.operators import inference as I
from labelkit.operators import text as T
from labelkit.operators import training
from labelkit.operators.confidence import best_label, first_step_scores, label_of, threshold_grid
from labelkit.operators.relations import prediction_table
from labelkit.operators.splits import SplitSpec, normal_split
from labelkit.plans.experiments import confidence_study, target_experiment, transfer_experiment
from labelkit.session import scratch_path

TOP = 5_000

TOKENS = "list_filter(string_split_regex(lower({}), '[ \\t\\n\\r\\f]+'), lambda t: t <> '')"
VOCAB_SQL = f"""
    SELECT token, row_number() OVER (ORDER BY n DESC, token) + 2 AS id, n AS count FROM (
      SELECT token, count(*) AS n FROM (
        SELECT unnest({TOKENS.format('input_text')}) AS token FROM master
        UNION ALL SELECT unnest({TOKENS.format('label')}) FROM master WHERE label IS NOT NULL)
      GROUP BY token)"""
ITEMS_SQL = f"""
    SELECT i.example_id, i.pos, coalesce(v.id, 2) AS id, v.token
    FROM (SELECT example_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos
          FROM (SELECT example_id, {TOKENS.format('input_text')} AS t FROM master)) i
    LEFT JOIN vocab v ON v.token = i.token"""


def _vocab(spark, sf_dir):
    return T.build_vocab(V.master(spark, sf_dir), ["input_text", "label"])


@query("build_vocab", with_views("SELECT token, id, count FROM vocab", "master", vocab=VOCAB_SQL))
def build_vocab(spark, sf_dir):
    return tidy(_vocab(spark, sf_dir))


@query("top_vocab", with_views(f"SELECT token, id, count FROM vocab WHERE id < {TOP + 3}", "master", vocab=VOCAB_SQL))
def top_vocab(spark, sf_dir):
    return tidy(T.build_vocab(V.master(spark, sf_dir), ["input_text", "label"], TOP))


ENCODE_SQL = with_views(
    """SELECT m.example_id, coalesce(string_agg(CAST(i.id AS VARCHAR), ',' ORDER BY i.pos), '') AS ids
       FROM master m LEFT JOIN items i ON i.example_id = m.example_id GROUP BY m.example_id""",
    "master", vocab=VOCAB_SQL, items=ITEMS_SQL)


@query("encode_text", ENCODE_SQL)
def encode_text(spark, sf_dir):
    return tidy(T.encode_text(V.master(spark, sf_dir), T.compact(_vocab(spark, sf_dir))))


@query("encode_text_by_join", ENCODE_SQL)
def encode_text_by_join(spark, sf_dir):
    """The way of a vocabulary too large for a dictionary."""
    return tidy(T.encode_text(V.master(spark, sf_dir), _vocab(spark, sf_dir)))


@query("decode_ids", with_views(
    """SELECT m.example_id, coalesce(string_agg(i.token, ' ' ORDER BY i.pos), '') AS text
       FROM master m LEFT JOIN items i ON i.example_id = m.example_id AND i.token IS NOT NULL GROUP BY m.example_id""",
    "master", vocab=VOCAB_SQL, items=ITEMS_SQL))
def decode_ids(spark, sf_dir):
    vocab = T.compact(_vocab(spark, sf_dir))
    return tidy(T.decode_ids(T.encode_text(V.master(spark, sf_dir), vocab), vocab))


def _padded(column: str, length: int) -> str:
    body = f"(list_concat(coalesce({column}, []::BIGINT[])[1:{length - 1}], [1::BIGINT]))"
    return f"list_concat({body}, list_transform(range({length} - len({body})), lambda x: 0::BIGINT))"


ENCODED_SQL = f"""
    SELECT example_id, {_padded('source', 512)} AS source_ids, {_padded('target', 16)} AS target_ids
    FROM (SELECT m.example_id, list(i.id ORDER BY i.pos) FILTER (i.id IS NOT NULL) AS source,
                 any_value(CASE WHEN m.label IS NULL THEN []::BIGINT[] ELSE [coalesce(l.id, 2)] END) AS target
          FROM master m LEFT JOIN items i ON i.example_id = m.example_id LEFT JOIN vocab l ON l.token = m.label
          GROUP BY m.example_id)"""


def _join(column: str, item: str = "x") -> str:
    return f"array_to_string(list_transform({column}, lambda x: {item}), ',')"


@query("pad_truncate", with_views(
    f"""SELECT example_id, {_join('source_ids')} AS source_ids, {_join('target_ids')} AS target_ids,
               {_join('source_ids', 'CASE WHEN x = 0 THEN 0 ELSE 1 END')} AS source_mask,
               {_join('target_ids', 'CASE WHEN x = 0 THEN 0 ELSE 1 END')} AS target_mask FROM encoded""",
    "master", vocab=VOCAB_SQL, items=ITEMS_SQL, encoded=ENCODED_SQL))
def pad_truncate(spark, sf_dir):
    return tidy(T.encode_examples(V.master(spark, sf_dir), T.compact(_vocab(spark, sf_dir))))


@query("mask_targets", with_views(
    f"SELECT example_id, {_join('target_ids', 'CASE WHEN x = 0 THEN -100 ELSE x END')} AS targets FROM encoded",
    "master", vocab=VOCAB_SQL, items=ITEMS_SQL, encoded=ENCODED_SQL))
def mask_targets(spark, sf_dir):
    encoded = T.encode_examples(V.master(spark, sf_dir), T.compact(_vocab(spark, sf_dir)))
    return tidy(encoded.select("example_id", mask_padding(F.col("target_ids")).alias("targets")))


@query("assign_batches", with_views(
    """SELECT example_id, batch_id, count(*) OVER (PARTITION BY batch_id) AS batch_rows,
              max(length) OVER (PARTITION BY batch_id) AS pad_to
       FROM (SELECT m.example_id, (row_number() OVER (ORDER BY m.example_id) - 1) // 16 AS batch_id,
                    coalesce(max(i.pos), 0)::BIGINT AS length
             FROM master m LEFT JOIN items i ON i.example_id = m.example_id GROUP BY m.example_id)
       QUALIFY batch_rows = 16""", "master", vocab=VOCAB_SQL, items=ITEMS_SQL))
def assign_batches(spark, sf_dir):
    length = F.size(tokens(F.col("input_text")))
    return tidy(T.assign_batches(V.master(spark, sf_dir), 16, length, drop_last=True))


def hash_labels():
    """A stand-in model: the label is the parity of a hash of the whole text.

    The loader is a nested function, so that workers get it by value and need not have
    this package on their path.
    """

    def load():
        import hashlib

        import numpy as np

        def model(texts):
            return np.array([str(int(hashlib.md5(t.encode()).hexdigest()[:7], 16) % 2) for t in texts], dtype=object)

        return model

    return load


def hash_scores():
    """A stand-in model with two steps of five scores from hashes of the whole text."""

    def load():
        import hashlib

        import numpy as np

        def one(t, s, c):
            return int(hashlib.md5(f"{s}:{c}:{t}".encode()).hexdigest()[:7], 16) % 1000 / 100

        def model(texts):
            return np.array([[one(t, s, c) for s in range(2) for c in range(5)] for t in texts])

        return model

    return load


HASH_LABEL = f"CAST({h('input_text')} % 2 AS VARCHAR)"


@query("predict_batches", with_views(
    f"SELECT example_id, {HASH_LABEL} AS predicted, label AS ground_truth FROM master", "master"))
def predict_batches(spark, sf_dir):
    return tidy(I.predict(V.master(spark, sf_dir), hash_labels()))


@query("predict_scores", with_views(
    "SELECT example_id, s.step, "
    + ", ".join(f"""round({h(f"s.step || ':{c}:' || input_text")} % 1000 / 100e0, 6) AS z_{c}""" for c in range(5))
    + " FROM master, (SELECT unnest([0, 1])::BIGINT AS step) s", "master"))
def predict_scores(spark, sf_dir):
    out = I.predict_scores(V.master(spark, sf_dir), hash_scores(), steps=2, classes=5)
    return tidy(out.select("example_id", "step", *[F.get("logits", F.lit(c)).alias(f"z_{c}") for c in range(5)]))


@query("pseudo_label", with_views(
    f"SELECT example_id, {HASH_LABEL} AS predicted, label AS ground_truth FROM master WHERE label IS NULL", "master"))
def pseudo_label(spark, sf_dir):
    unlabeled = V.master(spark, sf_dir).filter("label IS NULL")
    return tidy(I.pseudo_label(unlabeled, hash_labels(), scratch_path(spark, "pseudo")))


SAMPLE_SQL = with_views(
    f"""SELECT d.example_id, d.draw, coalesce(min(w.token) FILTER (w.reached > d.u), max(w.token)) AS token
        FROM (SELECT example_id, draw, {h("'6:draw:' || example_id || ':' || draw", 13)} / 4503599627370496e0 AS u
              FROM logits, (SELECT unnest(range(10)) AS draw)) d
        JOIN (SELECT example_id, token,
                     round(sum(w) OVER (PARTITION BY example_id ORDER BY token) / sum(w) OVER (PARTITION BY example_id), 9) AS reached
              FROM (SELECT example_id, token, exp((z - max(z) OVER (PARTITION BY example_id)) / 0.5e0) AS w,
                           row_number() OVER (PARTITION BY example_id ORDER BY z DESC, token) AS place
                    FROM (SELECT example_id, unnest(logits) AS z, generate_subscripts(logits, 1) - 1 AS token FROM logits))
              WHERE place <= 3) w ON w.example_id = d.example_id
        GROUP BY d.example_id, d.draw""", "logits")


@query("sample_labels", SAMPLE_SQL)
def sample_labels(spark, sf_dir):
    return tidy(I.sample_labels(V.logits(spark, sf_dir), n=10, seed=6, temperature=0.5, top_k=3))


@query("predict_sparse_scores", with_views(
    f"""SELECT example_id, step, id, round(z, 6) AS z, round(ln(sum(exp(z)) OVER (PARTITION BY example_id, step)), 6) AS lse
        FROM (SELECT example_id, s.step, c.id, {h("s.step || ':' || c.id || ':' || input_text")} % 1000 / 100e0 AS z
              FROM master, (SELECT unnest([0, 1])::BIGINT AS step) s, (SELECT unnest(range(5)) AS id) c)
        QUALIFY row_number() OVER (PARTITION BY example_id, step ORDER BY z DESC, id) <= 2 OR id = 3""", "master"))
def predict_sparse_scores(spark, sf_dir):
    out = I.predict_sparse_scores(V.master(spark, sf_dir), hash_scores(), steps=2, classes=5, top=2, wanted=[3])
    held = F.arrays_zip(F.col("logits.ids").alias("id"), F.col("logits.z").alias("z"))
    return tidy(out.select("example_id", "step", F.col("logits.lse").alias("lse"), F.explode(held).alias("_h")).select("example_id", "step", "_h.id", "_h.z", "lse"))


@query("sparse_sample_labels", SAMPLE_SQL)
def sparse_sample_labels(spark, sf_dir):
    held = V.logits(spark, sf_dir).withColumn("logits", sparse(F.col("logits"), 4, [5]))
    return tidy(I.sample_labels(held, n=10, seed=6, temperature=0.5, top_k=3))


@query("label_in_buckets", with_views(
    f"SELECT example_id, {HASH_LABEL} AS predicted, label AS ground_truth FROM master WHERE label IS NULL", "master"))
def label_in_buckets(spark, sf_dir):
    """The pool labelled in two runs, of which the second finds all of its work done."""
    unlabeled = V.master(spark, sf_dir).filter("label IS NULL")
    path = scratch_path(spark, "buckets")
    I.label_in_buckets(unlabeled, hash_labels(), path, buckets=8, per_job=4)
    return tidy(I.label_in_buckets(unlabeled, hash_labels(), path, buckets=8, per_job=4))


FIT = {"features": 1 << 14, "max_iter": 10}


@query("train_label_model")
def train_label_model(spark, sf_dir):
    rows = normal_split(V.labelled(spark, sf_dir), SplitSpec(task_ids=range(20)))
    model = training.train_label_model(rows.filter("split = 'train'"), **FIT)
    return tidy(training.apply_label_model(model, rows.filter("split = 'test'")))


@query("transfer_train")
def transfer_train(spark, sf_dir):
    rows = V.labelled(spark, sf_dir)
    target = normal_split(rows, SplitSpec(task_ids=range(10, 20)))
    model = training.transfer_train(
        rows.filter("dataset_type = 'SRC'"), target.filter("split = 'train'"), **FIT
    )
    return tidy(training.apply_label_model(model, target.filter("split = 'test'")))


@query("transfer_experiment")
def transfer(spark, sf_dir):
    predictions = transfer_experiment(
        V.labelled(spark, sf_dir),
        SplitSpec(task_ids=range(10), test_frac=0.3, val_frac=0.3),
        SplitSpec(task_ids=range(10, 20)),
        labeled=50,
        **FIT,
    )
    return tidy(predictions)


@query("target_experiment", with_views(
    f"""SELECT 'target_en' AS run, round(avg(accuracy), 6) AS avg_acc, round(stddev_pop(accuracy), 6) AS std
        FROM (SELECT trial, avg(CASE WHEN label = {HASH_LABEL} THEN 1e0 ELSE 0e0 END) AS accuracy
              FROM (SELECT *, count(*) OVER (PARTITION BY trial) AS n, row_number() OVER (
                           PARTITION BY trial ORDER BY md5(trial || ':split:' || example_id), example_id) AS rk
                    FROM labelled, (SELECT unnest([1, 2, 3]) AS trial) WHERE dataset_type = 'TRG' AND dataset = 'en')
              WHERE rk <= floor(0.2e0 * n) GROUP BY trial)""", "labelled"))
def target(spark, sf_dir):
    summary = target_experiment(
        V.labelled(spark, sf_dir), SplitSpec(dataset="en"), trials=3, load=hash_labels(), run="target_en"
    )
    return tidy(summary.select("run", "avg_acc", "std"))


STUDY = {
    "first": "SELECT example_id, logits, target FROM step_logits WHERE step = 0",
    "studied": f"""SELECT example_id, {V.LABEL_SQL.format("list_position(logits, list_max(logits)) - 1")} AS predicted,
                {V.LABEL_SQL.format("target")} AS ground_truth,
                1e0 / list_sum(list_transform(logits, lambda z: exp(z - list_max(logits)))) AS score FROM first""",
}


def _study(spark, sf_dir, **options):
    """The study with predictions of the very examples that the scores belong to."""
    steps = V.step_logits(spark, sf_dir)
    best = best_label(first_step_scores(steps), V.ID2LABEL, keep=["target"])
    judged = prediction_table(best.withColumn("truth", label_of(F.col("target"), V.ID2LABEL)), "label", "truth")
    return confidence_study(steps, judged, V.ID2LABEL, **options)


@query("confidence_study_curve", with_views(
    f"""SELECT CAST(t.point AS BIGINT) AS point, round(t.theta, 6) AS theta, count(s.score) AS kept,
              round(count(s.score) / (SELECT count(*) FROM studied)::DOUBLE, 6) AS coverage,
              round(avg(CASE WHEN s.score IS NULL THEN NULL WHEN s.predicted = s.ground_truth THEN 1e0 ELSE 0e0 END), 6) AS accuracy
       FROM (SELECT * FROM (VALUES {", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(threshold_grid()))}) AS t(point, theta)) t
       LEFT JOIN studied s ON s.score >= t.theta GROUP BY t.point, t.theta""", "step_logits", **STUDY))
def study_curve(spark, sf_dir):
    return tidy(_study(spark, sf_dir).curve)


@query("confidence_study_auto_label", with_views(
    """SELECT round(avg(CASE WHEN predicted = ground_truth THEN 1e0 ELSE 0e0 END), 6) AS accuracy, count(*) AS n_examples
       FROM studied WHERE score >= 0.4e0""", "step_logits", **STUDY))
def study_auto_label(spark, sf_dir):
    return tidy(_study(spark, sf_dir).auto_labeled)


@query("confidence_study", with_views(
    """SELECT part, count(*) AS n, round(avg(score), 6) AS mean_score
       FROM (SELECT 'random' AS part, score FROM placed WHERE rk <= 20
             UNION ALL SELECT 'least_confident', score FROM placed WHERE low <= 20
             UNION ALL SELECT 'remainder', score FROM placed WHERE rk > 20 AND low > 20)
       GROUP BY part""",
    "step_logits",
    first="SELECT example_id, logits FROM step_logits WHERE step = 0",
    scored="""SELECT example_id, 1e0 / list_sum(list_transform(logits, lambda z: exp(z - list_max(logits)))) AS score
              FROM first""",
    placed="""SELECT score, row_number() OVER (ORDER BY score, example_id) AS low,
                     row_number() OVER (ORDER BY md5('1:review:' || example_id), example_id) AS rk FROM scored"""))
def study(spark, sf_dir):
    judged = V.predictions(spark, sf_dir)
    parts = confidence_study(V.step_logits(spark, sf_dir), judged, V.ID2LABEL, review_size=20)
    joined = parts.review.join(parts.confidence, "example_id")
    return tidy(joined.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score")))
