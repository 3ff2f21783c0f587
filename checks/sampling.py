"""Samples, splits, resampling and review sets."""

from __future__ import annotations

from checks import views as V
from checks.registry import query, tidy
from checks.views import h, with_views
from labelkit.operators import sampling as P
from labelkit.operators import splits as S
from labelkit.operators.confidence import best_label

EN = S.SplitSpec(dataset="en", seed=1)
EN_SQL = "dataset_type = 'TRG' AND dataset = 'en'"


def place(seed: object, stage: str, *parts: str) -> str:
    """SQL of the md5 order key."""
    return "md5(" + " || ':' || ".join([f"'{seed}:{stage}'", *parts]) + ")"


def ranked(source: str, seed: int, stage: str, where: str = "true", key: str = "example_id") -> str:
    return f"""SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY {place(seed, stage, key)}, {key}) AS rk
               FROM {source} WHERE {where}"""


def sizes(test: str, val: str, train: str, source: str = "ranked") -> str:
    """t test rows, k kept rows, v of them for validation."""
    return f"""SELECT *, CAST(floor({val} * k) AS BIGINT) AS v FROM (
                 SELECT *, CAST(floor({train} * (n - t)) AS BIGINT) AS k FROM (
                   SELECT *, CAST(floor({test} * n) AS BIGINT) AS t FROM {source}))"""


@query("sample_exact", with_views(
    "SELECT example_id, input_text FROM ranked WHERE rk <= 137", "master", ranked=ranked("master", 7, "sample")))
def sample_exact(spark, sf_dir):
    return tidy(P.sample_exact(V.master(spark, sf_dir), 137, seed=7).select("example_id", "input_text"))


@query("sample_fraction", with_views(
    "SELECT example_id, input_text FROM ranked WHERE rk <= floor(0.29e0 * n)",
    "master", ranked=ranked("master", 7, "sample")))
def sample_fraction(spark, sf_dir):
    return tidy(P.sample_fraction(V.master(spark, sf_dir), 0.29, seed=7).select("example_id", "input_text"))


@query("normal_split", with_views(
    """SELECT example_id, task_id, label,
              CASE WHEN rk <= t THEN 'test' WHEN rk <= t + v THEN 'val' ELSE 'train' END AS split
       FROM sized WHERE rk <= t + k""",
    "master", ranked=ranked("master", 1, "split", EN_SQL), sized=sizes("0.2e0", "0.15e0", "0.8e0")))
def normal_split(spark, sf_dir):
    spec = S.SplitSpec(dataset="en", train_frac=0.8, seed=1)
    return tidy(S.normal_split(V.master(spark, sf_dir), spec).select("example_id", "task_id", "label", "split"))


@query("pseudo_split", with_views(
    """SELECT example_id, task_id, label,
              CASE WHEN rk <= t THEN 'test' WHEN rk <= t + v THEN 'val'
                   WHEN rk <= t + least(v + 50, k) THEN 'train_labeled' ELSE 'train_unlabeled' END AS split
       FROM sized WHERE rk <= t + k""",
    "master", ranked=ranked("master", 1, "split", EN_SQL), sized=sizes("0.2e0", "0.15e0", "1e0")))
def pseudo_split(spark, sf_dir):
    return tidy(S.pseudo_split(V.master(spark, sf_dir), EN, k=50).select("example_id", "task_id", "label", "split"))


SOURCE_TASKS = [0, 3, 4, 7, 8, 9]


@query("source_pool", with_views(
    """SELECT example_id, task_id, label, split FROM staged WHERE split = 'val'
       UNION ALL
       SELECT example_id, task_id, label, split FROM (
         SELECT *, row_number() OVER (ORDER BY md5('2:pool:' || example_id), example_id) AS pr
         FROM staged WHERE split = 'train') WHERE pr <= 120""",
    "master",
    ranked=ranked("master", 2, "split", "task_id IN (0, 3, 4, 7, 8, 9)"),
    sized=sizes("0.3e0", "0.3e0", "1e0"),
    staged="""SELECT * FROM (SELECT *, CASE WHEN rk <= t THEN 'train'
                   WHEN rk <= t + (CASE WHEN v >= 40 THEN least(v, 60) ELSE v END) THEN 'val'
                   WHEN rk <= t + v THEN NULL
                   WHEN rk <= t + v + least(k - v, 120) THEN 'train' END AS split FROM sized)
              WHERE split IS NOT NULL"""))
def source_pool(spark, sf_dir):
    spec = S.SplitSpec(task_ids=SOURCE_TASKS, test_frac=0.3, val_frac=0.3, seed=2)
    pool = S.source_pool(V.master(spark, sf_dir), spec, example_threshold=120, val_trigger=40, val_cap=60)
    return tidy(pool.select("example_id", "task_id", "label", "split"))


# Source tasks 1, 2 and 12: task 12 also holds rows of the target.
SOURCES = [1, 2, 12]
TEST_MARK = f"""
    SELECT m.*, coalesce(m.dataset_type = 'TRG' AND m.dataset = 'en', false) AS is_target, coalesce(r.rk <= floor(0.2e0 * r.n), false) AS is_test
    FROM master m LEFT JOIN ranked r ON r.example_id = m.example_id"""


def transfer_sql(pool: str, cap: str = "") -> str:
    """Test rows, then val by rank over the pool's copies, then train without any val key."""
    return with_views(
        f"""SELECT example_id, task_id, 'target' AS copy, 'test' AS split FROM marked WHERE is_test
            UNION ALL SELECT example_id, task_id, copy, 'val' FROM placed WHERE vr <= vn
            UNION ALL SELECT example_id, task_id, copy, 'train' FROM train {cap}""",
        "master",
        ranked=ranked("(SELECT example_id, dataset_type, dataset FROM master)", 1, "split", EN_SQL),
        marked=TEST_MARK,
        pool=pool,
        placed=f"""SELECT *, row_number() OVER (ORDER BY {place(1, "val", "example_id", "copy")}, example_id) AS vr,
                          floor(0.15e0 * count(*) OVER () * 0.5e0) AS vn FROM pool""",
        train=f"""SELECT *, row_number() OVER (ORDER BY {place(1, "cap", "example_id", "copy")}, example_id) AS cr
                  FROM placed WHERE example_id NOT IN (SELECT example_id FROM placed WHERE vr <= vn)""",
    )


def _transfer(spark, sf_dir, **options):
    spec = S.SplitSpec(dataset="en", train_frac=0.5, seed=1)
    return tidy(S.transfer_split(V.master(spark, sf_dir), spec, **options).select("example_id", "task_id", "copy", "split"))


@query("transfer_split", transfer_sql(
    """SELECT example_id, task_id, CASE WHEN is_target THEN 'rest' ELSE 'source' END AS copy FROM marked
       WHERE NOT is_test AND (is_target OR task_id IN (1, 2, 12))""", "WHERE cr <= 60"))
def transfer_split(spark, sf_dir):
    return _transfer(spark, sf_dir, source_ids=SOURCES, sample_train_to=60)


@query("transfer_split_literal", transfer_sql(
    """SELECT example_id, task_id, 'rest' AS copy FROM marked WHERE is_target AND NOT is_test
       UNION ALL SELECT example_id, task_id, 'source' FROM marked WHERE task_id IN (1, 2, 12)"""))
def transfer_split_literal(spark, sf_dir):
    return _transfer(spark, sf_dir, source_ids=SOURCES, exclude_test=False)


@query("transfer_split_all", transfer_sql(
    """SELECT example_id, task_id, CASE WHEN is_target THEN 'rest' ELSE 'source' END AS copy FROM marked
       WHERE NOT is_test"""))
def transfer_split_all(spark, sf_dir):
    return _transfer(spark, sf_dir, use_all=True)


@query("balanced_resample", with_views(
    f"""SELECT d.example_id AS draw, r.example_id, r.label
        FROM (SELECT example_id, {h("'3:class:' || example_id", 15)} % (SELECT count(*) FROM classes) AS class_no,
                     {h("'3:place:' || example_id", 15)} AS place FROM labelled) d
        JOIN classes c ON c.class_no = d.class_no
        JOIN numbered r ON r.label = c.label AND r.ordinal = 1 + d.place % c.size""",
    "labelled",
    classes="SELECT label, count(*) AS size, row_number() OVER (ORDER BY label) - 1 AS class_no FROM labelled GROUP BY label",
    numbered=f"""SELECT example_id, label, row_number() OVER (PARTITION BY label
                 ORDER BY {place(3, "ordinal", "example_id")}, example_id) AS ordinal FROM labelled"""))
def balanced_resample(spark, sf_dir):
    return tidy(P.balanced_resample(V.master(spark, sf_dir), seed=3))


@query("grow_pool", with_views(
    f"""SELECT example_id, label FROM labelled WHERE label = '0'
        UNION ALL
        SELECT example_id, label FROM ({ranked("master", 5, "grow", "label IS DISTINCT FROM '0'")}) WHERE rk <= 100""",
    "labelled"))
def grow_pool(spark, sf_dir):
    df = V.master(spark, sf_dir)
    return tidy(P.grow_pool(df.filter("label = '0'"), df, 100, seed=5).select("example_id", "label"))


@query("review_partition", with_views(
    """SELECT example_id, 'random' AS part FROM placed WHERE rk <= 100
       UNION ALL SELECT example_id, 'least_confident' FROM placed WHERE low <= 100
       UNION ALL SELECT example_id, 'remainder' FROM placed WHERE rk > 100 AND low > 100""",
    "confidence",
    placed="""SELECT example_id, row_number() OVER (ORDER BY score, example_id) AS low,
                     row_number() OVER (ORDER BY md5('4:review:' || example_id), example_id) AS rk FROM confidence"""))
def review_partition(spark, sf_dir):
    df = V.logits(spark, sf_dir)
    return tidy(S.review_partition(df, best_label(df, V.ID2LABEL), 100, seed=4))


@query("trial_splits", with_views(
    """SELECT trial, example_id, CASE WHEN rk <= t THEN 'test' WHEN rk <= t + v THEN 'val' ELSE 'train' END AS split
       FROM sized WHERE rk <= t + k""",
    "master",
    ranked=f"""SELECT *, count(*) OVER (PARTITION BY trial) AS n,
                      row_number() OVER (PARTITION BY trial ORDER BY md5(trial || ':split:' || example_id), example_id) AS rk
               FROM master, (SELECT unnest([1, 2, 3, 4, 5])::BIGINT AS trial) WHERE {EN_SQL}""",
    sized=sizes("0.2e0", "0.15e0", "0.9e0")))
def trial_splits(spark, sf_dir):
    spec = S.SplitSpec(dataset="en", train_frac=0.9)
    return tidy(S.trial_splits(V.master(spark, sf_dir), spec, trials=5))
