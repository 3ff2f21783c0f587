"""Train / validation / test splits as one ``split`` column.

A split is a cut of one seeded permutation: the first ``t`` ranks are the test set, the
next ``v`` the validation set, and so on.  Cutting a permutation gives the same
distribution as sampling, removing and sampling again, with one pass of counting
instead of one per step and no anti-joins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.functions.keys import BUCKET_DIGITS, order_key
from labelkit.operators.ranks import Cut, Settled, at_or_before, cut_keys, cut_point, in_buckets, lowest, places_of, settle
from labelkit.operators.relations import select_target, select_tasks
from labelkit.operators.sampling import truncated
from labelkit.session import SMALL_SIDE_ROWS, counting_table


@dataclass(frozen=True)
class SplitSpec:
    """What to split and into which shares.  One selector is required."""

    dataset: str | None = None
    task_ids: Sequence[int] | None = None
    test_frac: float = 0.2
    val_frac: float = 0.15
    train_frac: float = 1.0
    seed: int = 1

    def __post_init__(self):
        if self.dataset is None and self.task_ids is None:
            raise ValueError("give a target dataset or target task ids")

    def select(self, df: DataFrame) -> DataFrame:
        """The target rows; task ids take precedence over the dataset name."""
        if self.task_ids is not None:
            return select_tasks(df, self.task_ids)
        return select_target(df, self.dataset)

    def is_target(self) -> Column:
        if self.task_ids is not None:
            match = F.col("task_id").isin(list(self.task_ids))
        else:
            match = (F.col("dataset_type") == "TRG") & (F.col("dataset") == self.dataset)
        return F.coalesce(match, F.lit(False))

    # Sizes as functions of the number of target rows.
    def n_test(self, n: Column) -> Column:
        return truncated(self.test_frac)(n)

    def n_kept(self, n: Column) -> Column:
        return truncated(self.train_frac)(n - self.n_test(n))

    def n_val(self, n: Column) -> Column:
        return truncated(self.val_frac)(self.n_kept(n))

    def sizes(self, n: int) -> tuple[int, int, int]:
        """The same three numbers for a known number of target rows: test, kept, val."""
        test = math.floor(float(self.test_frac) * float(n))
        kept = math.floor(float(self.train_frac) * float(n - test))
        return test, kept, math.floor(float(self.val_frac) * float(kept))


def _label_ranges(
    df: DataFrame, order: Column, key: str, cuts: Sequence[tuple | Column | None], names: Sequence[str | None]
) -> DataFrame:
    """Name the rank range that each row falls into; rows in unnamed ranges are dropped."""
    split = F.lit(None).cast("string")
    for i in reversed(range(len(names))):
        inside = at_or_before(order, F.col(key), cuts[i])
        split = F.when(inside, F.lit(names[i])).otherwise(split)
    return df.withColumn("split", split).filter(F.col("split").isNotNull())


def _cut_split(
    df: DataFrame, seed: int, stage: str, key: str, cuts: Sequence[Cut], names: Sequence[str | None]
) -> DataFrame:
    order = order_key(seed, stage, F.col(key))
    return _label_ranges(df, order, key, cut_point(df, key, order, cuts), names)


def normal_split(df: DataFrame, spec: SplitSpec, key: str = "example_id") -> DataFrame:
    """Target rows as test / val / train.

    test = int(test_frac * n); int(train_frac * rest) rows stay in play, of which
    int(val_frac * kept) validate.  Rows not kept are dropped.
    """
    return _cut_split(
        spec.select(df),
        spec.seed,
        "split",
        key,
        [
            spec.n_test,
            lambda n: spec.n_test(n) + spec.n_val(n),
            lambda n: spec.n_test(n) + spec.n_kept(n),
        ],
        ["test", "val", "train"],
    )


def pseudo_split(df: DataFrame, spec: SplitSpec, k: int, key: str = "example_id") -> DataFrame:
    """As :func:`normal_split`, with ``k`` training rows labelled and the others unlabelled."""

    def through_labeled(n: Column) -> Column:
        return spec.n_test(n) + F.least(spec.n_val(n) + F.lit(k), spec.n_kept(n))

    return _cut_split(
        spec.select(df),
        spec.seed,
        "split",
        key,
        [
            spec.n_test,
            lambda n: spec.n_test(n) + spec.n_val(n),
            through_labeled,
            lambda n: spec.n_test(n) + spec.n_kept(n),
        ],
        ["test", "val", "train_labeled", "train_unlabeled"],
    )


def source_pool(
    df: DataFrame,
    spec: SplitSpec,
    example_threshold: int | None = None,
    val_trigger: int = 0,
    val_cap: int | None = None,
    key: str = "example_id",
) -> DataFrame:
    """Training pool of source tasks: val and train only, limited in size if asked for.

    With ``val_cap``, a validation set of ``val_trigger`` rows or more is limited to it.
    With ``example_threshold``, training rows are limited to it, joined with the test rows,
    and the union is limited to it again.  By default every row is used.
    """
    order = order_key(spec.seed, "split", F.col(key))
    names = ["train", "val", None, "train"]

    def ranks(n: int) -> list[int]:
        test, kept, val = spec.sizes(n)
        capped = val if val_cap is None or val < val_trigger else min(val, val_cap)
        rest = kept - val if example_threshold is None else min(kept - val, example_threshold)
        return [test, test + capped, test + val, test + val + rest]

    selected = spec.select(df)
    narrow = Settled(counting_table(selected.select(F.col(key).alias("_key"), order.alias("_order")), "split-keys"), ["_key", "_order"])
    counts, _ = narrow.count(F.array("_order"))
    places = places_of(counts, ranks(sum(counts.values())))
    if example_threshold is None:
        near = narrow.bring(in_buckets(F.col("_order"), places))
        cuts = settle(places, [(r["_order"], r["_key"]) for r in near])
        return _label_ranges(selected, order, key, cuts, names)

    pool_order = order_key(spec.seed, "pool", F.col("_key"))
    # a row outside of the buckets with cuts has the name of the first cut whose bucket lies behind it
    bucket, split = F.substring("_order", 1, BUCKET_DIGITS), F.lit(None).cast("string")
    for place, name in zip(reversed(places), reversed(names)):
        if place is not None:
            split = F.when(bucket < place[0], F.lit(name)).otherwise(split)
    member = F.when(split == "train", F.array(pool_order)).otherwise(F.array().cast("array<string>"))
    narrow = Settled(narrow.rows.withColumn("_pool", pool_order), ["_key", "_order", "_pool"])
    pool_counts, open_rows = narrow.count(member, in_buckets(F.col("_order"), places))
    cuts = settle(places, [(r["_order"], r["_key"]) for r in open_rows])
    for r in open_rows:
        at = next((i for i, c in enumerate(cuts) if c is not None and (r["_order"], r["_key"]) <= c), None)
        if at is not None and names[at] == "train":
            own = r["_pool"][:BUCKET_DIGITS]
            pool_counts[own] = pool_counts.get(own, 0) + 1
    pool_places = places_of(pool_counts, [example_threshold])
    staged = _label_ranges(narrow.rows, F.col("_order"), "_key", cuts, names)
    near = staged.filter((F.col("split") == "train") & in_buckets(F.col("_pool"), pool_places)).select("_pool", "_key").collect()
    (limit,) = settle(pool_places, map(tuple, near))
    order = order_key(spec.seed, "pool", F.col(key))
    named = _label_ranges(selected, order_key(spec.seed, "split", F.col(key)), key, cuts, names)
    return named.filter((F.col("split") == "val") | at_or_before(order, F.col(key), limit))


def transfer_split(
    df: DataFrame,
    spec: SplitSpec,
    source_ids: Sequence[int] = (),
    sample_train_to: int | None = None,
    use_all: bool = False,
    exclude_test: bool = True,
    key: str = "example_id",
) -> DataFrame:
    """Test from the target alone; val and train from the rest of it plus source tasks.

    val = int(val_frac * pool * train_frac): ``train_frac`` shrinks the validation set
    only.  ``sample_train_to`` limits the training set afterwards.  ``use_all`` takes
    every row that is not a test row as the pool.

    By default a row enters the pool once and never when it is a test row.  With
    ``exclude_test=False`` source tasks are appended literally: a row of a source task
    that is also a target row is there twice (column ``copy`` tells the copies apart),
    test rows return as training rows, and a key drawn for validation leaves the training
    set with all its copies.
    """
    order = order_key(spec.seed, "split", F.col(key))
    sources = list(source_ids)
    in_source = F.lit(True) if use_all else F.col("task_id").isin(sources) if sources else F.lit(False)
    test_cut, val_cut, cap = _transfer_cuts(df, spec, in_source, sample_train_to, exclude_test or use_all, key)
    test = F.col("_test")
    from_source = in_source
    if exclude_test or use_all:
        from_source = in_source & ~test & ~F.col("_target")
    marked = (
        df.withColumn("_target", spec.is_target())
        .withColumn("_test", F.col("_target") & at_or_before(order, F.col(key), test_cut))
        .withColumn("_rest", F.col("_target") & ~test)
        .withColumn("_source", F.coalesce(from_source, F.lit(False)))
    )

    def copy_order(copy: Column) -> Column:
        return order_key(spec.seed, "val", F.col(key), copy)

    for copy in ("rest", "source"):
        drawn = F.col(f"_{copy}") & at_or_before(copy_order(F.lit(copy)), F.col(key), val_cut)
        marked = marked.withColumn(f"_{copy}_val", drawn)

    def role(copy: str, here: Column, split: Column) -> Column:
        return F.when(here & split.isNotNull(), F.struct(F.lit(copy).alias("copy"), split.alias("split")))

    def pool_role(copy: str) -> Column:
        in_train = ~F.col("_rest_val") & ~F.col("_source_val")
        split = F.when(F.col(f"_{copy}_val"), F.lit("val")).when(in_train, F.lit("train"))
        return role(copy, F.col(f"_{copy}"), split)

    roles = F.array_compact(F.array(role("target", test, F.lit("test")), pool_role("rest"), pool_role("source")))
    out = marked.withColumn("_role", F.explode(roles)).select(*df.columns, "_role.copy", "_role.split")
    if sample_train_to is None:
        return out
    cap_order = order_key(spec.seed, "cap", F.col(key), F.col("copy"))
    return out.filter((F.col("split") != "train") | at_or_before(cap_order, F.col(key), cap))


COPIES = ("rest", "source")


def _transfer_cuts(
    df: DataFrame, spec: SplitSpec, in_source: Column, sample_train_to: int | None, apart: bool, key: str
) -> tuple[tuple | None, tuple | None, tuple | None]:
    """The cuts of the test rows, of the validation copies and of the capped training copies.

    One narrow table of keys and flags is written; every pass over it is one job.  ``apart``
    keeps target rows out of the source copies.
    """
    wanted = spec.is_target().alias("_target"), F.coalesce(in_source, F.lit(False)).alias("_in")
    keys = df.select(F.col(key).alias("_key"), *wanted).filter("_target OR _in")
    seed = spec.seed
    orders = {
        "_order": order_key(seed, "split", F.col("_key")),
        **{f"_val_{c}": order_key(seed, "val", F.col("_key"), F.lit(c)) for c in COPIES},
        **{f"_cap_{c}": order_key(seed, "cap", F.col("_key"), F.lit(c)) for c in COPIES},
    }
    rows = counting_table(keys, "split-keys").withColumns(orders)
    table = Settled(rows, ["_key", "_target", "_in", *orders])
    empty = F.array().cast("array<string>")

    def listed(parts: list[tuple[Column, str]]) -> Column:
        return F.array_compact(F.array(*[F.when(there, F.col(name)) for there, name in parts]))

    def copies(test: Column) -> list[tuple[Column, str]]:
        source = F.col("_in") & ~F.col("_target") if apart else F.col("_in")
        return [(F.col("_target") & ~test, "rest"), (source, "source")]

    def copies_of(row: dict, test_cut: tuple | None) -> list[str]:
        test = row["_target"] and test_cut is not None and (row["_order"], row["_key"]) <= test_cut
        there = {"rest": row["_target"] and not test, "source": row["_in"] and not (apart and row["_target"])}
        return [c for c in COPIES if there[c]]

    def add(counts: dict[str, int], order: str) -> None:
        counts[order[:BUCKET_DIGITS]] = counts.get(order[:BUCKET_DIGITS], 0) + 1

    counts, _ = table.count(F.when(F.col("_target"), F.array("_order")).otherwise(empty))
    places = places_of(counts, [spec.sizes(sum(counts.values()))[0]])
    doubt = F.col("_target") & in_buckets(F.col("_order"), places)
    sure = F.lit(False) if places[0] is None else F.col("_target") & (F.substring("_order", 1, BUCKET_DIGITS) < places[0][0])
    counts, near = table.count(listed([(there, f"_val_{c}") for there, c in copies(sure)]), doubt)
    (test_cut,) = settle(places, [(r["_order"], r["_key"]) for r in near])
    for r in near:
        for c in copies_of(r, test_cut):
            add(counts, r[f"_val_{c}"])

    n_val = math.floor(float(spec.val_frac) * float(sum(counts.values())) * float(spec.train_frac))
    places = places_of(counts, [n_val])
    here = copies(F.col("_target") & at_or_before(F.col("_order"), F.col("_key"), test_cut))
    doubt = F.lit(False)
    drawn = F.lit(False)
    for there, c in here:
        doubt = doubt | (there & in_buckets(F.col(f"_val_{c}"), places))
        if places[0] is not None:
            drawn = drawn | (there & (F.substring(f"_val_{c}", 1, BUCKET_DIGITS) < places[0][0]))
    if sample_train_to is None:
        near = table.bring(doubt)
        (val_cut,) = settle(places, [(r[f"_val_{c}"], r["_key"]) for r in near for c in copies_of(r, test_cut)])
        return test_cut, val_cut, None
    counts, near = table.count(listed([(there & ~drawn, f"_cap_{c}") for there, c in here]), doubt)
    (val_cut,) = settle(places, [(r[f"_val_{c}"], r["_key"]) for r in near for c in copies_of(r, test_cut)])
    for r in near:
        own = copies_of(r, test_cut)
        if val_cut is None or all((r[f"_val_{c}"], r["_key"]) > val_cut for c in own):
            for c in own:
                add(counts, r[f"_cap_{c}"])
    places = places_of(counts, [sample_train_to])
    taken = F.lit(False)
    for there, c in here:
        taken = taken | (there & at_or_before(F.col(f"_val_{c}"), F.col("_key"), val_cut))
    doubt = F.lit(False)
    for there, c in here:
        doubt = doubt | (there & in_buckets(F.col(f"_cap_{c}"), places))
    near = table.bring(doubt & ~taken)
    (cap,) = settle(places, [(r[f"_cap_{c}"], r["_key"]) for r in near for c in copies_of(r, test_cut)])
    return test_cut, val_cut, cap


def review_partition(
    df: DataFrame, confidence: DataFrame, n: int, seed: int, key: str = "example_id", score: str = "score"
) -> DataFrame:
    """``(key, part)``: ``n`` random rows, the ``n`` least confident ones, and the remainder.

    The first two may overlap, in which case a row appears under both names.
    """
    order = order_key(seed, "review", F.col(key))
    (random_cut,) = cut_point(df, key, order, [lambda _: F.lit(n)])
    least = lowest(confidence, n, [score, key]).select(key, F.lit(True).alias("_least"))
    if n <= SMALL_SIDE_ROWS:
        least = F.broadcast(least)
    parts = F.array_compact(
        F.array(
            F.when(F.col("_random"), F.lit("random")),
            F.when(F.col("_least"), F.lit("least_confident")),
            F.when(~F.col("_random") & F.col("_least").isNull(), F.lit("remainder")),
        )
    )
    return (
        df.select(key, at_or_before(order, F.col(key), random_cut).alias("_random"))
        .join(least, key, "left")
        .select(key, F.explode(parts).alias("part"))
    )


def trial_splits(df: DataFrame, spec: SplitSpec, trials: int, key: str = "example_id") -> DataFrame:
    """:func:`normal_split` for seeds 1..trials in one plan: ``(trial, key, split)``.

    Only keys are multiplied by the number of trials; join text back on the key.
    """
    numbered = spec.select(df).select(key, F.explode(F.sequence(F.lit(1), F.lit(trials))).alias("trial"))
    order = order_key(F.col("trial"), "split", F.col(key))
    cuts = cut_keys(
        numbered,
        key,
        order,
        [
            spec.n_test,
            lambda n: spec.n_test(n) + spec.n_val(n),
            lambda n: spec.n_test(n) + spec.n_kept(n),
        ],
        groups=["trial"],
        group_bound=trials,
    )
    if trials <= 10_000:
        cuts = F.broadcast(cuts)
    joined = numbered.join(cuts, "trial")
    at = [F.col("cut_0"), F.col("cut_1"), F.col("cut_2")]
    return _label_ranges(joined, order, key, at, ["test", "val", "train"]).select("trial", key, "split")
