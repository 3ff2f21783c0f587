"""Exact global ranks and exact cut points without a single-partition window.

Four tools, from cheapest to dearest:

``cut_keys``      which (order, key) pair sits at given ranks; two narrow scans, no
                  shuffle of the data.  Enough for every sample and split.
``Settled``       cuts of several orders, of which later ones depend on earlier ones: each
                  pass counts for the next cut while it settles the last one.
``hashed_rank``   a full rank in hash order; one shuffle of the rows, spread over
                  65,536 buckets per group, so a hot group is spread as well.
``ordered_rank``  a full rank in value order; one range shuffle on (group, order),
                  which splits hot groups and ties because the order is unique.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkit.functions.keys import BUCKET_DIGITS, bucket_of
from labelkit.session import sized_table, stage_table

OFFSETS_LIMIT = 200_000
# A top-n merge gathers n rows of every partition in one task.
TOP_N_LIMIT = 2_000

Cut = Callable[[Column], Column]


def _bucket_sizes(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows before each bucket, rows up to it, and the group total.

    The windows run over bucket counts (at most 65,536 rows per group), never over data.
    """
    every = Window.partitionBy(*groups)
    running = every.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.groupBy(*groups, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *groups,
            "_bucket",
            (F.sum("_n").over(running) - F.col("_n")).alias("_before"),
            F.sum("_n").over(running).alias("_upto"),
            F.sum("_n").over(every).alias("_total"),
        )
    )


def cut_keys(
    df: DataFrame,
    key: str,
    order: Column,
    cuts: Sequence[Cut],
    groups: Sequence[str] = (),
    group_bound: int = 1,
) -> DataFrame:
    """The pair ``(order, key)`` found at each requested rank, one row per group.

    ``cuts`` are functions of the group's row count (a BIGINT Column) giving a rank;
    ranks are clipped to the count, and rank 0 gives NULL.  Columns ``cut_0``,
    ``cut_1``, ... are structs to compare with :func:`at_or_before`.

    Only (groups, order, key) are read.  A first pass counts hash buckets; a second
    ranks just the buckets that contain a cut, about 1/65,536 of the rows each.
    ``group_bound`` is the caller's proven bound on the number of groups; the list of
    wanted buckets has at most ``len(cuts) * group_bound`` rows.
    """
    groups = list(groups)
    rows = df.select(*groups, order.alias("_order"), F.col(key).alias("_key"))
    rows = rows.withColumn("_bucket", bucket_of(F.col("_order")))
    total = F.col("_total")
    ranks = [F.least(F.greatest(cut(total).cast("bigint"), F.lit(0)), total) for cut in cuts]
    wanted = (
        _bucket_sizes(rows, groups)
        .select(*groups, "_bucket", "_before", "_upto", F.posexplode(F.array(*ranks)).alias("_cut", "_rank"))
        .filter((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_upto")))
        .select(*groups, "_bucket", "_cut", (F.col("_rank") - F.col("_before")).alias("_place"))
    )
    if group_bound <= 10_000:
        wanted = F.broadcast(wanted)
    inside = Window.partitionBy(*groups, "_bucket", "_cut").orderBy("_order", "_key")
    return (
        rows.join(wanted, [*groups, "_bucket"])
        .withColumn("_row", F.row_number().over(inside))
        .filter(F.col("_row") == F.col("_place"))
        .groupBy(*groups)
        .agg(*[F.max(F.when(F.col("_cut") == i, pair(F.col("_order"), F.col("_key")))).alias(f"cut_{i}") for i in range(len(cuts))])
    )


def pair(order: Column, key: Column) -> Column:
    return F.struct(order.alias("order"), key.alias("key"))


def cut_point(df: DataFrame, key: str, order: Column, cuts: Sequence[Cut]) -> list[tuple | None]:
    """:func:`cut_keys` of one ungrouped table, evaluated: one ``(order, key)`` pair per cut.

    The result is a single row however large the table is.  Having the pairs as literals
    keeps later plans linear: as a subquery, each stage of a split would carry the plans
    of all earlier stages several times over.
    """
    row = cut_keys(df, key, order, cuts).first()
    return [None if row[i] is None else (row[i]["order"], row[i]["key"]) for i in range(len(cuts))]


def at_or_before(order: Column, key: Column, cut: tuple | Column | None) -> Column:
    """True when the row's rank is at most the cut's rank; false for an empty cut.

    ``cut`` is a pair from :func:`cut_point` or a struct column of :func:`cut_keys`.
    """
    if cut is None:
        return F.lit(False)
    if isinstance(cut, Column):
        return F.coalesce(pair(order, key) <= cut, F.lit(False))
    return (order < F.lit(cut[0])) | ((order == F.lit(cut[0])) & (key <= F.lit(cut[1])))


def places_of(counts: Mapping[str, int], ranks: Sequence[int]) -> list[tuple[str, int] | None]:
    """The bucket that holds each rank and the place of the rank in it; None for rank 0."""
    names = sorted(counts)
    upto = list(accumulate(counts[b] for b in names))
    out: list[tuple[str, int] | None] = []
    for rank in ranks:
        rank = max(0, min(rank, upto[-1] if upto else 0))
        i = bisect_left(upto, rank)
        out.append((names[i], rank - upto[i] + counts[names[i]]) if rank else None)
    return out


class Settled:
    """Cuts of one written table of keys and flags whose members depend on earlier cuts.

    A pass counts the members of the next order per hash bucket, as far as earlier cuts
    leave no doubt about them, and brings the rows of the buckets that hold the last cuts,
    1 / 65,536 of all rows each.  These settle the last cuts and are then counted here.
    Every pass is one job.
    """

    def __init__(self, rows: DataFrame, columns: Sequence[str]):
        self.rows, self.columns = rows, list(columns)

    def count(self, items: Column, doubt: Column | None = None) -> tuple[dict[str, int], list[dict]]:
        """Members per bucket among rows without doubt, and the rows in doubt.

        ``items`` is an array with an order key for each membership of a row.
        """
        doubt = F.lit(False) if doubt is None else doubt
        none = [F.lit(None).cast(self.rows.schema[c].dataType).alias(c) for c in self.columns]
        counted = (
            self.rows.filter(~doubt)
            .select(F.explode(items).alias("_order"))
            .groupBy(bucket_of(F.col("_order")).alias("_bucket"))
            .agg(F.count(F.lit(1)).alias("_n"))
            .select("_bucket", "_n", *none)
        )
        open_rows = self.rows.filter(doubt).select(F.lit(None).cast("string").alias("_bucket"), F.lit(None).cast("long").alias("_n"), *self.columns)
        found = counted.unionByName(open_rows).toArrow()
        sums = found.filter(found.column("_n").is_valid())
        counts = dict(zip(sums.column("_bucket").to_pylist(), sums.column("_n").to_pylist()))
        return counts, found.filter(found.column("_n").is_null()).select(self.columns).to_pylist()

    def bring(self, doubt: Column) -> list[dict]:
        return self.rows.filter(doubt).select(*self.columns).toArrow().to_pylist()


def settle(places: Sequence[tuple[str, int] | None], members: Iterable[tuple[str, object]]) -> list[tuple | None]:
    """The ``(order, key)`` pair at each place, from the members of the buckets concerned."""
    inside: dict[str, list[tuple[str, object]]] = {}
    for order, key in members:
        inside.setdefault(order[:BUCKET_DIGITS], []).append((order, key))
    for own in inside.values():
        own.sort()
    return [None if p is None else inside[p[0]][p[1] - 1] for p in places]


def in_buckets(order: Column, places: Sequence[tuple[str, int] | None]) -> Column:
    """Whether an order key lies in one of the buckets that hold a cut."""
    return bucket_of(order).isin([p[0] for p in places if p is not None])


def join_groups(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on columns of equal names under which NULL equals NULL."""
    there = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    return left.join(there, same).drop(*[f"_right_{c}" for c in on])


def hashed_rank(df: DataFrame, key: str, order: Column, groups: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Dense 1-based rank by ``(order, key)`` within ``groups``; ``order`` is an md5 key.

    Bucket totals and the inner ``row_number`` both use (groups, bucket), so rows are
    shuffled once and no task sees more than a 1/65,536 slice of a group.
    """
    groups = list(groups)
    rows = df.withColumn("_order", order).withColumn("_bucket", bucket_of(F.col("_order")))
    sizes = _bucket_sizes(rows, groups).select(*groups, "_bucket", "_before")
    if not groups:
        sizes = F.broadcast(sizes)
    inside = Window.partitionBy(*groups, "_bucket").orderBy("_order", key)
    return (
        join_groups(rows, sizes, [*groups, "_bucket"])
        .withColumn(name, F.col("_before") + F.row_number().over(inside))
        .select(*df.columns, name)
    )


def ordered_rank(df: DataFrame, order: Sequence[str], groups: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Dense 1-based rank by the ``order`` columns, ascending, within ``groups``.

    ``(groups, order)`` must identify a row.  The rows are range-partitioned and sorted
    by it, written to the shared scratch folder, and ranked by position: rows in earlier
    partitions of the group plus place in the own partition.  Pass narrow tables and
    join wide columns back by key.  Range boundaries come from a sample, for which Spark
    evaluates the input a second time: stage columns that are dear to compute.
    """
    groups = list(groups)
    by = [*groups, *order]
    placed = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage_table(placed, "ordered").withColumn("_part", F.shiftright("_place", 33))
    sizes = placed.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *groups, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    # Ungrouped there is one row per shuffle partition, grouped about one per group: too
    # many of those are joined by shuffle, which (group, partition) keeps even.
    n_offsets = 0
    if groups:
        offsets, n_offsets = sized_table(offsets, "offsets")
    if n_offsets <= OFFSETS_LIMIT:
        offsets = F.broadcast(offsets)
    return join_groups(placed, offsets, [*groups, "_part"]).select(
        *df.columns, (F.col("_place") + F.col("_shift")).alias(name)
    )


def lowest(df: DataFrame, k: int, order: Sequence[str]) -> DataFrame:
    """The ``k`` lowest rows by the ``order`` columns, reduced to those columns.

    The top-k merge of a review batch is cheap; beyond ``TOP_N_LIMIT`` the same rows are
    taken by :func:`ordered_rank`.
    """
    narrow = df.select(*order)
    if k <= TOP_N_LIMIT:
        return narrow.orderBy(*order).limit(k)
    return ordered_rank(narrow, order, name="_rank").filter(F.col("_rank") <= k).drop("_rank")
