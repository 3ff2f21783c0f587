"""Nearest neighbours by inner product: inverted lists and an adaptive scan of dimensions.

Vectors get one more coordinate that makes them equally long, so the largest inner product
is the smallest distance, and are turned by a random rotation.  After a rotation the first d
coordinates of a difference hold about d / D of its squared length; a candidate is abandoned
after a block of columns once its partial distance exceeds what a hypothesis test allows a
vector within the current k-th best distance.

The lists are the cells of a two-level k-means, half as many as the square root of the
number of vectors: the first level and the number of probed lists come from a bounded
sample, the second level is fitted cell by cell in tasks.  Every vector is indexed.

A query scans its nearest list first; the k-th best distance found there goes along to its
other lists, where candidates only have to be told from that.  Within a list, blocks of
vectors meet blocks of queries, so neither a large list nor a popular one lands in a single
task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkit.session import stage_table

VECTOR_BLOCK, QUERY_BLOCK = 2048, 512
COLUMNS = 16  # coordinates per step of the scan
EPSILON = 2.1  # of the hypothesis test: larger abandons less
DENSE = 0.25  # share of a block's pairs from which a step takes all of them
PAIRS = 100_000  # pairs whose vectors are gathered at once
LIST_ROWS = 40  # sampled vectors per list that its second level is fitted on


def usable(vectors: DataFrame, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(id, v)`` of the vectors that take part, in double precision, each once.

    Null, empty and zero vectors, and those with null or non-finite components, are left
    out, as are rows without an id and vectors of another length than the most common one
    (the longer of equally common ones).
    """
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad_of(bad)).filter(F.exists("v", lambda x: x != 0))
    rows = stage_table(rows.dropDuplicates(["id", "v"]), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (sizes["n"] if sizes else 0))


def bad_of(bad: Column) -> Column:
    return F.coalesce(bad, F.lit(True))


@dataclass
class Index:
    """What every task needs: the longest squared norm, the rotation and the rotated centroids."""

    norm2: float
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int

    def turned(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Rows with the added coordinate, rotated."""
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.norm2 - (x * x).sum(axis=1)))
        return np.column_stack([x, last]) @ self.rotation

    def order(self, turned: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids, without the rows' own length."""
        return (self.centroids**2).sum(axis=1) - 2 * turned @ self.centroids.T


def _kmeans(x: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centroids = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        near = ((centroids**2).sum(axis=1) - 2 * x @ centroids.T).argmin(axis=1)
        count = np.bincount(near, minlength=lists)
        order = np.argsort(near, kind="stable")
        full = np.flatnonzero(count)
        total = np.zeros_like(centroids)
        total[full] = np.add.reduceat(x[order], (np.cumsum(count) - count)[full], axis=0)
        centroids = np.where(count[:, None] > 0, total / np.maximum(1, count)[:, None], centroids)
    return centroids


def _rows(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _second_level(rows: DataFrame, index: Index, lists: int, n: int, seed: int) -> np.ndarray:
    """Centroids of the lists: each cell of the first level is cut by its own k-means.

    A cell gets a list per ``LIST_ROWS`` of its sampled vectors, ``lists`` in all.  Cells
    are fitted in tasks of their own; the centroids are what comes back.
    """
    draw = F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = rows.filter(draw < LIST_ROWS * lists / n).select("v")

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                turned = index.turned(_rows(batch.column("v")))
                offsets = pa.array(np.arange(len(turned) + 1, dtype=np.int32) * turned.shape[1])
                cell = pa.array(index.order(turned).argmin(axis=1), pa.int32())
                yield pa.RecordBatch.from_arrays([cell, pa.ListArray.from_arrays(offsets, pa.array(turned.ravel()))], ["cell", "v"])

    def cut(table: pa.Table) -> pa.Table:
        x = np.unique(_rows(table.column("v").combine_chunks()), axis=0)
        rng = np.random.default_rng(seed + table.column("cell")[0].as_py())
        own = _kmeans(x, max(1, min(len(x), round(table.num_rows / LIST_ROWS))), rng)
        offsets = pa.array(np.arange(len(own) + 1, dtype=np.int32) * own.shape[1])
        return pa.table({"v": pa.ListArray.from_arrays(offsets, pa.array(own.ravel()))})

    placed = some.mapInArrow(place, "cell int, v array<double>")
    found = placed.groupBy("cell").applyInArrow(cut, "v array<double>").toArrow().column("v").combine_chunks()
    own = _rows(found) if len(found) else index.centroids
    return own[np.lexsort(own.T)]  # cells come in any order


def fit(rows: DataFrame, k: int, sample_rows: int = 12_000, recall: float = 0.98, seed: int = 3) -> Index | None:
    """An index whose first level is fitted on about ``sample_rows`` distinct vectors drawn by a hash of the id.

    The number of probed lists is the smallest with which 256 sampled queries find
    ``recall`` of their true neighbours within the sample.
    """
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm2")).first()
    if not stats["n"]:
        return None
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(draw < sample_rows / stats["n"]).select("v").distinct().limit(2 * sample_rows).toArrow().column("v").combine_chunks()
    if not len(sample):
        sample = rows.select("v").limit(1).toArrow().column("v").combine_chunks()
    rng = np.random.default_rng(seed)
    x = _rows(sample)
    x = x[np.lexsort(x.T)]  # rows come in any order
    rotation = np.linalg.qr(rng.standard_normal((x.shape[1] + 1, x.shape[1] + 1)))[0]
    lists = max(1, int(np.sqrt(stats["n"]) / 2))
    index = Index(float(stats["norm2"]), rotation, np.zeros((1, 1)), lists)
    turned = index.turned(x)
    index.centroids = _kmeans(turned, max(1, min(len(x) // LIST_ROWS, int(np.sqrt(lists)))), rng)
    index.centroids = _second_level(rows, index, lists, stats["n"], seed)
    some = rng.choice(len(x), min(256, len(x)), replace=False)
    products = x[some] @ x.T
    products[np.arange(len(some)), some] = -np.inf
    top = np.argpartition(-products, min(k, len(x) - 1), axis=1)[:, :k]
    rank = index.order(index.turned(x[some], True)).argsort(axis=1).argsort(axis=1)
    home = index.order(turned).argmin(axis=1)
    needed = np.take_along_axis(rank, home[top], axis=1).ravel()
    index.probes = int(np.quantile(needed, recall, method="higher")) + 1
    return index


def scan_block(
    index: Index, x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, bound: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query row its ``k`` best vectors of the block: positions of queries, ids, scores.

    ``bound`` has the score that a candidate of each query has to reach, NaN for none.  All
    pairs of the block go through the columns step by step; those that a test abandons stay
    behind, and once few are left only their vectors are read.  A query's own row takes no part.
    """
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    tx, tq = index.turned(x), index.turned(q, True)
    size = tx.shape[1]
    q2 = (tq * tq).sum(axis=1)
    bound = np.full(len(q), np.nan) if bound is None else bound
    limit = index.norm2 + q2 - 2 * bound
    unknown = np.flatnonzero(np.isnan(limit))
    if len(unknown):  # the k-th best of some vectors of the block stands in
        first = min(len(x), 4 * k + 1)
        limit[unknown] = np.inf
        if first > k + 1:
            start = q2[unknown, None] + (tx[:first] ** 2).sum(axis=1) - 2 * tq[unknown] @ tx[:first].T
            start[own[unknown, None] == ids[:first]] = np.inf
            limit[unknown] = np.partition(start, k - 1, axis=1)[:, k - 1]
    loose = 1e-9 * (index.norm2 + q2)  # rounding of the partial distances
    steps = [*range(COLUMNS, size, COLUMNS), size]
    partial = np.zeros((len(q), len(x)))
    qi = xi = part = None
    for a, b in zip([0, *steps], steps):
        xb, qb = tx[:, a:b], tq[:, a:b]
        share = b / size
        slack = (1 + EPSILON / np.sqrt(b)) ** 2 if b < size else 1.0
        allowed = limit * share * slack + loose
        if qi is None:
            partial += (qb * qb).sum(axis=1)[:, None] + (xb * xb).sum(axis=1) - 2 * qb @ xb.T
            alive = partial <= allowed[:, None]
            if b == size or np.count_nonzero(alive) < DENSE * alive.size:
                qi, xi = np.nonzero(alive)
                part = partial[qi, xi]
        else:
            for lo in range(0, len(qi), PAIRS):
                gap = xb[xi[lo : lo + PAIRS]] - qb[qi[lo : lo + PAIRS]]
                part[lo : lo + PAIRS] += (gap * gap).sum(axis=1)
            keep = part <= allowed[qi]
            qi, xi, part = qi[keep], xi[keep], part[keep]
    other = ids[xi] != own[qi]
    qi, xi = qi[other], xi[other]
    score = np.empty(len(qi))
    for lo in range(0, len(qi), PAIRS):
        score[lo : lo + PAIRS] = (x[xi[lo : lo + PAIRS]] * q[qi[lo : lo + PAIRS]]).sum(axis=1)
    best = np.lexsort((ids[xi], -score, qi))
    qi, xi, score = qi[best], xi[best], score[best]
    place = np.arange(len(qi)) - np.searchsorted(qi, qi)
    kept = place < k
    return qi[kept], ids[xi[kept]], score[kept]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its ``k`` nearest found by inner product.

    Candidates are all usable vectors but the query's own id; ties go to the smaller id.
    Scores are inner products of the original vectors in double precision.  Repeated rows
    count once.  Without usable vectors the result is empty.  ``is_query`` may refer to ``id``.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec, key)
    index = fit(rows, k)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def home(batches):
        for batch in batches:
            v = batch.column("v")
            if batch.num_rows:
                near = index.order(index.turned(_rows(v))).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), v, pa.array(near, pa.int32())], ["id", "v", "list"])

    placed = stage_table(rows.mapInArrow(home, "id long, v array<double>, list int"), "lists")
    sizes = {r["list"]: r["count"] for r in placed.groupBy("list").count().collect()}  # as many rows as centroids
    size = np.array([sizes.get(i, 0) for i in range(len(index.centroids))])

    def probe(batches):
        for batch in batches:
            v = batch.column("v")
            if batch.num_rows:
                order = index.order(index.turned(_rows(v), True)).argsort(axis=1, kind="stable")
                # further lists as long as the probed ones hold too few candidates
                before = np.cumsum(size[order], axis=1) - size[order]
                chosen = (np.arange(order.shape[1]) < index.probes) | (before < 4 * k)
                lists = [pa.array(o[c], pa.int32()) for o, c in zip(order, chosen)]
                offsets = np.concatenate([[0], chosen.sum(axis=1).cumsum()]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), v, pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(lists))], ["id", "v", "lists"]
                )

    probed = stage_table(rows.filter(is_query).mapInArrow(probe, "id long, v array<double>, lists array<int>"), "probes")

    def scan(x: pa.Table, q: pa.Table) -> pa.Table:
        if not len(x) or not len(q):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        own = np.asarray(q.column("id"))
        bound = np.asarray(q.column("bound").fill_null(float("nan")))
        vectors, asked = (_rows(t.column("v").combine_chunks()) for t in (x, q))
        row, ids, score = scan_block(index, vectors, np.asarray(x.column("id")), asked, own, k, bound)
        return pa.table({"query_id": own[row], "vec_id": ids, "score": score})

    def found(asked: DataFrame) -> DataFrame:
        """The best of each list's blocks for the queries ``(id, v, bound, list)``."""
        blocks = placed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / VECTOR_BLOCK).alias("vs"))
        # one row per list
        blocks = F.broadcast(blocks.join(asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("qs")), "list"))

        def dealt(side: DataFrame, own: str, count: str, other: str, others: str, *keep: str) -> DataFrame:
            met = side.join(blocks, "list").withColumn(own, F.pmod(F.xxhash64("id"), F.col(count)))
            every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1))
            return met.withColumn(other, every).select("list", "vb", "qb", "id", "v", *keep)

        keys = ["list", "vb", "qb"]
        left = dealt(placed, "vb", "vs", "qb", "qs").groupBy(*keys)
        right = dealt(asked, "qb", "qs", "vb", "vs", "bound").groupBy(*keys)
        return left.cogroup(right).applyInArrow(scan, "query_id long, vec_id long, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    nearest_list = probed.select("id", "v", F.lit(None).cast("double").alias("bound"), F.get("lists", F.lit(0)).alias("list"))
    first = found(nearest_list).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    first = stage_table(first, "nearest-list")
    bounds = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    others = probed.select("id", "v", F.explode(F.slice("lists", F.lit(2), F.size("lists"))).alias("list"))
    asked = stage_table(others.join(bounds, "id", "left").select("id", "v", "bound", "list"), "other-lists")
    every = found(asked).unionByName(first.drop("rank"))
    return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
