"""Similarity join of documents by word n-grams, with vertically partitioned sets.

The n-grams of all documents have one global order: common ones last, by a count sketch of
the whole corpus, then by hash.  Two sets of Jaccard similarity s share an n-gram within
the first ``n - ceil(s n) + 1`` of either (prefix filter), whatever the order.

* Documents with equal sets form a class; only classes are joined.
* Round one compares each class with the smallest class that shares a prefix n-gram (the
  pivot), so its pairs are linear in the prefixes, also within a large group of copies.
* Round two takes pairs that share a pivot but are not connected yet.  Groups are dealt to
  several tasks in blocks.
* Each round decides the nearest pair of every class (round two: of every component) first
  and then only pairs that are not connected by those.
* In both, parity maps, whose distance never exceeds the set difference, leave the few
  pairs that can be similar.  Maps of 1,024 bits are part of the join condition of round
  two; larger sets have longer maps besides.
* Every compared pair is decided exactly: sets are cut into fragments of the order by hash
  range, partial overlaps are counted for each fragment separately and summed per pair.

Pairs of one component that no round compared cannot change it, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import components, join_counted, key_filter, may_contain, slices
from labelkit.llm.shingles import mix, shingle_sets
from labelkit.session import stage_table

SKETCH_BITS, SKETCH_PARTS = 20, 64
FRAGMENTS = 8
WORDS = 16  # 64-bit words of a parity map
BLOCK = 1024  # members of a pivot's group per task
TEXT_CHARS = 1_000_000

_U = np.uint64


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - SKETCH_BITS)).astype(np.int64)


def count_levels(docs: DataFrame, k: int) -> np.ndarray:
    """For each slot of a sketch of fixed size: log2 of its n-gram count over the mean, 0 at least.

    All documents are counted; what reaches the driver is one number per slot.
    """
    width = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in slices(batches, "text", TEXT_CHARS):
            sets = [s for s in shingle_sets(batch.column("text"), k) if len(s)]
            if sets:
                sketch += np.bincount(_slot(np.concatenate(sets)), minlength=1 << SKETCH_BITS)
        if sketch.any():
            salt = int(np.random.default_rng().integers(32))
            parts = [part.tobytes() for part in sketch.reshape(SKETCH_PARTS, width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SKETCH_PARTS), pa.int32()), pa.array([salt] * SKETCH_PARTS, pa.int32()), pa.array(parts, pa.binary())],
                ["part", "salt", "counts"],
            )

    def added(batches: Iterable[pa.RecordBatch], **key: int) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            for value in batch.column("counts"):
                total += np.frombuffer(value.as_buffer(), dtype=np.int64)
        columns = [pa.array([k], pa.int32()) for k in key.values()]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([total.tobytes()], pa.binary())], [*key, "counts"])

    def add_salted(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from added(batches, part=key[0].as_py(), salt=key[1].as_py())

    def add_all(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from added(batches, part=key[0].as_py())

    partial = docs.select("text").mapInArrow(count, "part int, salt int, counts binary")
    salted = partial.groupBy("part", "salt").applyInArrow(add_salted, "part int, salt int, counts binary")
    sketch = np.zeros((SKETCH_PARTS, width), dtype=np.int64)
    for row in salted.groupBy("part").applyInArrow(add_all, "part int, counts binary").collect():
        sketch[row["part"]] = np.frombuffer(row["counts"], dtype=np.int64)
    flat = sketch.reshape(-1)
    return np.log2(np.maximum(1.0, flat / max(1.0, flat.mean()))).astype(np.uint8)


def _class(grams: np.ndarray) -> int:
    """A 64-bit name of the set; equal sets of n-grams have equal names."""
    value = mix(np.array([mix(grams).sum(dtype=np.uint64) ^ _U(len(grams))], dtype=np.uint64))
    return int(value.view(np.int64)[0])


def _parity(grams: np.ndarray, words: int = WORDS) -> np.ndarray:
    odd = (np.bincount((grams & _U(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _wide_parity(grams: np.ndarray) -> np.ndarray:
    """A map of two to four bits per n-gram for a set that ``WORDS`` cannot tell apart, else nothing."""
    return _parity(grams, 1 << int(np.ceil(np.log2(len(grams) / 32)))) if len(grams) > 64 * WORDS else np.zeros(0, dtype=np.int64)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64) if values.dtype == _U else values, kind))


def describe(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Per document: set size, class, parity map and prefix; no class for an empty set."""
    levels = count_levels(docs, k)

    def one(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_CHARS):
            sets = shingle_sets(batch.column("text"), k)
            prefixes = []
            for grams in sets:
                take = len(grams) - -(-num * len(grams) // den) + 1 if len(grams) else 0
                prefixes.append(grams[np.argsort(levels[_slot(grams)], kind="stable")[:take]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_class(s) if len(s) else None for s in sets], pa.int64()),
                    _lists([_parity(s) for s in sets], pa.int64()),
                    _lists([_wide_parity(s) for s in sets], pa.int64()),
                    _lists(prefixes, pa.int64()),
                ],
                ["doc_id", "n", "cls", "parity", "wide", "prefix"],
            )

    return docs.mapInArrow(one, "doc_id long, n long, cls long, parity array<long>, wide array<long>, prefix array<long>")


def fragments(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``(cls, f, grams)``: each set cut at fixed hashes, for the documents of ``wanted (doc_id)``.

    A bit map of the wanted ids goes to the texts, so that no text is shuffled.  It lets
    some others through, which meet no pair; repeated rows give their fragments repeatedly.
    """
    ids = key_filter(wanted, "doc_id")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column("doc_id").fill_null(0), dtype=np.int64)
            some = batch.filter(pa.array(may_contain(ids, keys) & np.asarray(batch.column("doc_id").is_valid())))
            for part in slices([some] if some.num_rows else [], "text", TEXT_CHARS):
                names, numbers, pieces = [], [], []
                for grams in shingle_sets(part.column("text"), k):
                    edges = np.searchsorted(grams, np.array([i << 61 for i in range(1, FRAGMENTS)], dtype=np.uint64))
                    for f, piece in enumerate(np.split(grams, edges) if len(grams) else []):
                        names.append(_class(grams))
                        numbers.append(f)
                        pieces.append(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(numbers, pa.int32()), _lists(pieces, pa.int64())], ["cls", "f", "grams"]
                )

    return docs.mapInArrow(cut, "cls long, f int, grams array<long>")


def decide(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The links ``(a, b)`` among ``pairs (x, nx, y, ny)`` of classes: partial overlaps, summed."""
    ends = pairs.select(F.col("x").alias("cls")).unionByName(pairs.select(F.col("y").alias("cls"))).distinct()
    wanted = stage_table(ends.join(classes.select("cls", F.col("first_id").alias("doc_id")), "cls").select("doc_id"), "wanted")
    parts = stage_table(fragments(docs, wanted, k), "fragments")
    left = pairs.join(parts.select(F.col("cls").alias("x"), "f", F.col("grams").alias("grams_x")), "x")
    both = left.join(parts.select(F.col("cls").alias("y"), "f", F.col("grams").alias("grams_y")), ["y", "f"])
    partial = both.groupBy("x", "nx", "y", "ny", "f").agg(F.max(F.size(F.array_intersect("grams_x", "grams_y"))).alias("part"))
    overlap = partial.groupBy("x", "nx", "y", "ny").agg(F.sum("part").alias("both"))
    similar = F.col("both") * den >= (F.col("nx") + F.col("ny") - F.col("both")) * num
    return overlap.filter(similar).select(F.col("x").alias("a"), F.col("y").alias("b"))


def _apart(x: str, y: str) -> Column:
    """Bits in which the parity maps ``<x>0``... and ``<y>0``... differ."""
    apart = F.bit_count(F.col(f"{x}0").bitwiseXOR(F.col(f"{y}0")))
    for i in range(1, WORDS):
        apart = apart + F.bit_count(F.col(f"{x}{i}").bitwiseXOR(F.col(f"{y}{i}")))
    return apart


def _may_be_similar(x: str, y: str, num: int, den: int) -> Column:
    """Whether sizes ``n<x>``, ``n<y>`` and the words ``<x>0``... of the parity maps allow the similarity.

    Each element that one set has and the other has not flips one bit, so the maps never
    differ in more bits than the sets in elements.
    """
    nx, ny, apart = F.col(f"n{x}"), F.col(f"n{y}"), _apart(x, y)
    return (F.least(nx, ny) * den >= F.greatest(nx, ny) * num) & (apart * (num + den) <= (nx + ny) * (den - num))


def _wide_allow(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The ``pairs (x, nx, y, ny, apart)`` whose wide maps, where both have one, allow the similarity.

    Sets this similar differ in size by less than a factor of two, so one map is at most
    twice as long as the other; its halves are then laid on each other.
    """
    x = classes.select(F.col("cls").alias("x"), F.col("wide").alias("wx"))
    y = classes.select(F.col("cls").alias("y"), F.col("wide").alias("wy"))

    def folded(a: Column, b: Column) -> Column:
        half = (F.size(a) / 2).cast("int")
        both = F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(a) > F.size(b), both).otherwise(a)

    bits = F.zip_with(folded(F.col("wx"), F.col("wy")), folded(F.col("wy"), F.col("wx")), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    wide = F.aggregate(bits, F.lit(0), lambda s, b: s + F.coalesce(b, F.lit(0)))
    small = (F.size("wx") == 0) | (F.size("wy") == 0)
    may = small | (wide * (num + den) <= (F.col("nx") + F.col("ny")) * (den - num))
    return pairs.join(x, "x").join(y, "y").filter(may).select("x", "nx", "y", "ny", "apart")


def _side(rows: DataFrame, name: str, *keep: str) -> DataFrame:
    """Columns ``cls``, ``n`` and ``parity`` under the names of one side of a pair."""
    words = [F.col("parity")[i].alias(f"{name}{i}") for i in range(WORDS)]
    return rows.select(*keep, F.col("cls").alias(name), F.col("n").alias(f"n{name}"), *words)


def _unresolved(pairs: DataFrame, classes: DataFrame, groups: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that share a pivot, lie in different components and may be similar by their parity maps."""
    label = classes.join(groups.select(F.col("node").alias("cls"), "component"), "cls", "left").select(
        "cls", "n", "parity", F.coalesce("component", "cls").alias("component")
    )
    members = stage_table(pairs.select("y", F.col("x").alias("cls")).join(label, "cls"), "members")
    open_groups = members.groupBy("y").agg(
        F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_groups = open_groups.filter("low <> high").select("y", "size", (F.floor((F.col("size") - 1) / BLOCK) + 1).alias("blocks"))
    open_groups = stage_table(open_groups, "open-pivots")
    rows = join_counted(members, open_groups, ["y"], "size", members.count())
    one = rows.withColumn("block", F.pmod(F.xxhash64("cls"), "blocks"))
    two = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    a = _side(one, "a", "y", "block", F.col("component").alias("ca"))
    b = _side(two, "b", "y", "block", F.col("component").alias("cb"))
    open_pair = (F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b")) & _may_be_similar("a", "b", num, den)
    found = a.alias("l").join(b.alias("r"), (F.col("l.y") == F.col("r.y")) & (F.col("l.block") == F.col("r.block")) & open_pair)
    pairs = found.select(F.col("a").alias("x"), F.col("na").alias("nx"), F.col("b").alias("y"), F.col("nb").alias("ny"), _apart("a", "b").alias("apart"), "ca", "cb")
    return pairs.distinct()


def _nearest_first(pairs: DataFrame, sides: tuple[str, str], check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The links among ``pairs``, without those that others make superfluous.

    ``check`` decides pairs exactly.  First it gets one pair for each node of either
    ``sides`` column, the one whose parity maps differ least.  What those link need not be
    compared again: a second pass checks the pairs whose ends do not have the same
    smallest neighbour.  In a large group of near copies the first pass links nearly all,
    so pairs that are decided grow with the members, not with their pairs.
    """
    a, b = sides
    best = F.min(F.struct("apart", "x", "y"))
    first = pairs.groupBy(a).agg(best.alias("_p")).unionByName(pairs.groupBy(b).agg(best.alias("_p")).withColumnRenamed(b, a))
    first = stage_table(first.select("_p.x", "_p.y").distinct().join(pairs, ["x", "y"]), "nearest-pairs")
    links = stage_table(check(first), "nearest-links")
    linked = links.select(F.col("a").alias("x"), F.col("b").alias("y")).join(first, ["x", "y"])
    ends = linked.select(F.col(a).alias("n"), F.col(b).alias("m")).unionByName(linked.select(F.col(b).alias("n"), F.col(a).alias("m")))
    one = stage_table(ends.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("m")), "least-neighbour")
    two = one.join(one.select(F.col("n").alias("m"), F.col("m").alias("further")), "m").select("n", F.least("m", "further").alias("m"))
    rep = stage_table(two, "representative")

    def named(rows: DataFrame, end: str) -> DataFrame:
        own = rep.select(F.col("n").alias(end), F.col("m").alias(f"_{end}"))
        return rows.join(own, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))

    rest = named(named(pairs, a), b)
    rest = rest.filter(F.col(f"_{a}") != F.col(f"_{b}")).select(*pairs.columns).join(first.select("x", "y"), ["x", "y"], "left_anti")
    return links.unionByName(check(stage_table(rest, "other-pairs")))


def _shared_grams(described: DataFrame) -> DataFrame:
    """Distinct pairs ``(x, nx, y, ny)`` of a class and the smallest class that shares a prefix n-gram with it, with their sizes."""
    entries = described.filter("cls IS NOT NULL").select(F.explode("prefix").alias("gram"), F.col("cls").alias("x"), F.col("n").cast("int").alias("nx"))
    shared = entries.groupBy("gram").agg(F.min(F.struct("x", "nx")).alias("y"), F.max("x").alias("last")).filter("y.x <> last")
    shared = shared.select("gram", F.col("y.x").alias("y"), F.col("y.nx").alias("ny"))
    shared = stage_table(shared, "shared")
    grams = key_filter(shared, "gram")

    def prune(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            values = np.asarray(prefix.flatten())
            keep = may_contain(grams, values)
            owner = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(prefix)))[keep]
            owner = pa.array(owner)
            columns = [pa.array(values[keep]), batch.column("cls").take(owner), batch.column("n").take(owner)]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "x", "nx"])

    rows = described.filter("cls IS NOT NULL").select("cls", F.col("n").cast("int").alias("n"), "prefix")
    kept = rows.mapInArrow(prune, "gram long, x long, nx int")
    kept = stage_table(kept.distinct(), "entries")
    counted = stage_table(
        shared.join(kept.groupBy("gram").agg(F.count(F.lit(1)).alias("size")), "gram"), "shared-sizes"
    )
    return join_counted(kept, counted, ["gram"], "size", kept.count()).filter("x <> y").select("x", "nx", "y", "ny").distinct()


def near_groups(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs``.

    Documents whose sets of distinct ``k``-word n-grams have a Jaccard similarity of at
    least ``num / den`` are linked; ``component_id`` is the smallest ``doc_id`` reachable.
    Words are runs without ASCII white space, A-Z as a-z; a text of fewer than ``k`` words
    has one n-gram.  A text without words, or null, is linked with nothing.  Rows with the
    same id and text count once.  A null ``doc_id`` gets the component of its class, and
    null if no document with an id shares its set.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    described = stage_table(describe(docs, k, num, den), "described")
    classes = stage_table(
        described.filter("cls IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("wide").alias("wide"), F.count(F.lit(1)).alias("copies")),
        "classes",
    )
    pairs = stage_table(_shared_grams(described.filter("doc_id IS NOT NULL")), "pairs")
    # maps go to pairs of similar sizes only
    sized = pairs.filter(F.least("nx", "ny") * den >= F.greatest("nx", "ny") * num).select("x", "y")
    both = sized.join(_side(classes, "x"), "x").join(_side(classes, "y"), "y").filter(_may_be_similar("x", "y", num, den))
    both = both.withColumn("apart", _apart("x", "y"))
    both = _wide_allow(both.select("x", "nx", "y", "ny", "apart"), classes, num, den)
    both = stage_table(both, "first-candidates")

    def check(some: DataFrame) -> DataFrame:
        return decide(some.select("x", "nx", "y", "ny"), docs, classes, k, num, den)

    first = stage_table(_nearest_first(both, ("x", "y"), check), "links")
    candidates = _unresolved(pairs, classes, components(first), num, den)
    kept = _wide_allow(candidates.drop("ca", "cb"), classes, num, den)
    candidates = stage_table(candidates.join(kept.select("x", "y"), ["x", "y"], "left_semi"), "candidates")
    second = _nearest_first(candidates, ("ca", "cb"), check)
    groups = components(first.unionByName(second))
    named = classes.join(groups.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "first_id", "copies", F.coalesce("component", "cls").alias("component")
    )
    named = stage_table(named, "named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    n_classes = named.count()
    labels = stage_table(
        join_counted(named, stage_table(least, "least-id"), ["component"], "classes", n_classes).select("cls", "component_id", "copies"), "labels"
    )
    rows = described.select("doc_id", F.col("n").alias("n_shingles"), "cls")
    with_class = join_counted(rows.filter("cls IS NOT NULL"), labels, ["cls"], "copies", described.count()).select(
        "doc_id", "n_shingles", "component_id"
    )
    # no words, or a set that only rows without an id have
    alone = rows.join(labels.select("cls"), "cls", "left_anti").select(
        "doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).alias("component_id")
    )
    return with_class.unionByName(alone)
