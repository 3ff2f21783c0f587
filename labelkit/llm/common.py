"""Helpers of the training-data operators: tables, bound values, ragged arrays, word caches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.session import stage_table

#: Characters per slice of an Arrow batch, so that one batch of long texts stays small in Python.
SLICE_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(docs: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as keep it apart from the columns of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z and nothing else changes.

    ``lower`` is the same for texts of ASCII only, and much faster than ``translate``.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of each run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``most`` characters, or a single longer text."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            limit = (ends[start - 1] if start else 0) + most
            stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop



class WordCache:
    """Ids of words, encoded once each by ``encode`` and kept up to ``limit`` words.

    Exact for every encoder under which the words of a text are encoded independently of
    each other.  A full cache keeps the words that most batches asked for, half of its
    limit at most, so it needs bounded memory on any input.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 500_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.start = np.zeros(1 << 12, dtype=np.int64)
        self.length = np.zeros(1 << 12, dtype=np.int32)
        self.asked = np.zeros(1 << 12, dtype=np.int32)
        self.used = 0

    def _add(self, words: list[str]) -> None:
        found = self.encode(words)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter((i for ids in found for i in ids), dtype=np.int32, count=int(lengths.sum()))
        self._append(words, flat, lengths)

    def _append(self, words: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        first, n = len(self.index), len(self.index) + len(words)
        while n > len(self.start):
            for name in ("start", "length", "asked"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[first:n] = self.used + np.cumsum(lengths) - lengths
        self.length[first:n] = lengths
        self.asked[first:n] = 0
        self.index.update(zip(words, range(first, n)))
        self.used += len(flat)

    def _shrink(self) -> None:
        """Keeps what most batches asked for; a word that one batch alone had goes first."""
        n = len(self.index)
        asked = self.asked[:n].copy()
        least = 2
        while np.count_nonzero(asked >= least) > self.limit // 2:
            least *= 2
        keep = np.flatnonzero(asked >= least)
        words = [w for w, k in zip(self.index, asked >= least) if k]
        lengths = self.length[keep].astype(np.int64)
        flat = self.flat[ragged(self.start[keep], lengths)]
        self.clear()
        self._append(words, flat, lengths)
        self.asked[: len(words)] = asked[keep] // 2  # what was frequent long ago counts less

    def places(self, words: list[str]) -> np.ndarray:
        """Where the cache has each word; valid until the next call."""
        if len(self.index) > self.limit:
            self._shrink()
        at = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        open_ = np.flatnonzero(at < 0)
        if len(open_):
            self._add(list(dict.fromkeys(words[i] for i in open_)))
            at[open_] = [self.index[words[i]] for i in open_]
        self.asked[at] += 1  # once per call, however often a word is there
        return at

    def ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words at these places, and how many each word has."""
        lengths = self.length[at].astype(np.int64)
        return self.flat[ragged(self.start[at], lengths)], lengths

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``words``, and how many each word has."""
        return self.ids_at(self.places(words))


#: Code points whose lower case and normal form are themselves or one other, everywhere.
_ODD = r"[^\x{0}-\x{12F}\x{131}-\x{24F}]"
#: A full stop or comma that belongs to a longer run of marks.
_JOINED = r"[.,][^\s\pL\pN]|[^\s\pL\pN][.,]"


def encode_column(cache: WordCache, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``texts`` one after the other, and the number of ids of each text; NULL is empty.

    For encoders that lower-case a text and encode runs of letters and runs of marks by
    themselves.  Texts are split into words by Arrow; where a text allows it, words are
    lower-cased and freed of full stops and commas first, so that fewer distinct ones are left.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    plain = pc.invert(pc.or_(pc.match_substring_regex(texts, _ODD), pc.match_substring_regex(texts, _JOINED)))
    freed = pc.utf8_lower(texts)
    for mark in ".,":
        freed = pc.replace_substring(freed, mark, f" {mark} ")
    words = pc.ascii_split_whitespace(pc.if_else(plain, freed, texts))
    counts = np.asarray(pc.list_value_length(words), dtype=np.int64)
    coded = words.flatten().dictionary_encode()
    at = cache.places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[np.asarray(coded.indices, dtype=np.int64)]
    ids, lengths = cache.ids_at(at)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    edges = np.concatenate([[0], np.cumsum(counts)])
    return ids, np.diff(ends[edges])


def encode_texts(cache: WordCache, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``texts`` one after the other, and the number of ids of each text."""
    words: list[str] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        own = text.replace("\n", " ").split(" ")
        counts[k] = len(own)
        words += own
    ids, lengths = cache.ids(words)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    edges = np.concatenate([[0], np.cumsum(counts)])
    return ids, np.diff(ends[edges])


#: A key that holds at least this share of all rows is hot; there are at most 1 / share of them.
HOT_SHARE = 1 / 5_000


def join_counted(rows: DataFrame, keys: DataFrame, on: list[str], count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row per key that says how often the key occurs.

    Keys of at least ``HOT_SHARE`` of all ``total`` rows number at most 1 / ``HOT_SHARE``,
    so they are broadcast and their rows stay where they are.  All other keys are small
    enough to be shuffled.  ``rows`` and ``keys`` are read twice: pass written tables.
    """
    limit = max(1, int(total * HOT_SHARE))
    hot = F.broadcast(keys.filter(F.col(count) >= limit))
    cold = keys.filter(F.col(count) < limit)
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(cold, on))


#: Bits of a membership filter at most; beyond an eighth as many keys it only lets more through.
FILTER_BITS = 1 << 27


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A bit map of fixed greatest size with a bit for each key: what it rejects is no key.

    Bits are set by an aggregate that combines on the map side; the map itself, of
    ``FILTER_BITS / 8`` bytes at most, is what reaches the driver.
    """
    bits = 1 << 15
    while bits < min(8 * keys.count(), FILTER_BITS):
        bits *= 2
    place = F.pmod(F.col(column), F.lit(bits))
    parts = keys.groupBy((place / 32768).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(F.pmod(place, F.lit(32768))).alias("map")
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.collect():
        out[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["map"], dtype=np.uint8)
    return out


def may_contain(bit_map: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for keys that were not among those of ``key_filter``."""
    place = keys.view(np.uint64) & np.uint64(8 * len(bit_map) - 1)
    return (bit_map[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a long, b long)``: the smallest reachable node.

    Alternates the large-star and small-star steps until no link changes.  Each step is a
    map-side combined minimum by node and a join; its result is written to shared storage.
    Before a state is written, each task makes stars of the links it holds: a chain within
    a task takes no steps, so rounds, and with them the driver's plans, stages and threads,
    are few.  Nulls, loops and repeated links have no effect.
    """
    distinct = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    state = stage_table(_local_stars(distinct), "links")
    digest = _digest(state)
    # every link a > b; done when each a has one link and no b is an a
    while True:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the digest has the number of links, so no step counts its input again
        large = stage_table(_star(both, F.col("b") > F.col("a"), include_self=True, total=2 * digest[0]), "large-star")
        after = stage_table(_local_stars(_star(large, F.lit(True), include_self=False, total=digest[0])), "small-star")
        before, digest = digest, _digest(after)
        if digest == before:
            break
        state = after
    inner = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return inner.unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


#: Links that a task holds at once.
TASK_LINKS = 1 << 20


def _local_stars(links: DataFrame, most: int = TASK_LINKS) -> DataFrame:
    """The same components, with the nodes of each task's links (``most`` at a time) linked to the smallest one they reach there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append((np.asarray(batch.column("a")), np.asarray(batch.column("b"))))
            n += batch.num_rows
            if n >= most:
                yield stars(held)
                held, n = [], 0
        if n:
            yield stars(held)

    def stars(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate(side) for side in zip(*held))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = at[: len(a)], at[len(a) :]
        root = np.arange(len(nodes))
        while True:
            rx, ry = root[x], root[y]
            apart = rx != ry
            if not apart.any():
                break
            x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
            # the larger root goes below the smallest one it meets
            np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
            while not np.array_equal(root, above := root[root]):
                root = above
        below = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[below]), pa.array(nodes[root[below]])], ["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def _star(links: DataFrame, moved: Column, include_self: bool, total: int) -> DataFrame:
    """Each neighbour ``b`` of ``a`` that is ``moved`` becomes linked with the smallest neighbour (or ``a``).

    There are at most ``total`` links.
    """
    least = links.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    least = stage_table(least.withColumn("m", F.least("a", "m")), "least")
    joined = join_counted(links, least, ["a"], "degree", total)
    out = joined.filter(moved).select(F.col("b").alias("x"), "m")
    if not include_self:
        out = out.unionByName(least.select(F.col("a").alias("x"), "m"))
    return out.filter("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
