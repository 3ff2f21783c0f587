"""How far the word use of each source departs from the other sources of its language.

The terms of a language form a matrix of sources by terms.  Comparing every two sources is a
product of that matrix with its transpose, taken row by row (Gustavson): a group goes through
its own terms, and each term's postings in the term-major index add to one dense accumulator
with a place per peer.  Pairs of postings are never rows.  The measure is not zero where a
count is, so accumulators hold the departure from the value at count 0, and these baselines
are added from the counts of counts of each group.

All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkit.llm.common import ragged, slices, text_or_empty
from labelkit.session import stage_table

#: Fixed value: shares are in parts of this.
UNIT = 1_000_000_000
#: Groups whose names and totals go to every task; their pairs are the result.
MOST_GROUPS = 100_000
#: Distinct (group, term) pairs that a task counts before it sends them on.
HELD_TERMS = 200_000
#: Postings of the index that are multiplied at once, and products held at once.
BLOCK, PRODUCTS = 1 << 19, 1 << 20
#: Parts of a group's terms that are ranked separately before the first ones of all parts.
PARTS = 64


def _letters() -> bytes:
    """Translation of bytes: A-Z lower-cased, other bytes that are no part of a term blank."""
    out = bytearray(b" " * 256)
    for c in range(ord("a"), ord("z") + 1):
        out[c] = out[c - 32] = c
    out[128:] = bytes(range(128, 256))
    return bytes(out)


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and of code points beyond ASCII, A-Z lower-cased."""
    return text.translate(_LETTERS).split()


_LETTERS = _letters()


@dataclass(frozen=True)
class Groups:
    """The (lang, source) groups by number: sorted, so the peers of a group lie side by side."""

    names: list[tuple[str, str]]
    lang: np.ndarray  # number of the language of each group
    low: np.ndarray  # first group of each language
    high: np.ndarray  # one past its last group

    @staticmethod
    def of(docs: DataFrame) -> Groups:
        rows = docs.select("_lang", "_source").distinct().limit(MOST_GROUPS + 1).collect()
        if len(rows) > MOST_GROUPS:
            raise ValueError(f"more than {MOST_GROUPS} groups of language and source to compare pairwise")
        names = sorted(tuple(r) for r in rows)
        langs = sorted({lang for lang, _ in names})
        number = {lang: i for i, lang in enumerate(langs)}
        lang = np.array([number[x] for x, _ in names], dtype=np.int64)
        span = np.arange(len(langs))
        return Groups(names, lang, np.searchsorted(lang, span), np.searchsorted(lang, span, side="right"))


def count_terms(docs: DataFrame, groups: Groups) -> DataFrame:
    """``(g, l, term, n, d)``: occurrences and documents of each term in each group.

    Tasks count in a table of bounded size and send its rows on when it is full.
    """
    number = {name: g for g, name in enumerate(groups.names)}
    lang = groups.lang

    def sent(held: dict[int, dict[bytes, list[int]]]) -> pa.RecordBatch:
        g = np.repeat(list(held), [len(x) for x in held.values()]).astype(np.int64)
        both = np.array([c for x in held.values() for c in x.values()], dtype=np.int64).reshape(-1, 2)
        words = pa.array([t for x in held.values() for t in x], type=pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(g), pa.array(lang[g]), words, pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())],
            names=["g", "l", "term", "n", "d"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[bytes, list[int]]] = defaultdict(dict)
        size = 0
        for part in slices(batches, "_text"):
            named = zip(part.column("_lang").to_pylist(), part.column("_source").to_pylist())
            for name, text in zip(named, part.column("_text").to_pylist()):
                own = held[number[name]]
                size -= len(own)
                for term, n in Counter(terms(text)).items():
                    both = own.get(term)
                    if both is None:
                        own[term] = [n, 1]
                    else:
                        both[0] += n
                        both[1] += 1
                size += len(own)
            if size > HELD_TERMS:
                yield sent(held)
                held, size = defaultdict(dict), 0
        if size:
            yield sent(held)

    rows = docs.select("_lang", "_source", F.col("_text").cast("binary").alias("_text"))
    partial = rows.mapInArrow(count, "g long, l long, term string, n long, d long")
    return partial.groupBy("g", "l", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def term_index(counts: DataFrame, least_docs: int) -> DataFrame:
    """``(l, term, total, postings)``: the kept terms of each language with the groups that have them.

    A row has a posting per source of the language at most.
    """
    posting = F.struct("g", "n")
    return (
        counts.groupBy("l", "term")
        .agg(F.sum("d").alias("_d"), F.sum("n").alias("total"), F.collect_list(posting).alias("postings"))
        .filter(F.col("_d") >= least_docs)
        .drop("_d")
    )


def share(count: np.ndarray, denominator: np.ndarray) -> np.ndarray:
    """``1 + floor(UNIT * (count + 1) / denominator)`` without overflow, by long division in base 1000."""
    rest, out = count + 1, np.zeros(np.broadcast(count, denominator).shape, dtype=np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // denominator
        rest = rest % denominator
    return out + 1


def departure(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


@dataclass(frozen=True)
class Totals:
    """Per group: the denominator of its shares, its share at count 0, and the kept terms of its language."""

    denominator: np.ndarray
    zero: np.ndarray
    terms: np.ndarray

    @staticmethod
    def of(index: DataFrame, groups: Groups) -> Totals:
        """Reads one row per group and per language."""
        n = np.zeros(len(groups.names), dtype=np.int64)
        kept = np.zeros(len(groups.low), dtype=np.int64)
        for row in index.select(F.explode("postings").alias("p")).groupBy("p.g").agg(F.sum("p.n").alias("n")).collect():
            n[row["g"]] = row["n"]
        for row in index.groupBy("l").agg(F.count(F.lit(1)).alias("v")).collect():
            kept[row["l"]] = row["v"]
        denominator = np.maximum(n + kept[groups.lang], 1)
        return Totals(denominator, share(np.zeros_like(n), denominator), kept[groups.lang])


def _rows(values: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A batch of (g, peers, values) as rows ``(g, h, value)``."""
    g = np.repeat([x[0] for x in values], [len(x[1]) for x in values]).astype(np.int64)
    h = np.concatenate([x[1] for x in values]) if values else g
    value = np.concatenate([x[2] for x in values]) if values else g
    return pa.RecordBatch.from_arrays([pa.array(g), pa.array(h.astype(np.int64)), pa.array(value)], names=["g", "h", "value"])


def scatter(groups: Groups, totals: Totals):
    """The row accumulation over the blocks of the term-major index that a task reads."""
    lang, low, high = groups.lang, groups.low, groups.high
    denominator, zero = totals.denominator, totals.zero

    def block(g: np.ndarray, n: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``g, n`` are the postings of consecutive terms, ``size`` of them each."""
        p = share(n, denominator[g])
        first = np.cumsum(size) - size
        term = np.repeat(np.arange(len(size)), size)
        order = np.argsort(g, kind="stable")
        groups_here, begin = np.unique(g[order], return_index=True)
        for own, lo, hi in zip(groups_here, begin, [*begin[1:], len(order)]):
            start = low[lang[own]]
            peers = np.zeros(high[lang[own]] - start, dtype=np.int64)  # the dense accumulator of this row
            touched = np.zeros(len(peers), dtype=bool)
            at = order[lo:hi]
            reach = np.cumsum(size[term[at]])
            done = 0
            while done < len(at):
                stop = max(done + 1, int(np.searchsorted(reach, (reach[done - 1] if done else 0) + PRODUCTS, side="right")))
                some = at[done:stop]
                lengths = size[term[some]]
                theirs = ragged(first[term[some]], lengths)
                mine = np.repeat(p[some], lengths)
                h = g[theirs]
                z = zero[own]
                gain = departure(mine, p[theirs]) - departure(mine, zero[h]) - departure(z, p[theirs]) + departure(z, zero[h])
                np.add.at(peers, h - start, gain)
                touched[h - start] = True
                done = stop
            touched[own - start] = False
            there = np.flatnonzero(touched)
            yield int(own), there + start, peers[there]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("postings")
            size = np.asarray(lists.value_lengths(), dtype=np.int64)
            flat = lists.flatten()
            g = np.asarray(flat.field("g"), dtype=np.int64)
            n = np.asarray(flat.field("n"), dtype=np.int64)
            ends = np.cumsum(size)
            done = 0
            while done < len(size):
                before = ends[done - 1] if done else 0
                stop = max(done + 1, int(np.searchsorted(ends, before + BLOCK, side="right")))
                yield _rows(list(block(g[before : ends[stop - 1]], n[before : ends[stop - 1]], size[done:stop])))
                done = stop

    return run


def baselines(groups: Groups, totals: Totals):
    """What a group's terms add against peers without them, from ``(g, n, m)``: ``m`` terms occur ``n`` times.

    For each group the values of its own row (its shares against the peers' share at count
    0) and of its column (the peers' share at count 0 against its shares).
    """
    lang, low, high = groups.lang, groups.low, groups.high
    denominator, zero = totals.denominator, totals.zero

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, n, m = (np.asarray(batch.column(c), dtype=np.int64) for c in ("g", "n", "m"))
            order = np.argsort(g, kind="stable")
            owners, begin = np.unique(g[order], return_index=True)
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            for own, lo, hi in zip(owners, begin, [*begin[1:], len(order)]):
                peers = np.arange(low[lang[own]], high[lang[own]])
                row, column = np.zeros(len(peers), dtype=np.int64), np.zeros(len(peers), dtype=np.int64)
                z, theirs = zero[own], zero[peers][None, :]
                step = max(1, PRODUCTS // len(peers))
                for at in (order[i : min(i + step, hi)] for i in range(lo, hi, step)):
                    p = share(n[at], denominator[g[at]])[:, None]
                    row += (m[at][:, None] * (departure(p, theirs) - departure(z, theirs))).sum(axis=0)
                    column += (m[at][:, None] * (departure(theirs, p) - departure(theirs, z))).sum(axis=0)
                others = peers != own
                out.append((int(own), peers[others], row[others]))
                out += [(int(h), np.array([own]), column[i : i + 1]) for i, h in enumerate(peers) if h != own]
            yield _rows(out)

    return run


def pair_values(index: DataFrame, groups: Groups, totals: Totals) -> DataFrame:
    """``(g, h, value)`` of every two groups of a language: the sum of departures over its kept terms."""
    schema = "g long, h long, value long"
    spark = index.sparkSession
    met = index.select("postings").mapInArrow(scatter(groups, totals), schema)
    flat = index.select(F.explode("postings").alias("p")).select("p.g", "p.n")
    counts = flat.groupBy("g", "n").agg(F.count(F.lit(1)).alias("m"))
    at_zero = counts.mapInArrow(baselines(groups, totals), schema)
    zero = totals.zero
    low, high = groups.low[groups.lang], groups.high[groups.lang]

    def empty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The value of a pair if no kept term occurred in either."""
        for batch in batches:
            rows = []
            for g in np.asarray(batch.column("id"), dtype=np.int64):
                peers = np.delete(np.arange(low[g], high[g]), g - low[g])
                rows.append((int(g), peers, totals.terms[g] * departure(zero[g], zero[peers])))
            yield _rows(rows)

    none = spark.range(len(groups.names)).mapInArrow(empty, schema)
    return met.unionByName(at_zero).unionByName(none).groupBy("g", "h").agg(F.sum("value").alias("value"))


def _share(count: Column, denominator: Column) -> Column:
    """:func:`share` as a Column; the decimals hold products of 19 and 10 digits."""
    scaled = (count.cast("decimal(20,0)") + 1) * F.lit(UNIT).cast("decimal(10,0)")
    # the remainder is exact, so the difference divides without a rest
    return ((scaled - scaled % denominator.cast("decimal(20,0)")) / denominator.cast("decimal(20,0)")).cast("long") + 1


def term_values(index: DataFrame, groups: Groups, totals: Totals, limit: int) -> DataFrame:
    """``(g, term, value, rank)`` of the ``limit`` terms that each group uses most beyond its language.

    The terms of a group are ranked in ``PARTS`` parts first, so that no task ranks them all.
    """
    spark = index.sparkSession
    of_lang = [int(totals.denominator[a:b].sum() - (b - a - 1) * totals.terms[a]) for a, b in zip(groups.low, groups.high)]
    rows = [(g, int(totals.denominator[g]), of_lang[groups.lang[g]]) for g in range(len(groups.names))]
    sizes = F.broadcast(spark.createDataFrame(rows, "g long, _own long, _all long"))  # at most MOST_GROUPS rows
    flat = index.select("term", "total", F.explode("postings").alias("_p")).select("term", "total", "_p.g", "_p.n")
    p, q = F.col("_p"), F.col("_q")
    found = (
        flat.join(sizes, "g")
        .select("g", "term", _share(F.col("n"), F.col("_own")).alias("_p"), _share(F.col("total"), F.col("_all")).alias("_q"))
        .filter(p > q)
        .select("g", "term", F.expr("(_p - _q) * (_p - _q) div _q").alias("value"))
        .withColumn("_part", F.pmod(F.hash("term"), F.lit(PARTS)))
    )
    part = Window.partitionBy("g", "_part").orderBy(F.desc("value"), "term")
    whole = Window.partitionBy("g").orderBy(F.desc("value"), "term")
    first = found.withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= limit).drop("_rank", "_part")
    return first.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= limit)


def audit(docs: DataFrame, least_docs: int = 3, limit: int = 200, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: departures of each source of a language.

    Part ``pair`` has a row for each other source of the language, part ``term`` one for each
    of the ``limit`` terms that the source uses most beyond the language.  A term counts if
    ``least_docs`` documents of the language have it; ranks are by falling value, then item.

    NULL in any of the three columns is the empty string.  A group without terms has shares of
    count 0 only, a language without kept terms values of 0.  Each row is a document of its
    own, so repeated rows count as often as they are there.  An empty table gives no rows; other
    columns are not read.  A task holds about a million characters, or one longer text.
    More than ``MOST_GROUPS`` groups end with an error: the pairs are the result.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("_lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
        text_or_empty(text).alias("_text"),
    )
    spark = docs.sparkSession
    groups = Groups.of(rows)
    index = stage_table(term_index(count_terms(rows, groups), least_docs), "term-index")
    totals = Totals.of(index, groups)
    names = spark.createDataFrame([(g, *name) for g, name in enumerate(groups.names)], "g long, lang string, source string")
    names = F.broadcast(names)  # at most MOST_GROUPS rows
    peers = names.select(F.col("g").alias("h"), F.col("source").alias("item"))
    by_value = Window.partitionBy("g").orderBy(F.desc("value"), "item")
    pairs = pair_values(index, groups, totals).join(peers, "h").withColumn("rank", F.row_number().over(by_value))
    found = term_values(index, groups, totals, limit).withColumnRenamed("term", "item")
    columns = ["g", "item", "value", "rank"]
    parts = pairs.select(F.lit("pair").alias("part"), *columns).unionByName(found.select(F.lit("term").alias("part"), *columns))
    return parts.join(names, "g").select("lang", "source", "part", "item", "value", "rank")
