"""Language identification by prediction by partial matching over bytes.

For each language a tree of byte contexts up to ``order`` is counted over all labelled texts
and then frozen.  The number of strings in the model is bounded: beyond it the rare ones of
the whole corpus are left out, which are then coded in a shorter context.  A byte seen ``c`` times in a context that was seen
``n`` times with ``d`` different bytes costs ``-log2(c / (n + d))`` bits; any other byte
costs the escape ``-log2(d / (n + d))`` and is coded in the next shorter context, in the
end uniformly over 256 bytes.  The language with the shortest code of the whole text wins.

The trees of all languages are laid out together: one row per context and byte that any
language has seen, with its code length in each language.  Scoring is one look-up per byte.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.llm.common import ragged, slices, unused
from labelkit.session import stage_table

PAD = 10  # the bytes before a text count as line ends
CHUNK = 1_000_000
#: Strings that a task counts before it sends them on.
HELD = 1_000_000
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_U = np.uint64


class HashTable:
    """Row numbers of distinct 64-bit keys, by open addressing in numpy arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.row = np.full(1 << self.bits, -1, dtype=np.int32)
        self.key = np.zeros(1 << self.bits, dtype=np.uint64)
        left, slot = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.row[slot] < 0
            where, first = np.unique(slot[free], return_index=True)
            placed = left[free][first]
            self.row[where], self.key[where] = placed, keys[placed]
            keep = np.ones(len(left), dtype=bool)
            keep[np.flatnonzero(free)[first]] = False
            left, slot = left[keep], (slot[keep] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        slot = self._home(keys)
        out = self.row[slot]
        open_ = np.flatnonzero((out >= 0) & (self.key[slot] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            out[open_] = self.row[slot[open_]]
            open_ = open_[(out[open_] >= 0) & (self.key[slot[open_]] != keys[open_])]
        return out


@dataclass
class PpmModel:
    """Frozen code lengths: ``cost[j]`` of byte strings of length j + 1, ``escape[j]`` of contexts."""

    languages: list[str]
    order: int
    grams: list[HashTable]
    cost: list[np.ndarray]
    contexts: list[HashTable]
    escape: list[np.ndarray]

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text (rows) in each language (columns)."""
        out = np.zeros((len(texts), len(self.languages)))
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        data = np.frombuffer((bytes([PAD]) * self.order).join([b"", *texts]), dtype=np.uint8)
        data = LOWER[data]
        ends = np.cumsum(sizes + self.order)
        at = ragged(ends - sizes, sizes)
        owner = np.repeat(np.arange(len(texts)), sizes)
        for lo in range(0, len(at), CHUNK):
            where, own = at[lo : lo + CHUNK], owner[lo : lo + CHUNK]
            costs = self._costs(data, where)
            first = np.flatnonzero(np.diff(own, prepend=-1))
            out[own[first]] += np.add.reduceat(costs, first, axis=0, dtype=np.float64)
        return out

    def _costs(self, data: np.ndarray, where: np.ndarray) -> np.ndarray:
        key = np.zeros(len(where), dtype=np.uint64)
        for back in range(self.order, -1, -1):
            key = (key << _U(8)) | data[where - back].astype(np.uint64)
        row = self.grams[self.order].find(key)
        out = self.cost[self.order][row]
        left = np.flatnonzero(row < 0)
        out[left] = 0
        key = key[left]
        for j in range(self.order, -1, -1):
            if j < self.order:
                key &= _U((1 << (8 * (j + 1))) - 1)
                row = self.grams[j].find(key)
                hit = row >= 0
                out[left[hit]] += self.cost[j][row[hit]]
                left, key = left[~hit], key[~hit]
            context = self.contexts[j].find(key >> _U(8))
            known = context >= 0
            out[left[known]] += self.escape[j][context[known]]
        out[left] += 8
        return out


def freeze(languages: list[str], order: int, lang: np.ndarray, length: np.ndarray, key: np.ndarray, count: np.ndarray) -> PpmModel:
    """The model from counts of byte strings: number of the language, length, string as a number, count."""
    n = len(languages)
    grams, cost, contexts, escape = [], [], [], []
    for j in range(order + 1):
        own = length == j + 1
        keys, row = np.unique(key[own], return_inverse=True)
        c = np.zeros((len(keys), n))
        np.add.at(c, (row, lang[own]), count[own])
        ctx, parent = np.unique(keys >> _U(8), return_inverse=True)
        total, kinds = np.zeros((len(ctx), n)), np.zeros((len(ctx), n))
        np.add.at(total, parent, c)
        np.add.at(kinds, parent, c > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            leave = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
            stay = -np.log2(c / (total + kinds)[parent])
        if j:
            shorter = keys & _U((1 << (8 * j)) - 1)
            below = cost[j - 1][grams[j - 1].find(shorter)]  # whatever a longer context has seen, a shorter one has
        else:
            below = np.full((len(keys), n), 8.0)
        grams.append(HashTable(keys))
        contexts.append(HashTable(ctx))
        escape.append(leave.astype(np.float32))
        cost.append(np.where(c > 0, stay, leave[parent] + below).astype(np.float32))
    return PpmModel(languages, order, grams, cost, contexts, escape)


def training_sample(docs: DataFrame, sample_chars: int, text: str, lang: str) -> DataFrame:
    """Whole labelled texts of about ``sample_chars`` code points per language, chosen by a hash of the id.

    The first text by that hash is in it however long the texts of its language are.
    """
    known = docs.filter(F.col(lang).isNotNull() & (F.length(text) > 0)).select("doc_id", F.col(text).alias("text"), F.col(lang).alias("lang"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = known.groupBy("lang").agg((F.lit(sample_chars * 1.5) / F.sum(F.length("text"))).alias("share"), F.min(draw).alias("least"))
    some = known.join(F.broadcast(share), "lang").withColumn("draw", draw).filter("draw < share OR draw = least")
    before = Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1)
    return some.withColumn("before", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))).filter(
        F.col("before") < sample_chars
    )


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all ``(keys, counts)``, sorted, with the sums of their counts."""
    keys, row = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(row, weights=np.concatenate([c for _, c in parts])).astype(np.int64)


def string_counts(texts: DataFrame, order: int) -> DataFrame:
    """``(lang, gram, count)``: byte strings of length ``order + 1`` of all ``texts (lang, text)``.

    ``order`` line ends stand before the first text and behind every text.  A task counts in
    tables of at most ``HELD`` strings before it sends them on.
    """

    def rows(name: str, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([name]).take(pa.array(np.zeros(len(keys), dtype=np.int32))), pa.array(keys.view(np.int64)), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "gram", "count"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in slices(batches, "text"):
            names = batch.column("lang").to_pylist()
            encoded = [t.encode() for t in batch.column("text").to_pylist()]
            for name in dict.fromkeys(names):
                ends = bytes([PAD]) * order
                own = LOWER[np.frombuffer(ends + b"".join(t + ends for t, of in zip(encoded, names) if of == name), dtype=np.uint8)]
                key = np.zeros(len(own) - order, dtype=np.uint64)
                for j in range(order + 1):
                    key |= own[order - j : len(own) - j].astype(np.uint64) << _U(8 * j)
                held.setdefault(name, []).append(np.unique(key, return_counts=True))
            if sum(len(k) for parts in held.values() for k, _ in parts) > HELD:
                held = {name: [_merged(parts)] for name, parts in held.items()}
                if sum(len(parts[0][0]) for parts in held.values()) > HELD // 2:
                    yield from (rows(name, *parts[0]) for name, parts in held.items())
                    held = {}
        yield from (rows(name, *_merged(parts)) for name, parts in held.items())

    counted = texts.select("lang", "text").mapInArrow(count, "lang string, gram long, count long")
    return counted.groupBy("lang", "gram").agg(F.sum("count").alias("count"))


def fit(
    docs: DataFrame, order: int = 4, sample_chars: int | None = None, text: str = "text", lang: str = "lang", most_strings: int = 1_000_000
) -> PpmModel | None:
    """Context trees of every language in ``docs``; ``None`` without labelled text.

    All labelled texts are counted; ``sample_chars`` asks for about as many code points per
    language instead.  ``most_strings`` bounds the model, which the driver holds and every
    task gets: if there are more strings, over all languages and lengths, the model holds
    those that occur often enough for as many.  The number of languages is taken to be small.
    """
    if sample_chars is None:
        labelled = docs.filter(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    else:
        labelled = training_sample(docs, sample_chars, text, lang)
    longest = stage_table(string_counts(labelled, order), "lang-strings")
    # every byte ends one of the longest strings, so these give the counts of all shorter ones
    ends = [F.struct(F.lit(j + 1).alias("length"), F.col("gram").bitwiseAND(F.lit((1 << (8 * (j + 1))) - 1)).alias("gram")) for j in range(order)]
    shorter = longest.select("lang", "count", F.inline(F.array(*ends))).groupBy("lang", "length", "gram").agg(F.sum("count").alias("count"))
    columns = ["lang", "length", "gram", "count"]
    counts = stage_table(longest.withColumn("length", F.lit(order + 1)).select(*columns).unionByName(shorter.select(*columns)), "lang-contexts")
    # by steps of the logarithm, of which there are few however large the corpus is
    step = F.floor(F.log2("count") * 64)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()
    # a string is at least as frequent as a longer one that ends in it, so the model never holds the longer one alone
    least, left = float("inf"), most_strings
    for row in steps:
        if row["n"] > left:
            break
        least, left = row["step"], left - row["n"]
    found = counts.filter((step >= F.lit(least)) | (F.col("length") == 1)).toArrow()
    if not found.num_rows:
        return None
    names = sorted(found.column("lang").unique().to_pylist())
    coded = found.column("lang").combine_chunks().dictionary_encode()
    numbers = np.array([names.index(x) for x in coded.dictionary.to_pylist()])
    lang_number = numbers[coded.indices.to_numpy()]
    length, gram, count_ = (found.column(c).to_numpy() for c in ("length", "gram", "count"))
    return freeze(names, order, lang_number, length, gram.view(np.uint64), count_)


PREDICTION = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("byte_bits", T.DoubleType())]
)


def identify(docs: DataFrame, model: PpmModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``byte_bits``, replacing columns of these names.

    ``lang_pred`` is the language of the shortest code, the first by name of equal ones,
    and ``und`` (score 0, no ``byte_bits``) if the text is null or has no letters, or
    without a model.  ``score`` is the posterior of the language under equal priors and
    ``byte_bits`` its code length per byte of UTF-8.  Only the text column goes to Python.
    """
    names = ["lang_pred", "score", "byte_bits"]
    docs = docs.drop(*names)
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "byte_bits": F.lit(None).cast("double")})

    def predict(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            found = [np.zeros(0, dtype=np.int64)], [np.zeros(0)], [np.zeros(0)]
            for part in _parts(array):
                texts = [(t or "").encode() for t in part.to_pylist()]
                bits = model.bits(texts)
                best = bits.argmin(axis=1)
                low = bits.min(axis=1)
                found[0].append(best)
                found[1].append(1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(axis=1))
                found[2].append(low / np.maximum(1, [len(t) for t in texts]))
            best, score, rate = map(np.concatenate, found)
            labels = pa.array(model.languages).take(pa.array(best)) if len(best) else pa.array([], pa.string())
            yield pa.StructArray.from_arrays([labels, pa.array(score), pa.array(rate)], names)

    # arrow_udf reads the types of the iterator from these hints
    predict.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    (ppm,) = unused(docs, "__ppm")
    # a filter on the prediction must not run the model a second time
    model_udf = F.arrow_udf(predict, PREDICTION).asNondeterministic()
    scored = docs.withColumn(ppm, model_udf(F.coalesce(F.col(text), F.lit(""))))
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    out = {c: F.when(letters, F.col(ppm)[c]) for c in names}
    out["lang_pred"] = F.coalesce(out["lang_pred"], F.lit("und"))
    out["score"] = F.coalesce(out["score"], F.lit(0.0))
    return scored.withColumns(out).drop(ppm)


def _parts(array: pa.Array, most: int = 1_000_000) -> Iterator[pa.Array]:
    """Runs of texts of about ``most`` bytes in all, or one longer text."""
    ends = np.frombuffer(array.buffers()[1], dtype=np.int32)[array.offset + 1 : array.offset + len(array) + 1].astype(np.int64)
    start = 0
    while start < len(array):
        limit = (ends[start - 1] if start else int(np.frombuffer(array.buffers()[1], dtype=np.int32)[array.offset])) + most
        stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
        yield array.slice(start, stop - start)
        start = stop
