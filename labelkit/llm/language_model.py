"""Language-model scores: causal self-attention over subword classes, mixed with word counts.

Subword ids are dealt by frequency to clusters of equal size; the rarest share the last
place of a cluster and have their frequency there.  One attention layer, trained in numpy,
predicts the cluster of the next subword from a window of those before it, and then the
place within that cluster.  Training texts are encoded once, their subwords written and
counted over all of them.  The layer is
begun on a sample; then each partition goes on from there over all windows of its training
texts, and the weights that the partitions arrive at are averaged.  A text is cut into windows that
overlap by half, so each subword is scored once, with at least half a window before it where
the text has that much.  The subwords of a word give its probability, which is mixed with
the word's share among all training words, counted over the whole corpus.

Words frequent enough to be few by arithmetic go to every task.  All others are counted and
met by shuffles on a 64-bit hash of the word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import WordCache, ragged, slices
from labelkit.llm.packing import word_cache
from labelkit.llm.shingles import word_hashes
from labelkit.session import stage_table

CLUSTERS, PLACES = 64, 32
NONE = CLUSTERS * PLACES  # what stands before a text
WIDTH, WINDOW = 16, 32
HALF = WINDOW // 2
END = np.uint64(0xE0D)  # stands for the end of a text among the hashes of words
#: Words with at least this share of all training words go to every task: 400,000 at most.
FREQUENT = 1 / 400_000
#: Words of a segment of a training text, and weights in a row of the sums of all partitions.
SEGMENT, CHUNK = 2000, 2048
LN10 = float(np.log(10))


def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, A-Z as a-z, and their number by text."""
    words = [(t or "").encode().lower().split() for t in texts.to_pylist()]
    return pa.array(chain.from_iterable(words), pa.binary()).dictionary_encode(), np.fromiter(map(len, words), np.int64, len(words))


def _with_ends(values: np.ndarray, counts: np.ndarray, end) -> np.ndarray:
    """``values`` with ``end`` after the values of each text."""
    stop = np.cumsum(counts + 1)
    out = np.full(len(values) + len(counts), end, dtype=values.dtype)
    out[ragged(stop - counts - 1, counts)] = values
    return out


def subwords(cache: WordCache, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subword ids of all texts with an end each; their number by word, and by text."""
    coded, counts = _words(texts)
    places = cache.places([w.decode() for w in coded.dictionary.to_pylist()])
    ids, per_word = cache.ids_at(places[np.asarray(coded.indices, dtype=np.int64)])
    per_word = _with_ends(per_word, counts, 1)
    stops = np.cumsum(counts + 1)
    edges = np.concatenate([[0], np.cumsum(per_word)])[np.concatenate([[0], stops])]
    per_text = np.diff(edges)
    return _with_ends(ids, per_text - 1, end_id), per_word, per_text


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``(word, count)`` over all rows: hashes of words, and ``END`` once per text."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            hashes, _ = word_hashes(batch.column(text))
            words, counts = np.unique(np.append(hashes, np.full(batch.num_rows, END)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "count"])

    rows = docs.select(text).mapInArrow(count, "word long, count long")
    return rows.groupBy("word").agg(F.sum("count").alias("count"))


@dataclass
class Attention:
    """Weights of the layer, the slot (cluster and place) of each subword id and its log share of the slot."""

    weights: dict[str, np.ndarray]
    slot_of: np.ndarray
    within: np.ndarray
    share: float = 0.5  # of the attention model in the mixture

    def windows(self, slots: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and targets: ``NONE`` begins a text and fills what lies before it; -1 is no target."""
        blocks = -(-per_text // HALF)
        length = blocks * HALF + HALF
        begin = np.cumsum(length) - length
        line = np.full(int(length.sum()), NONE, dtype=np.int16)
        target = np.full(int(length.sum()), -1, dtype=np.int16)
        spots = ragged(begin + HALF, per_text)
        target[spots] = slots
        # an input is the subword before its target
        later = np.ones(len(slots), dtype=bool)
        later[(np.cumsum(per_text) - per_text)[per_text > 0]] = False
        line[spots[later]] = slots[:-1][later[1:]] if len(slots) > 1 else slots[:0]
        first = ragged(begin // HALF, blocks)
        line, target = line.reshape(-1, HALF), target.reshape(-1, HALF)
        return np.concatenate([line[first], line[first + 1]], axis=1), target[first + 1]

    def forward(self, inputs: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """All products of a weight are one matrix product over the rows of all windows."""
        n = len(inputs)
        x = w["embed"].take(inputs.ravel(), axis=0).reshape(n, WINDOW, WIDTH)
        x += w["place"]
        late, flat = x[:, HALF:].reshape(-1, WIDTH), x.reshape(-1, WIDTH)
        q = (late @ (w["q"] * SCALE)).reshape(n, HALF, WIDTH)
        k, v = ((flat @ w[name]).reshape(n, WINDOW, WIDTH) for name in "kv")
        attend = q @ k.transpose(0, 2, 1)
        np.exp(_lower(attend, SEEN), out=attend)
        attend *= SEEN
        attend /= (attend.reshape(-1, WINDOW) @ np.ones(WINDOW, dtype=np.float32)).reshape(n, HALF, 1)
        mixed = attend @ v
        hidden = late + mixed.reshape(-1, WIDTH) @ w["o"]
        return {"x": flat, "late": late, "q": q, "k": k, "v": v, "attend": attend, "mixed": mixed, "hidden": hidden}

    def log_probs(self, ids: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each id, all texts in batches of windows."""
        inputs, targets = self.windows(self.slot_of[ids], per_text)
        out = np.empty(len(ids), dtype=np.float64)
        done = 0
        for lo in range(0, len(inputs), TOGETHER):
            goal = targets[lo : lo + TOGETHER].ravel()
            used = np.flatnonzero(goal >= 0)
            hidden = self.forward(inputs[lo : lo + TOGETHER], self.weights)["hidden"]
            out[done : done + len(used)] = self._slot_log_probs(hidden, used, goal[used])
            done += len(used)
        return out + self.within[ids]

    def _slot_log_probs(self, hidden: np.ndarray, used: np.ndarray, slots: np.ndarray) -> np.ndarray:
        w = self.weights
        order, cluster, place, edges = _by_cluster(slots)
        hidden = hidden.take(used[order], axis=0)
        found = _log_softmax_at(hidden @ w["out"] + w["bias"], cluster) + _log_softmax_at(_places(hidden, w, cluster, edges), place)
        out = np.empty(len(slots), dtype=np.float32)
        out[order] = found
        return out


def _by_cluster(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order with the rows of a cluster together, so that each needs the places of its own cluster only."""
    order = np.argsort(slots // PLACES, kind="stable")
    slots = slots[order].astype(np.int64)
    cluster = slots // PLACES
    return order, cluster, slots % PLACES, np.searchsorted(cluster, np.arange(CLUSTERS + 1))


def _places(hidden: np.ndarray, w: dict[str, np.ndarray], cluster: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Logits of the places of each row's own cluster; the rows of a cluster lie together."""
    logits = w["inner_bias"].take(cluster, axis=0)
    for c in np.flatnonzero(np.diff(edges)):
        rows = slice(edges[c], edges[c + 1])
        logits[rows] += hidden[rows] @ w["inner"][c]
    return logits


def _lower(x: np.ndarray, seen: np.ndarray | bool = True) -> np.ndarray:
    """Takes the greatest ``seen`` number off each row of ``x`` if an exponential could overflow or a sum be lost."""
    if x.size and not (x.min() > -LARGE and x.max() < LARGE):
        x -= np.where(seen, x, -np.inf).max(axis=-1, keepdims=True)
        np.minimum(x, 0, out=x)  # where not seen
    return x


def _exp(x: np.ndarray) -> np.ndarray:
    """``x`` becomes its exponential; returns the sums of rows."""
    np.exp(x, out=x)
    return x @ np.ones(x.shape[-1], dtype=x.dtype)


def _log_softmax_at(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    picked = _lower(logits)[np.arange(len(at)), at]
    return picked - np.log(_exp(logits))


SEEN = np.arange(WINDOW)[None, :] <= np.arange(HALF, WINDOW)[:, None]
#: Exponentials of numbers up to this size, and sums of some of them, are ordinary 32-bit numbers.
LARGE = 80
SCALE = np.float32(1 / np.sqrt(WIDTH))
#: Windows that are scored at once, which bounds memory.
TOGETHER = 1024


class Adam:
    """Steps on the weights of a model, which are changed in place."""

    def __init__(self, model: Attention):
        self.model, self.step = model, 0
        self.m, self.v2 = ({k: np.zeros_like(x) for k, x in model.weights.items()} for _ in range(2))

    def take(self, inputs: np.ndarray, targets: np.ndarray, rate: float) -> None:
        self.step += 1
        w, m, v2 = self.model.weights, self.m, self.v2
        for name, g in _gradients(self.model, inputs, targets).items():
            m[name] = 0.9 * m[name] + 0.1 * g
            v2[name] = 0.99 * v2[name] + 0.01 * g * g
            w[name] -= (rate * (m[name] / (1 - 0.9**self.step)) / (np.sqrt(v2[name] / (1 - 0.99**self.step)) + 1e-8)).astype(np.float32)


def train(ids: np.ndarray, per_text: np.ndarray, n_ids: int, steps: int = 500, batch: int = 256, seed: int = 5, counts: np.ndarray | None = None) -> Attention:
    """Adam on the windows of the given texts, with the gradient of the one layer written out.

    ``counts`` of all ids give the slots, the shares and the first biases; without them
    those of ``ids`` do.
    """
    rng = np.random.default_rng(seed)
    count = (np.bincount(ids, minlength=n_ids) if counts is None else counts) + 0.1
    rank = np.empty(n_ids, dtype=np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(n_ids)
    slot_of = rank % CLUSTERS * PLACES + np.minimum(rank // CLUSTERS, PLACES - 1)
    mass = np.bincount(slot_of, weights=count, minlength=NONE)
    within = np.log(count / mass[slot_of])
    shapes = {"embed": (NONE + 1, WIDTH), "place": (WINDOW, WIDTH), "out": (WIDTH, CLUSTERS), "inner": (CLUSTERS, WIDTH, PLACES)}
    shapes |= {name: (WIDTH, WIDTH) for name in "qkvo"}
    w = {name: (rng.standard_normal(s) * 0.2).astype(np.float32) for name, s in shapes.items()}
    by_cluster = (mass + 1e-3).reshape(CLUSTERS, PLACES)
    w["bias"] = np.log(by_cluster.sum(axis=1) / by_cluster.sum()).astype(np.float32)
    w["inner_bias"] = np.log(by_cluster / by_cluster.sum(axis=1, keepdims=True)).astype(np.float32)
    model = Attention(w, slot_of, within)
    inputs, targets = model.windows(slot_of[ids], per_text)
    adam = Adam(model)
    for step in range(1, steps + 1 if len(inputs) else 1):
        some = rng.integers(0, len(inputs), batch)
        adam.take(inputs[some], targets[some], 0.02 * (1 - step / (steps + 1)))
    return model


def segments(docs: DataFrame, text: str) -> DataFrame:
    """``(text, last, draw)``: texts in segments of at most ``SEGMENT`` words, with a number from 0 to 1 drawn by a hash."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            parts, doc, piece, last = [], [], [], []
            for k, words in enumerate(t.encode().split() for t in batch.column(text).to_pylist()):
                for lo in range(0, max(1, len(words)), SEGMENT):
                    parts.append(b" ".join(words[lo : lo + SEGMENT]).decode())
                    doc.append(k)
                    piece.append(lo)
                    last.append(lo + SEGMENT >= len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(parts, pa.string()), pa.array(last, pa.bool_())],
                ["doc_id", "piece", "text", "last"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text).mapInArrow(cut, "doc_id long, piece int, text string, last boolean")
    draw = F.pmod(F.xxhash64("doc_id", "piece", "text", F.lit("lm")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.select("text", "last", draw.alias("draw"))


def _training_ids(cache: WordCache, texts: pa.Array, last: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of segments and their number by segment; only the last one of a text has an end."""
    ids, _, per_text = subwords(cache, texts, end_id)
    keep = np.ones(len(ids), dtype=bool)
    keep[(np.cumsum(per_text) - 1)[~last]] = False
    return ids[keep], per_text - ~last


def _width(n_ids: int) -> np.dtype:
    return np.dtype("<u2" if n_ids <= 1 << 16 else "<u4")


def encoded(rows: DataFrame, tokenizer: str, n_ids: int, end_id: int) -> DataFrame:
    """Segments with their subword ``ids``, as little-endian unsigned numbers, for all later passes; tables with ``ids`` stay as they are."""
    if "ids" in rows.columns:
        return rows

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, width = word_cache(tokenizer), _width(n_ids)
        for batch in slices(batches, "text"):
            ids, per_text = _training_ids(cache, batch.column("text"), batch.column("last").to_numpy(zero_copy_only=False), end_id)
            offsets = np.concatenate([[0], np.cumsum(per_text)]) * width.itemsize
            binary = pa.BinaryArray.from_buffers(pa.binary(), len(per_text), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids.astype(width))])
            yield pa.RecordBatch.from_arrays([*batch.columns, binary], [*batch.schema.names, "ids"])

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(encode, f"{schema}, ids binary")


def _ids_of(column: pa.Array, n_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows of ``encoded``, and their number by row."""
    width = _width(n_ids)
    sizes = np.asarray(pc.binary_length(column), dtype=np.int64) // width.itemsize
    return np.frombuffer(b"".join(column.to_pylist()), dtype=width), sizes


def subword_counts(rows: DataFrame, tokenizer: str, n_ids: int, end_id: int) -> np.ndarray:
    """How often each subword id occurs in all segments: a row per id comes to the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, dtype=np.int64)
        for batch in slices(batches, "ids"):
            total += np.bincount(_ids_of(batch.column("ids"), n_ids)[0], minlength=n_ids)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    found = encoded(rows, tokenizer, n_ids, end_id).select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_ids, dtype=np.int64)
    out[found.column("id").to_numpy()] = found.column("n").to_numpy()
    return out


def go_on(rows: DataFrame, model: Attention, tokenizer: str, end_id: int, batch: int = 1024, rate: float = 0.005) -> int:
    """One pass over all windows of ``rows``: partitions go on from ``model``, which gets the mean of their weights.

    A partition counts by its targets, whose number over all partitions is returned.
    """
    shapes = {name: x.shape for name, x in model.weights.items()}
    n_ids = len(model.slot_of)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng, seen = np.random.default_rng(11), 0
        own = Attention({k: x.copy() for k, x in model.weights.items()}, model.slot_of, model.within)
        adam = Adam(own)
        for part in slices(batches, "ids", 1_500_000):
            ids, per_text = _ids_of(part.column("ids"), n_ids)
            inputs, targets = own.windows(own.slot_of[ids], per_text)
            order = rng.permutation(len(inputs))
            for lo in range(0, len(order), batch):
                some = order[lo : lo + batch]
                adam.take(inputs[some], targets[some], rate * len(some) / batch)
            seen += len(ids)
        if seen:
            flat = np.concatenate([own.weights[name].ravel() for name in shapes]).astype(np.float64) * seen
            chunks = [flat[lo : lo + CHUNK] for lo in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks))), pa.array([seen] * len(chunks)), pa.array([c.tobytes() for c in chunks], pa.binary())], ["chunk", "n", "sums"])

    def add(table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(x.as_py()) for x in table.column("sums"))
        return pa.table({"chunk": table.column("chunk")[:1], "n": [sum(table.column("n").to_pylist())], "sums": pa.array([sums.tobytes()], pa.binary())})

    schema = "chunk long, n long, sums binary"
    found = sorted(encoded(rows, tokenizer, n_ids, end_id).select("ids").mapInArrow(run, schema).groupBy("chunk").applyInArrow(add, schema).collect())
    if not found:
        return 0
    flat, at = np.concatenate([np.frombuffer(r["sums"]) for r in found]) / found[0]["n"], 0
    for name, shape in shapes.items():
        size = int(np.prod(shape))
        model.weights[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return found[0]["n"]


def _softmax_error(logits: np.ndarray, goal: np.ndarray, n: int) -> np.ndarray:
    """What ``logits`` become: the softmax less 1 at ``goal``, over ``n`` targets."""
    logits *= (1 / (_exp(_lower(logits)) * np.float32(n)))[:, None]
    logits[np.arange(len(goal)), goal] -= np.float32(1 / n)
    return logits


def _gradients(model: Attention, inputs: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    w = model.weights
    f = model.forward(inputs, w)
    n, flat = len(inputs), lambda a: a.reshape(-1, a.shape[-1])
    goal = targets.ravel()
    used = np.flatnonzero(goal >= 0)
    order, cluster, place, edges = _by_cluster(goal[used])
    used = used[order]
    hidden = f["hidden"].take(used, axis=0)
    error = _softmax_error(hidden @ w["out"] + w["bias"], cluster, len(used))
    ones = np.ones(len(used), dtype=np.float32)
    out = {"out": hidden.T @ error, "bias": ones @ error}
    d_used = error @ w["out"].T
    out["inner"], out["inner_bias"] = np.zeros_like(w["inner"]), np.zeros_like(w["inner_bias"])
    # an error counts by its share of all targets, like those of the clusters
    inner = _softmax_error(_places(hidden, w, cluster, edges), place, len(used))
    for c in np.flatnonzero(np.diff(edges)):
        rows = slice(edges[c], edges[c + 1])
        out["inner"][c], out["inner_bias"][c] = hidden[rows].T @ inner[rows], ones[rows] @ inner[rows]
        d_used[rows] += inner[rows] @ w["inner"][c].T
    d_hidden = np.zeros((len(goal), WIDTH), dtype=np.float32)
    d_hidden[used] = d_used
    out["o"] = flat(f["mixed"]).T @ d_hidden
    d_mixed = (d_hidden @ w["o"].T).reshape(n, HALF, WIDTH)
    d_scores = d_mixed @ f["v"].transpose(0, 2, 1)
    # the mean of these under the attention is what the mixed vector has of d_mixed
    d_scores -= np.einsum("ijk,ijk->ij", d_mixed, f["mixed"])[..., None]
    d_scores *= f["attend"]
    d_k, d_v = flat(d_scores.transpose(0, 2, 1) @ f["q"]), flat(f["attend"].transpose(0, 2, 1) @ d_mixed)
    d_q = flat(d_scores @ f["k"])
    out |= {"q": f["late"].T @ d_q * SCALE, "k": f["x"].T @ d_k, "v": f["x"].T @ d_v}
    d_x = (d_k @ w["k"].T + d_v @ w["v"].T).reshape(n, WINDOW, WIDTH)
    d_x[:, HALF:] += (d_hidden + d_q @ (w["q"] * SCALE).T).reshape(n, HALF, WIDTH)
    out["place"] = d_x.sum(axis=0)
    at, columns = inputs.ravel().astype(np.int64), flat(d_x).T.astype(np.float64, order="C")
    out["embed"] = np.stack([np.bincount(at, weights=x, minlength=NONE + 1) for x in columns], axis=1).astype(np.float32)
    return out


@dataclass
class Scorer:
    """The attention model with the frequent words, sorted by hash, and the totals of all words."""

    attention: Attention
    words: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int

    def count_of(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of frequent words, 0 for all others."""
        if not len(self.words):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.counts[at], 0)

    def attention_scores(self, ids: np.ndarray, per_word: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's probability by its subwords."""
        sums = np.concatenate([[0.0], np.cumsum(self.attention.log_probs(ids, per_text))])
        stop = np.cumsum(per_word)
        return sums[stop] - sums[stop - per_word]

    def mixed(self, attention: np.ndarray, counts: np.ndarray, share: float) -> np.ndarray:
        """log10 of each word's probability under the mixture."""
        with np.errstate(divide="ignore"):
            counted = np.log((1 - share) * counts / max(1, self.total))
        return np.logaddexp(attention + np.log(share), counted) / LN10


def fit(docs: DataFrame, counts: DataFrame, tokenizer: str, n_ids: int, end_id: int, sample_chars: int = 2_000_000, text: str = "text") -> Scorer:
    """Counts subwords and trains over all segments of the training texts but a few.

    The weights begin on segments of about ``sample_chars`` code points.  ``counts`` are of
    all training texts.  The share of the attention model is the best of a few on about an
    eighth as many code points, which its training leaves out, with counts less their own words.
    """
    sums = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"]
    often = counts.filter(F.col("count") >= max(1, int(total * FREQUENT))).toArrow()
    order = np.argsort(often.column("word").to_numpy().view(np.uint64))
    words, times = (often.column(c).to_numpy()[order] for c in ("word", "count"))
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 1
    aside = min(1 / 8, sample_chars / 8 / chars)
    # written, so that texts are encoded once; they themselves are needed of the segments left out
    rows = encoded(segments(docs, text), tokenizer, n_ids, end_id)
    rows = stage_table(rows.withColumn("text", F.when(F.col("draw") < aside, F.col("text"))), "lm-segments")
    learnt = rows.filter(F.col("draw") >= aside)
    times_of = subword_counts(learnt, tokenizer, n_ids, end_id)
    sample = learnt.filter(F.col("draw") < aside + sample_chars / chars).select("ids").toArrow().column("ids")
    ids, per_text = _ids_of(sample, n_ids)
    attention = train(ids, per_text, n_ids, counts=times_of)
    go_on(learnt, attention, tokenizer, end_id)
    scorer = Scorer(attention, words.view(np.uint64), times, total, distinct)
    left_out = rows.filter(F.col("draw") < aside).select("text", "last").toArrow()
    texts, last = pa.chunked_array(left_out.column("text").chunks, pa.string()).combine_chunks(), np.array(left_out.column("last").to_pylist(), dtype=bool)
    if len(texts):
        cache = word_cache(tokenizer)
        hashes, n_words = word_hashes(texts)
        ids, per_word, per_text = subwords(cache, texts, end_id)
        scores = scorer.attention_scores(ids, per_word, per_text)
        hashes = _with_ends(hashes, n_words, END)
        used = np.ones(len(hashes), dtype=bool)
        used[(np.cumsum(n_words + 1) - 1)[~last]] = False  # only texts end, not all segments
        hashes, scores = hashes[used], scores[used]
        own, back, own_times = np.unique(hashes, return_inverse=True, return_counts=True)
        spark = docs.sparkSession
        met = counts.join(F.broadcast(spark.createDataFrame(pa.table({"word": own.view(np.int64)}))), "word").toArrow()
        rest = dict(zip(met.column("word").to_pylist(), met.column("count").to_pylist()))
        left = np.maximum(np.array([rest.get(w, 0) for w in own.view(np.int64).tolist()]) - own_times, 0)
        kept = Scorer(attention, scorer.words, scorer.counts, max(1, total - len(hashes)), distinct)
        attention.share = max((0.05, 0.1, 0.2, 0.3, 0.5, 0.7), key=lambda s: kept.mixed(scores, left[back], s).sum())
    return scorer


def score(docs: DataFrame, training: Column, tokenizer: str, n_ids: int = 49_408, end_id: int = 1, text: str = "text") -> DataFrame:
    """Per row: ``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``.

    Learns from the rows for which ``training`` holds.  A null text is empty: its only token
    is the end.  ``base_score`` is the add-0.1 unigram log10 probability, exact for every
    word.  Repeated rows are scored, and counted, as often as they occur.  Without training
    rows every word is unknown.
    """
    docs = docs.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    counts = stage_table(word_counts(docs.filter(training), text), "word-counts")
    scorer = fit(docs.filter(training), counts, tokenizer, n_ids, end_id, text=text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(tokenizer)
        for batch in slices(batches, text, 1_500_000):
            texts = batch.column(text)
            hashes, n_words = word_hashes(texts)
            hashes = _with_ends(hashes, n_words, END)
            ids, per_word, per_text = subwords(cache, texts, end_id)
            first = np.cumsum(n_words + 1) - n_words - 1
            attention = scorer.attention_scores(ids, per_word, per_text)
            c = scorer.count_of(hashes)
            words = scorer.mixed(attention, c, scorer.attention.share)
            often = np.log10((c + 0.1) / (scorer.total + 0.1 * (scorer.distinct + 1)))
            rare = c == 0
            rare_by_text = np.add.reduceat(rare.astype(np.int64), first)
            offsets = np.concatenate([[0], np.cumsum(rare_by_text)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words + 1),
                    pa.array(n_words + 1 - rare_by_text),
                    pa.array(np.add.reduceat(often, first)),
                    pa.array(np.add.reduceat(words, first)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[rare].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(attention[rare].astype(np.float32))),
                ],
                ["doc_id", "n_tokens", "n_often", "base", "score", "rare", "ln_p"],
            )

    schema = "doc_id long, n_tokens long, n_often long, base double, score double, rare array<long>, ln_p array<float>"
    rows = docs.select(F.col("doc_id").cast("long"), text).mapInArrow(run, schema).withColumn("row_id", F.monotonically_increasing_id())
    rows = stage_table(rows, "lm-rows")
    met = rows.select("row_id", F.inline(F.arrays_zip("rare", "ln_p"))).withColumnRenamed("rare", "word")
    # none of these words is hot: hot ones are among the frequent words
    rest = counts.filter(F.col("count") < max(1, int(scorer.total * FREQUENT)))
    gain = F.log10((F.col("count") + 0.1) / 0.1)
    # what the word's own share adds to the share of the attention model
    share = scorer.attention.share
    counted = F.col("count") * ((1 - share) / share / max(1, scorer.total))
    more = F.log10(1 + counted * F.exp(F.least(-F.col("ln_p"), F.lit(600.0))))
    found = met.join(rest, "word").groupBy("row_id").agg(F.count(F.lit(1)).alias("n"), F.sum(gain).alias("gain"), F.sum(more).alias("more"))
    return rows.join(found, "row_id", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_often") + F.coalesce("n", F.lit(0))).alias("n_known"),
        F.lit(scorer.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
