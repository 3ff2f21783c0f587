"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

A text becomes a space and itself, each space the marker U+2581; its pieces are those of
the greatest sum of log scores.  Characters without a piece cost the lowest score and a
penalty, and become their UTF-8 bytes.  Where no piece runs from a character into a marker
or across a line end, the best path of a text is that of its words one after the other, so
each word is solved once and words of a batch are solved together, in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.llm.common import WordCache, ragged, slices

MARK = "▁"
UNKNOWN_PENALTY = 10.0
UNIT = re.compile(r" *[^ \n]+| +|\n")
BATCHED_BYTES = 64  # longer words are solved one by one


@dataclass
class DoubleArray:
    """A trie over bytes: child c of node s is ``base[s] + c`` if its ``check`` is s; ``value`` is -1 inside."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, keys: list[bytes], values: list[int]) -> DoubleArray:
        order = sorted(range(len(keys)), key=lambda i: keys[i])
        keys, values = [keys[i] for i in order], [values[i] for i in order]
        size = 1 << 10
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        check[0] = 0
        free = 1
        todo = [(0, 0, len(keys), 0)]  # node, keys from-to, depth
        while todo:
            node, lo, hi, depth = todo.pop()
            if lo < hi and len(keys[lo]) == depth:
                value[node] = values[lo]
                lo += 1
            if lo >= hi:
                continue
            starts, codes = [lo], [keys[lo][depth]]
            for i in range(lo + 1, hi):
                if keys[i][depth] != codes[-1]:
                    starts.append(i)
                    codes.append(keys[i][depth])
            shift = np.array(codes) - codes[0]
            while free < size and check[free] >= 0:
                free += 1
            begin, at = max(free, codes[0] + 1), -1
            while at < 0:
                while begin + 4096 + 512 >= size:
                    size *= 2
                    base, check, value = np.append(base, base * 0), np.append(check, check * 0 - 1), np.append(value, value * 0 - 1)
                spots = begin + np.flatnonzero(check[begin : begin + 4096] < 0)
                fits = (check[spots[:, None] + shift] < 0).all(axis=1)
                if fits.any():
                    at = int(spots[np.argmax(fits)]) - codes[0]
                begin += 4096
            codes_ = np.array(codes)
            base[node] = at
            check[at + codes_] = node
            for code, a, b in zip(codes, starts, [*starts[1:], hi]):
                todo.append((at + code, a, b, depth + 1))
        return cls(base, check, value)


@dataclass
class PieceModel:
    """Pieces with log scores, the ids of the 256 bytes, and the trie of what texts can match."""

    trie: DoubleArray
    score: np.ndarray
    content: list[bytes]
    byte_ids: np.ndarray

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece

        file = sentencepiece.SentencePieceProcessor(model_file=path)
        n = file.get_piece_size()
        byte_ids = np.full(256, -1, dtype=np.int32)
        content, keys, values = [], [], []
        for i in range(n):
            piece = file.id_to_piece(i)
            if file.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                content.append(bytes([int(piece[3:5], 16)]))
            elif file.is_control(i) or file.is_unknown(i) or file.is_unused(i):
                content.append(b"")
            else:
                inner = piece.lstrip(MARK)
                if MARK in inner or "\n" in piece:
                    raise ValueError("words of this model cannot be encoded one by one")
                content.append(piece.replace(MARK, " ").encode())
                keys.append(piece.encode())
                values.append(i)
        if (byte_ids < 0).any():
            raise ValueError("the model has no byte fallback")
        return cls(DoubleArray.build(keys, values), np.array([file.get_score(i) for i in range(n)]), content, byte_ids)

    @cached_property
    def unknown(self) -> float:
        used = self.trie.value[self.trie.value >= 0]
        return float(self.score[used].min()) - UNKNOWN_PENALTY

    @cached_property
    def bytes_of(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all pieces on end, and start and length of each piece."""
        length = np.array([len(c) for c in self.content], dtype=np.int64)
        return np.frombuffer(b"".join(self.content), dtype=np.uint8), np.cumsum(length) - length, length

    def encode_words(self, words: list[str]) -> list[list[int]]:
        data = [w.replace(" ", MARK).encode() for w in words]
        out: list[list[int]] = [[] for _ in data]
        size = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        order = np.argsort(size, kind="stable")
        order = order[size[order] > 0]
        short = order[size[order] <= BATCHED_BYTES]
        for lo in range(0, len(short), 8192):
            part = short[lo : lo + 8192]
            for k, ids in zip(part.tolist(), self._solve([data[i] for i in part])):
                out[k] = ids
        for k in order[size[order] > BATCHED_BYTES].tolist():
            out[k] = self._solve_one(data[k])
        return out

    def _solve(self, words: list[bytes]) -> list[list[int]]:
        n, size = len(words), np.array([len(w) for w in words])
        width = int(size.max())
        flat = np.zeros((n, width + 1), dtype=np.int64)
        flat[np.repeat(np.arange(n), size), ragged(np.zeros(n, np.int64), size)] = np.frombuffer(b"".join(words), dtype=np.uint8)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        came = np.zeros((n, width + 1), dtype=np.int32)
        piece = np.full((n, width + 1), -1, dtype=np.int32)
        lead = (flat & 0xC0) != 0x80
        step = np.where(flat < 0x80, 1, np.where(flat < 0xE0, 2, np.where(flat < 0xF0, 3, 4)))
        for s in range(width):
            row = np.flatnonzero((s < size) & lead[:, s])
            node = np.zeros(len(row), dtype=np.int64)
            single = np.zeros(n, dtype=bool)
            here = row
            for d in range(s, width):
                child = self.trie.base[node] + flat[here, d]
                fits = (d < size[here]) & (self.trie.check[child] == node)
                here, node = here[fits], child[fits]
                if not len(here):
                    break
                found = self.trie.value[node]
                hit = found >= 0
                r, ids = here[hit], found[hit]
                self._offer(best, came, piece, r, s, d + 1, best[r, s] + self.score[ids], ids)
                single[r] |= d + 1 - s == step[r, s]
            rest = row[~single[row]]
            ends = s + step[rest, s]
            for end in np.unique(ends):
                r = rest[ends == end]
                self._offer(best, came, piece, r, s, int(end), best[r, s] + self.unknown, np.full(len(r), -1, np.int32))
        back: list[list[int]] = [[] for _ in range(n)]
        at = size.copy()
        live = np.arange(n)
        while len(live):
            start, ids = came[live, at[live]], piece[live, at[live]]
            for k, a, b, i in zip(live.tolist(), start.tolist(), at[live].tolist(), ids.tolist()):
                if i >= 0:
                    back[k].append(i)
                else:
                    back[k].extend(self.byte_ids[list(words[k][a:b])][::-1].tolist())
            at[live] = start
            live = live[start > 0]
        return [ids[::-1] for ids in back]

    @staticmethod
    def _offer(best, came, piece, rows, start, end, score, ids) -> None:
        # of equal paths the one found first stays
        better = score > best[rows, end]
        rows = rows[better]
        best[rows, end], came[rows, end], piece[rows, end] = score[better], start, ids[better]

    @property
    def _plain(self) -> tuple[memoryview, memoryview, memoryview, memoryview]:
        """The arrays for single reads, without copies of them."""
        return tuple(memoryview(np.ascontiguousarray(x)) for x in (self.trie.base, self.trie.check, self.trie.value, self.score))

    def _solve_one(self, word: bytes) -> list[int]:
        base, check, value, scores = self._plain
        n = len(word)
        best, came, piece = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for s in range(n):
            c = word[s]
            if c & 0xC0 == 0x80:
                continue
            step = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
            node, single = 0, False
            for d in range(s, n):
                child = base[node] + word[d]
                if check[child] != node:
                    break
                node = child
                i = value[node]
                if i >= 0:
                    single |= d + 1 - s == step
                    if best[s] + scores[i] > best[d + 1]:
                        best[d + 1], came[d + 1], piece[d + 1] = best[s] + scores[i], s, i
            if not single and best[s] + self.unknown > best[s + step]:
                best[s + step], came[s + step], piece[s + step] = best[s] + self.unknown, s, -1
        out: list[int] = []
        at = n
        while at:
            out.extend([piece[at]] if piece[at] >= 0 else self.byte_ids[list(word[came[at] : at])][::-1].tolist())
            at = came[at]
        return out[::-1]


#: Words in the cache of a Python worker, about 250 bytes each.
CACHED_WORDS = 400_000
#: Characters that are encoded at once, or one longer text.
SLICE_CHARS = 500_000

_caches: dict[int, WordCache] = {}


def _cache(model: PieceModel) -> WordCache:
    """One cache for all tasks of a Python worker that use the same pieces."""
    name = hash((len(model.content), model.score.tobytes()))
    if name not in _caches:
        _caches.clear()
        _caches[name] = WordCache(model.encode_words, CACHED_WORDS)
    return _caches[name]


def _ids(model: PieceModel, texts: pa.Array) -> pa.Array:
    cache = _cache(model)
    units, counts = [], []
    for value in texts.to_pylist():
        own = UNIT.findall(" " + value) if value else []
        units += own
        counts.append(len(own))
    ids, lengths = cache.ids(units)
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def _texts(model: PieceModel, lists: pa.Array) -> pa.Array:
    data, start, length = model.bytes_of
    out = []
    for value in lists:
        if not value.is_valid:
            out.append(None)
            continue
        own = np.asarray(value.values)
        text = data[ragged(start[own], length[own])].tobytes().decode("utf-8", "replace")
        out.append(text[1:] if text.startswith(" ") else text)
    return pa.array(out, pa.string())


def _sliced(texts: pa.Array, run: Callable[[pa.Array], pa.Array], kind: pa.DataType) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = [run(part.column("text")) for part in slices([batch], "text", SLICE_CHARS)]
    return pa.concat_arrays(parts) if parts else pa.nulls(0, kind)


def encode(model: PieceModel, text: Column) -> Column:
    """The ids of each text as an array; a null or empty text has none.

    A task encodes about ``SLICE_CHARS`` characters at once; a longer text needs memory for
    itself, its words and its ids.
    """

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            yield _sliced(array, lambda part: _ids(model, part), pa.list_(pa.int32()))

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, T.ArrayType(T.IntegerType()))(text)


def decode(model: PieceModel, ids: Column) -> Column:
    """The text of each array of ids: bytes are joined, markers become spaces, the first space goes.

    Ids of control pieces give nothing; bytes that are not UTF-8 become U+FFFD; null stays
    null.  A text of any length is put together from its ids in one piece.
    """

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            yield _texts(model, array)

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, T.StringType())(ids)


def recode(model: PieceModel, docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``(*keep, ids, same)``: the ids of each text, and whether they decode to the text again.

    Encoding and decoding share one worker, one model and one cache.  A null text has no
    ids and decodes to an empty one, which is not the same.  What a task gives back at once
    is as large as ``SLICE_CHARS`` characters or one longer text.
    """
    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType(rows.schema.fields[:-1]).add("ids", T.ArrayType(T.IntegerType())).add("same", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", SLICE_CHARS):
            own = part.column("_text")
            ids = _ids(model, own)
            same = pc.fill_null(pc.equal(_texts(model, ids), own), False)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, same], names=schema.names)

    return rows.mapInArrow(run, schema)
