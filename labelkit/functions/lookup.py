"""Tokens of whole Arrow batches of texts, and an open-addressed table of tokens in flat arrays.

Everything is numpy over the bytes of a batch: no Python object per token.  The table is a
few arrays, so a task gets it as a plain copy of memory, and it holds the bytes of its
tokens: a hit is a hit of the token, not of its hash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the bytes that separate tokens.
SEPARATORS = b" \t\n\r\f"
#: Bytes of text that are handled at once, or one longer text.
SLICE_BYTES = 1 << 20
#: Distinct (group, token) pairs that a task counts before it sends them on.
HELD_TOKENS = 300_000

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_IS_TOKEN = np.ones(256, dtype=bool)
_IS_TOKEN[list(SEPARATORS)] = False
_BLANKS = bytes(32 if b in SEPARATORS else b for b in range(256))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes each, or of a single longer value."""
    return runs(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64), most)


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose ``sizes`` sum to at most ``most``, or of a single larger one."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        limit = (ends[start - 1] if start else 0) + most
        stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
        yield start, stop
        start = stop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


@dataclass(frozen=True)
class Words:
    """Tokens of some texts: bytes, the place and length of each token, and tokens per text."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(texts: Sequence[bytes | None], limit: int | None = None) -> Words:
        """All tokens, or the first ``limit`` of each text; None has none."""
        data = np.frombuffer(b" ".join([*(t or b"" for t in texts), b""]), dtype=np.uint8)
        inside = _IS_TOKEN[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        borders = np.concatenate([[0], np.cumsum([len(t or b"") + 1 for t in texts])])
        counts = np.diff(np.searchsorted(starts, borders))
        if limit is not None and len(counts) and counts.max() > limit:
            first = np.cumsum(counts) - counts
            counts = np.minimum(counts, limit)
            kept = ragged(first, counts)
            starts, ends = starts[kept], ends[kept]
        return Words(data, starts, ends - starts, counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit polynomial of the bytes of each token, by differences of prefix sums."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        ends = self.starts + self.lengths
        done = 0
        while done < len(out):
            origin = self.starts[done]
            stop = max(done + 1, int(np.searchsorted(ends, origin + SLICE_BYTES, side="right")))
            part = self.data[origin : ends[stop - 1]].astype(np.uint64) + np.uint64(1)
            up, down = _powers(_ODD, len(part)), _powers(_INVERSE, len(part))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(part * up)])
            at = self.starts[done:stop] - origin
            mixed = (sums[at + self.lengths[done:stop]] - sums[at]) * down[at]
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(_ODD)
            out[done:stop] = mixed ^ (mixed >> np.uint64(29))
            done = stop
        return out

    def token(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes()

    def tokens(self, at: np.ndarray) -> pa.Array:
        """The tokens at these places as strings."""
        offsets = np.concatenate([[0], np.cumsum(self.lengths[at])]).astype(np.int64)
        data = pa.py_buffer(self.data[ragged(self.starts[at], self.lengths[at])].tobytes())
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), data]).cast(pa.string())


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """Powers 0 .. n - 1 modulo 2 ** 64; those for a slice are kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        known = np.cumprod(steps)
        if n <= SLICE_BYTES:
            _POWERS[base] = known
    return known[:n]


class TokenTable:
    """Places of distinct tokens in the order in which they were given."""

    def __init__(self, tokens: pa.Array):
        """``tokens`` are distinct strings without separators, none of them NULL or empty."""
        tokens = tokens.cast(pa.large_binary())
        n = len(tokens)
        self.offsets = np.frombuffer(tokens.buffers()[1], dtype=np.int64)[tokens.offset : tokens.offset + n + 1] if n else np.zeros(1, dtype=np.int64)
        first, last = int(self.offsets[0]), int(self.offsets[-1])
        self.blob = np.frombuffer(tokens.buffers()[2], dtype=np.uint8)[first:last].copy() if n and last > first else np.zeros(0, dtype=np.uint8)
        self.offsets = self.offsets - first
        own = Words(self.blob, self.offsets[:-1], np.diff(self.offsets), np.array([n]))
        self.hashes = own.hashes()
        size = 1 << max(4, (2 * n).bit_length())
        self.mask = np.uint64(size - 1)
        self.slots = np.full(size, -1, dtype=np.int32)
        pending = np.arange(n, dtype=np.int32)
        place = self._home(self.hashes)
        while len(pending):
            at = place[pending]
            free = self.slots[at] < 0
            self.slots[at[free]] = pending[free]
            pending = pending[self.slots[at] != pending]
            place[pending] = (place[pending] + 1) & int(self.mask)

    def __len__(self) -> int:
        return len(self.hashes)

    def _home(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & self.mask).astype(np.int64)

    def find(self, words: Words) -> np.ndarray:
        """The place of each token, -1 for a token that the table does not hold."""
        hashes = words.hashes()
        out = np.full(len(hashes), -1, dtype=np.int32)
        pending = np.arange(len(hashes))
        place = self._home(hashes)
        while len(pending):
            entry = self.slots[place]
            there = entry >= 0
            pending, place, entry = pending[there], place[there], entry[there]
            same = np.flatnonzero(self.hashes[entry] == hashes[pending])
            same = same[self._equal(words, pending[same], entry[same])]
            out[pending[same]] = entry[same]
            open_ = np.ones(len(pending), dtype=bool)
            open_[same] = False
            pending, place = pending[open_], (place[open_] + 1) & int(self.mask)
        return out

    def _equal(self, words: Words, at: np.ndarray, entry: np.ndarray) -> np.ndarray:
        lengths = words.lengths[at]
        equal = lengths == self.offsets[entry + 1] - self.offsets[entry]
        kept = np.flatnonzero(equal)
        lengths = lengths[kept]
        other = words.data[ragged(words.starts[at[kept]], lengths)] != self.blob[ragged(self.offsets[entry[kept]], lengths)]
        wrong = np.concatenate([[0], np.cumsum(other)])
        ends = np.cumsum(lengths)
        equal[kept] = wrong[ends] == wrong[ends - lengths]
        return equal

    def joined(self, entries: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of ``counts`` tokens each, the tokens of a text joined by blanks."""
        starts = self.offsets[entries]
        return joined(self.blob, starts, self.offsets[entries + 1] - starts, counts)


def joined(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Texts of ``counts`` tokens each, which stand in ``data``, the tokens of a text joined by blanks."""
    ends = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(int(ends[-1]), ord(" "), dtype=np.uint8)
    out[ragged(ends[:-1], lengths)] = data[ragged(starts, lengths)]
    borders = ends[np.concatenate([[0], np.cumsum(counts)])]
    drop = borders[1:][counts > 0] - 1  # the blank behind the last token of a text
    sizes = np.diff(borders) - (counts > 0)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    data = pa.py_buffer(np.delete(out, drop).tobytes())
    return pa.Array.from_buffers(pa.large_string(), len(counts), [None, pa.py_buffer(offsets), data]).cast(pa.string())


def count_tokens(df: DataFrame, text: str, groups: Sequence[str] = ()) -> DataFrame:
    """``(*groups, token, count)`` of all tokens of the whole texts, lower-cased.

    Tasks count in a table of bounded size and send its rows on when it is full, so what is
    shuffled are distinct tokens.  NULL texts have no tokens; NULL is a group of its own.
    """
    groups = list(groups)
    rows = df.select(*groups, F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_text"))
    schema = T.StructType([rows.schema[c] for c in groups]).add("token", "string").add("count", "long")
    kinds = [rows.schema[c].dataType for c in groups]

    def sent(held: dict[tuple, Counter]) -> pa.RecordBatch:
        sizes = [len(c) for c in held.values()]
        names = [[name[i] for name, n in zip(held, sizes) for _ in range(n)] for i in range(len(groups))]
        tokens = pa.array([t for c in held.values() for t in c], type=pa.binary()).cast(pa.string())
        counts = pa.array([n for c in held.values() for n in c.values()], type=pa.int64())
        return pa.RecordBatch.from_arrays(
            [*[pa.array(x, type=_arrow(kind)) for x, kind in zip(names, kinds)], tokens, counts], names=[*groups, "token", "count"]
        )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Counter] = {}
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary())
            named = list(zip(*[batch.column(c).to_pylist() for c in groups])) if groups else None
            for start, stop in slices(texts):
                for i, value in enumerate(texts.slice(start, stop - start).to_pylist(), start):
                    found = value.translate(_BLANKS).split(b" ")
                    held.setdefault(named[i] if groups else (), Counter()).update(found)
                for counter in held.values():
                    counter.pop(b"", None)
                if sum(map(len, held.values())) > HELD_TOKENS:
                    yield sent(held)
                    held = {}
        if held:
            yield sent(held)

    partial = rows.mapInArrow(count, schema)
    return partial.groupBy(*groups, "token").agg(F.sum("count").alias("count"))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
