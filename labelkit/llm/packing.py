"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents are encoded row by row; what is shuffled is one narrow row per piece.  Pieces
meet in groups of a bounded number of rows, each packed by best-fit decreasing and then
improved by swaps between its underfull bins.  The few bins that stay underfull are opened
again and packed with those of other groups, in rounds, until one group is left.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import WordCache, encode_column, ragged, slices
from labelkit.session import stage_table

GROUP_PIECES = 20_000
#: Pieces in underfull bins that are searched together.
BLOCK_PIECES = 2_000
#: Words that are encoded as one text.
TOGETHER = 200
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


def _last_of_word(tokenizer) -> np.ndarray | None:
    """Which ids end a word, for a tokenizer that marks them by a suffix; else None."""
    suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix")
    if not suffix:
        return None
    vocabulary = tokenizer.get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    out[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return out


@lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    """The ids that ``tokenizers`` gives; its pre-tokenizer never joins across white space."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def one_by_one(words: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    last = _last_of_word(tokenizer)

    def encode(words: list[str]) -> list[list[int]]:
        """Words of Latin letters together, as one text, cut behind the ids that end a word."""
        if last is None:
            return one_by_one(words)
        plain = [i for i, w in enumerate(words) if w.isalpha() and max(w) < "\u0250"]
        out: dict[int, list[int]] = {}
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            ids = one_by_one([" ".join([words[i] for i in some])])[0]
            ends = (np.flatnonzero(last[np.array(ids, dtype=np.int64)]) + 1).tolist()
            if len(ends) == len(some) and ends[-1] == len(ids):
                out.update(zip(some, (ids[a:b] for a, b in zip([0, *ends], ends))))
        rest = [i for i in range(len(words)) if i not in out]
        out.update(zip(rest, one_by_one([words[i] for i in rest])))
        return [out[i] for i in range(len(words))]

    return WordCache(encode)


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, text: str = "text") -> DataFrame:
    """One row per piece of a document: ``ids`` are little-endian unsigned 32-bit numbers.

    A document is its ids followed by ``end_id``; only longer ones than ``capacity`` are
    cut.  A null text is empty (one piece of one id).  ``tokenizer`` must be a file whose
    pre-tokenizer splits at white space and drops it.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache = word_cache(tokenizer)
        for batch in slices(batches, text):
            ids, counts = encode_column(cache, batch.column(text))
            n = len(counts)
            whole = np.full(len(ids) + n, end_id, dtype="<u4")
            ends = np.cumsum(counts + 1)
            whole[ragged(ends - counts - 1, counts)] = ids
            pieces = -(-(counts + 1) // capacity)
            doc = np.repeat(np.arange(n), pieces)
            number = ragged(np.zeros(n, dtype=np.int64), pieces)
            start = number * capacity
            length = np.minimum(capacity, (counts + 1)[doc] - start)
            offsets = np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(whole)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(number, pa.int32()), pa.array(start), pa.array(length), data],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col(text)).mapInArrow(encode, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has exactly r tokens of room
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(k)
        else:
            room, b = capacity, len(bins)
            bins.append([k])
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


class _Open:
    """The underfull bins of a group: pieces with lengths and bins, room by bin."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.piece = np.array([k for b in bins for k in b], dtype=np.int64)
        self.size = lengths[self.piece]
        self.bin = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        self.fill = np.bincount(self.bin, weights=self.size, minlength=len(bins)).astype(np.int64)
        self.capacity = capacity

    def shift(self, x: np.ndarray, a: int, y: np.ndarray, b: int) -> None:
        """Pieces at ``x`` go from bin a to bin b, those at ``y`` from b to a."""
        gain = int(self.size[x].sum() - self.size[y].sum())
        self.bin[x], self.bin[y] = b, a
        self.fill[b] += gain
        self.fill[a] -= gain

    def improve(self, a: int) -> bool:
        """The best move or exchange that takes tokens from bin ``a`` to a bin as full or fuller.

        A gain of g tokens by bin b raises the squared fill by 2 g (fill_b - fill_a + g).
        """
        own = np.flatnonzero(self.bin == a)
        others = np.flatnonzero((self.bin != a) & (self.fill[self.bin] >= self.fill[a]))
        target = np.flatnonzero(self.fill >= max(self.fill[a], 1))
        target = target[target != a]
        if not len(own) or not len(target):
            return False
        room = self.capacity - self.fill
        best: tuple[int, np.ndarray, np.ndarray, int] = (0, own[:0], own[:0], -1)

        def offer(gains: np.ndarray, bins: np.ndarray, x: np.ndarray, y: np.ndarray | None) -> None:
            nonlocal best
            value = np.where((gains > 0) & (gains <= room[bins]), 2 * gains * (self.fill[bins] - self.fill[a] + gains), 0)
            k = int(np.argmax(value)) if len(value) else 0
            if len(value) and value[k] > best[0]:
                best = (int(value[k]), x, own[:0] if y is None else np.atleast_1d(y[k]), int(bins[k]))

        sizes = self.size[own]
        _, first = np.unique(sizes, return_index=True)
        for i in first:  # one piece moves, or changes places with one piece
            offer(np.full(len(target), sizes[i]), target, own[i : i + 1], None)
            offer(sizes[i] - self.size[others], self.bin[others], own[i : i + 1], others)
        for i in first:  # two pieces change places with one
            for j in first:
                if i < j:
                    offer(sizes[i] + sizes[j] - self.size[others], self.bin[others], own[[i, j]], others)
        order = others[np.lexsort((self.size[others], self.bin[others]))]
        if len(order) > 1:  # neighbours by size within a bin change places with one piece
            pairs = np.stack([order[:-1], order[1:]], axis=1)[self.bin[order[:-1]] == self.bin[order[1:]]]
            both = self.size[pairs].sum(axis=1)
            for i in first:
                offer(sizes[i] - both, self.bin[pairs[:, 0]], own[i : i + 1], pairs)
        if best[3] < 0:
            return False
        self.shift(best[1], a, best[2], best[3])
        return True


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins, emptiest first, as long as one raises the squared fill.

    Underfull bins are searched in blocks of at most ``BLOCK_PIECES`` pieces, emptiest bins
    of all blocks side by side in each.  A block is done when none of its bins can be
    improved or no whole bin of room is left in it; every step raises its sum of squared
    fills, so the search ends.  Bins that become empty vanish.
    """
    fill = np.array([lengths[b].sum() for b in bins], dtype=np.int64)
    out = [b for b, f in zip(bins, fill) if f == capacity]
    under = sorted((i for i, f in enumerate(fill) if f < capacity), key=lambda i: int(fill[i]))
    blocks = -(-sum(len(bins[i]) for i in under) // BLOCK_PIECES)
    for k in range(blocks):
        out += _search_block(_Open([bins[i] for i in under[k::blocks]], lengths, capacity))
    return out


def _search_block(work: _Open) -> list[list[int]]:
    stuck = np.zeros(len(work.fill), dtype=bool)
    moved = False
    while work.capacity * np.count_nonzero(work.fill) - work.fill.sum() >= work.capacity:
        live = np.flatnonzero(~stuck & (work.fill > 0))
        if not len(live):
            if not moved:
                break
            stuck[:], moved = False, False  # what moved since may let them through
            continue
        a = int(live[np.argmin(work.fill[live])])
        stuck[a] = not work.improve(a)
        moved |= not stuck[a]
    order = np.argsort(work.bin, kind="stable")
    parts = np.split(work.piece[order], np.flatnonzero(np.diff(work.bin[order])) + 1) if len(order) else []
    return [p.tolist() for p in parts]


def pack_group(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Bins of one group; rows come back with ``bin`` (within the group), ``offset`` and ``carry``.

    ``carry`` marks the emptiest bins, of at most half of the pieces, that another round
    may fill better.
    """
    group = group.sort_values(["length", "row_id"], ascending=[False, True], ignore_index=True)
    lengths = group["length"].to_numpy(dtype=np.int64)
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    number, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    carry = np.zeros(len(lengths), dtype=bool)
    left = len(lengths) // 2
    fills = [int(lengths[own].sum()) for own in bins]
    for k in np.argsort(fills, kind="stable"):
        own = bins[k]
        ends = np.cumsum(lengths[own])
        number[own], offset[own] = k, ends - lengths[own]
        if fills[k] < capacity - capacity // 64 and len(own) <= left:
            carry[own] = True
            left -= len(own)
        else:
            left = 0
    return pd.DataFrame({"row_id": group["row_id"], "length": lengths, "grp": group["grp"], "bin": number, "offset": offset, "carry": carry})


def pack(pieces: DataFrame, capacity: int = 4096, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (any columns with a ``length`` of 1 to ``capacity``) with ``sequence_id``, ``offset``.

    The emptiest bins of each group, of at most half of its pieces, are opened again and
    packed with those of other groups, until one group is left.  Pieces of full length are sequences of their own.  Repeated rows are packed one by
    one; an empty table gives an empty result.  A group takes ``group_pieces`` rows on
    average, whatever the size of the input.
    """
    kept = stage_table(pieces.withColumn("row_id", F.monotonically_increasing_id()), "pieces")
    short = kept.filter(F.col("length") < capacity).select("row_id", "length")
    left, total, level, packed = short, short.count(), 0, []
    while total:
        groups = -(-total // group_pieces)
        schema = "row_id long, length long, grp long, bin long, offset long, carry boolean"
        binned = stage_table(
            left.withColumn("grp", F.pmod(F.xxhash64("row_id", F.lit(level)), F.lit(groups)))
            .groupBy("grp")
            .applyInPandas(lambda group: pack_group(group, capacity), schema)
            .withColumn("sequence_id", F.col("grp") * (1 << 24) + F.col("bin")),
            "bins",
        )
        final = groups == 1
        packed.append(
            binned.filter(F.lit(final) | ~F.col("carry")).select(
                "row_id", (F.col("sequence_id") * 64 + F.lit(level + 1)).alias("sequence_id"), "offset"
            )
        )
        left = binned.filter("carry").select("row_id", "length")
        total = 0 if final else left.count()
        level += 1
    full = kept.filter(F.col("length") >= capacity).withColumns({"sequence_id": F.col("row_id") * 64, "offset": F.lit(0).cast("long")})
    for part in packed:
        full = full.unionByName(kept.join(part, "row_id"))
    return full.drop("row_id")
