"""Word-shingle sets of texts in numpy: one vectorised pass over the bytes of an Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_rng = np.random.default_rng(20240229)
#: Fixed random numbers: one per byte value, an odd multiplier, and its inverse modulo 2^64.
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
STEP = _U(0x9E3779B97F4A7C15 | 1)
UNSTEP = _U(pow(int(STEP), -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BYTE[SPACE] = 0
BYTE = BYTE[LOWER]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which close inputs give unrelated outputs."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of each text, and the number of words of each text.

    A word is a run without the six ASCII white-space bytes; A-Z count as a-z.  It is the
    difference of two prefix sums of a polynomial over the bytes, shifted to position 0.
    """
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    edges = (offsets - offsets[0]).astype(np.int64)
    n = len(data)
    word = ~SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edge = edges[:-1][edges[:-1] < n]
    begins[edge] = word[edge]
    starts = np.flatnonzero(begins)
    sums = np.cumsum(BYTE[data] * powers(STEP, n), dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], _U(0))
    # spaces add nothing, so the next word's start also ends this word's sum
    after = np.append(before[1:], sums[-1]) if len(starts) else before
    hashes = mix((after - before) * powers(UNSTEP, n)[starts])
    return hashes, np.diff(np.searchsorted(starts, edges))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within a text, or of the whole of a shorter text."""
    n = len(words)
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    left = ends[owner] - np.arange(n)  # words from here to the end of the text
    total = np.full(n, _U(k))
    for j in range(k):
        nxt = np.zeros(n, dtype=np.uint64)
        nxt[: max(0, n - j)] = words[j:]
        total = total * STEP + np.where(left > j, nxt, _U(j + 1))
    first = np.arange(n) == (ends - counts)[owner]
    keep = (left >= k) | ((counts[owner] < k) & first)
    return mix(total[keep]), np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text without words has none."""
    words, counts = word_hashes(texts)
    hashes, sizes = shingle_hashes(words, counts, k)
    ends = np.cumsum(sizes)
    return [np.unique(hashes[e - s : e]) for s, e in zip(sizes, ends)]
