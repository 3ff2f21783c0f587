"""Resampling of documents towards a target distribution by hashed n-gram features.

The CRC-32 of every run of consecutive words names its bucket.  Each document is scanned
once in the form "words joined by one blank": the scan keeps the running CRC register at
the edges of the words, and the CRC of any run of words follows from the two registers at
its ends.  Appending bytes to a message is linear over GF(2), so what stands before the run
cancels out once the earlier register is shifted by the length of the run.

The buckets of each document are written once; corpus counts and weights are read from them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.llm.common import slices
from labelkit.operators.ranks import ordered_rank
from labelkit.session import stage_table

#: Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)
#: Bytes of the normalised text that are scanned together, as LANES runs of LANE bytes.
LANE, LANES = 1024, 1024
#: Shifts by up to 2 ** LEVELS - 1 bytes.
LEVELS = 40


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1 == 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _apply(tables: np.ndarray, registers: np.ndarray) -> np.ndarray:
    """A linear map of registers, given by its values on the four bytes of a register."""
    out = tables[0][registers & 255]
    for j in (1, 2, 3):
        out = out ^ tables[j][(registers >> np.uint32(8 * j)) & 255]
    return out


class Crc:
    """Running CRC registers and shifts of them, on numpy arrays."""

    def __init__(self):
        self.step = _byte_table()
        one = np.arange(256, dtype=np.uint32)
        shift = np.stack([self._zero_byte(one << np.uint32(8 * j)) for j in range(4)])
        self.shifts = [shift]  # shifts[k] appends 2 ** k zero bytes
        for _ in range(LEVELS - 1):
            shift = np.stack([_apply(shift, shift[j]) for j in range(4)])
            self.shifts.append(shift)

    def _zero_byte(self, registers: np.ndarray) -> np.ndarray:
        return self.step[registers & 255] ^ (registers >> np.uint32(8))

    def shift(self, registers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The registers after ``lengths`` further zero bytes."""
        out = registers.copy()
        for k in range(int(lengths.max(initial=0)).bit_length()):
            at = np.flatnonzero((lengths >> k) & 1)
            out[at] = _apply(self.shifts[k], out[at])
        return out

    def _scan(self, columns: np.ndarray, start: np.ndarray, keep: bool) -> np.ndarray:
        """Registers of all lanes after each byte (``keep``), or after the last one."""
        kept = np.empty((len(columns) + 1, len(start)), dtype=np.uint32) if keep else None
        register = start
        for t, column in enumerate(columns):
            if keep:
                kept[t] = register
            register = self.step[(register ^ column) & 255] ^ (register >> np.uint32(8))
        if keep:
            kept[len(columns)] = register
        return kept if keep else register

    def prefixes(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Registers after ``data[:place]``, from a zero register, for ascending ``places``.

        Blocks of ``LANE * LANES`` bytes follow each other.  Their lanes are scanned side by
        side, first for the register that each lane hands on, then from the right start.
        """
        out = np.zeros(len(places), dtype=np.uint32)
        carry = np.uint32(0)
        hand_on = self.shifts[LANE.bit_length() - 1]
        for first in range(0, len(data), LANE * LANES):
            block = data[first : first + LANE * LANES]
            lanes = -(-len(block) // LANE)
            columns = np.zeros(lanes * LANE, dtype=np.uint8)
            columns[: len(block)] = block
            columns = np.ascontiguousarray(columns.reshape(lanes, LANE).T)
            ends = self._scan(columns, np.zeros(lanes, dtype=np.uint32), keep=False)
            starts = np.empty(lanes, dtype=np.uint32)
            for lane in range(lanes):
                starts[lane] = carry
                carry = ends[lane] ^ _apply(hand_on, np.array([carry], dtype=np.uint32))[0]
            kept = self._scan(columns, starts, keep=True)
            lo, hi = np.searchsorted(places, [first, first + len(block)])
            if first + len(block) == len(data):
                hi = len(places)
            at = places[lo:hi] - first
            lane = np.minimum(at // LANE, lanes - 1)
            out[lo:hi] = kept[at - lane * LANE, lane]
        return out

    def runs(self, before: np.ndarray, after: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """CRC-32 of runs of bytes from the registers ``before`` and ``after`` them."""
        return after ^ self.shift(before ^ ONES, lengths) ^ ONES


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and every byte with A-Z lower-cased."""
    byte = np.arange(256)
    upper = (byte >= ord("A")) & (byte <= ord("Z"))
    digit = (byte >= ord("0")) & (byte <= ord("9"))
    lower = (byte >= ord("a")) & (byte <= ord("z"))
    return upper | lower | digit | (byte >= 128), np.where(upper, byte + 32, byte).astype(np.uint8)


class Features:
    """Buckets of all runs of 1 to ``longest`` words of each text."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets = longest, buckets
        self.crc = Crc()
        self.is_word, self.lower = _byte_classes()

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text, features of each text, and the buckets of all features, text by text."""
        raw = np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8)
        inside = self.is_word[raw]
        before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
        stream = np.where(inside, self.lower[raw], np.uint8(32))[inside | before]
        edges = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        first_word = np.searchsorted(starts, edges)
        n_words = np.diff(first_word)
        size = ends - starts
        begin = np.cumsum(size + 1) - (size + 1)
        places = np.stack([begin, begin + size], axis=1).ravel()
        registers = self.crc.prefixes(stream, places).reshape(-1, 2)
        owner = np.repeat(np.arange(len(texts)), n_words)
        of_text, found = [], []
        for n in range(1, self.longest + 1):
            at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
            lengths = begin[at + n - 1] + size[at + n - 1] - begin[at]
            found.append(self.crc.runs(registers[at, 0], registers[at + n - 1, 1], lengths) % np.uint32(self.buckets))
            of_text.append(owner[at])
        owners = np.concatenate(of_text)
        order = np.argsort(owners, kind="stable") if self.longest > 1 else slice(None)
        return n_words, np.bincount(owners, minlength=len(texts)), np.concatenate(found)[order]


def _width(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def hashed_features(docs: DataFrame, longest: int, buckets: int, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``n_words``, ``n_features`` and ``features`` (little-endian buckets) of each row.

    The whole text is read; NULL has no words.  A task holds about a million characters, or
    one longer text (about 12 bytes per byte of it).
    """
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    width = _width(buckets)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(longest, buckets)
        for part in slices(batches, "_text"):
            n_words, n_features, found = features.of(part.column("_text").to_pylist())
            offsets = np.concatenate([[0], np.cumsum(n_features)]).astype(np.int64) * width.itemsize
            data = pa.py_buffer(found.astype(width).tobytes())
            column = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(offsets), data])
            yield pa.RecordBatch.from_arrays(
                [*[part.column(i) for i in range(len(keep))], pa.array(n_words), pa.array(n_features), column.cast(pa.binary())],
                names=[*keep, "n_words", "n_features", "features"],
            )

    schema = T.StructType(rows.schema.fields[:-1]).add("n_words", "long").add("n_features", "long").add("features", "binary")
    return rows.mapInArrow(scan, schema)


def bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, n)`` over all rows; every task sends one row per bucket at most."""
    width = _width(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for part in slices(batches, "features"):
            total += np.bincount(np.frombuffer(b"".join(part.column("features").to_pylist()), dtype=width), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    sent = features.select("features").mapInArrow(count, "bucket long, n long")
    return sent.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """``floor(1000 * ln(...))`` of the smoothed target share over the source share, per bucket.

    ``buckets`` rows reach the driver.
    """
    def dense(counts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, dtype=np.int64)
        for row in counts.collect():
            out[row["bucket"]] = row["n"]
        return out

    s, t = dense(source), dense(target)
    over = (t + 1).astype(np.float64) * float(s.sum() + buckets)
    under = (s + 1).astype(np.float64) * float(t.sum() + buckets)
    return np.floor(1000 * np.log(over / under)).astype(np.int64)


def weights(features: DataFrame, gains: np.ndarray, buckets: int) -> DataFrame:
    """``features`` rows with ``weight``, the mean gain rounded down, in place of the buckets."""
    width = _width(buckets)
    names = [c for c in features.columns if c != "features"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "features"):
            own = np.asarray(part.column("n_features"), dtype=np.int64)
            found = np.frombuffer(b"".join(part.column("features").to_pylist()), dtype=width)
            running = np.concatenate([[0], np.cumsum(gains[found])])
            ends = np.cumsum(own)
            mean = (running[ends] - running[ends - own]) // np.maximum(own, 1)
            columns = [part.column(part.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(mean)], names=[*names, "weight"])

    return features.mapInArrow(weigh, T.StructType([f for f in features.schema.fields if f.name in names]).add("weight", "long"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``(key, n_features, weight, score, rank)`` of every row of ``docs``.

    ``score`` is the weight with Gumbel noise from a hash of ``seed`` and the key, so taking
    the highest scores draws without replacement in proportion to exp(weight / 1000).  Of
    the N rows with ``least_words`` words or more the ``percent`` * N / 100 highest scores,
    rounded down, get a rank, ties by key; ``rank`` is NULL for all others.

    NULL or empty texts have no features and weight 0.  A NULL key hashes like an empty one
    and is ranked before other keys of its score.  Repeated rows are rows of their own with
    consecutive ranks.  An empty ``docs`` gives no rows; with an empty ``target`` all of its
    counts are 0.  Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_body"))
    features = stage_table(hashed_features(rows, longest, buckets, "_body", ["_key"]), "features")
    aim = hashed_features(target.select(F.col(text).alias("_body")), longest, buckets, "_body", [])
    gains = bucket_gains(bucket_counts(features, buckets), bucket_counts(aim, buckets), buckets)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_key").cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(name, 256), F.lit(8)), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weights(features, gains, buckets).withColumn("score", F.col("weight") + noise)
    scored = stage_table(scored.withColumn("_less", -F.col("score")), "scored")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.filter(able).count() // 100
    ranked = ordered_rank(scored.filter(able), ["_less", "_key"], name="_rank")
    every = ranked.unionByName(scored.filter(~able).withColumn("_rank", F.lit(None).cast("long")))
    rank = F.when(F.col("_rank") <= drawn, F.col("_rank")).cast("long")
    return every.select(F.col("_key").alias(key), "n_features", "weight", "score", rank.alias("rank"))
