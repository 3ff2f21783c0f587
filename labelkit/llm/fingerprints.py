"""Homomorphic multiset fingerprints of documents; SQL expressions only.

A text is the multiset of its paragraphs: lines, sentences, and runs of about eight words
within them, so that any text has several.  Each is hashed to a wide vector of 0s and 1s,
one per lane, and a fingerprint is the sum of all vectors, lane by lane modulo 2^16, with
the number of paragraphs.  The order of paragraphs has no effect, equal multisets have
equal fingerprints, and paragraphs are added or removed by adding or subtracting.

Centred at half the number of paragraphs, a lane is a sum of random signs, so the product
of two fingerprints estimates how many paragraphs they share.  Four lanes lie in one 64-bit
number; their sums never carry into each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkit.llm.common import bind

LONGS = 32  # four lanes each
ONES = 0x0001_0001_0001_0001
EVEN = 0x0000_FFFF_0000_FFFF
CHUNK = 32_000  # paragraphs whose plain sum stays within every lane
#: Lines, and within a line sentences.
PARAGRAPH = r"\n+|(?<=[.!?\u2026\u061f\u0964])[ \t]+|(?<=[\u3002\uff01\uff1f\uff61])"
#: A word with what follows up to the next one; one character in scripts without blanks.
TOKEN = r"(?<=[^\p{L}\p{N}\p{M}])(?=[\p{L}\p{N}])|(?<=[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
#: One word of so many, by its hash, ends a run; a run without such words is cut from its beginning.
RUN, LONGEST = 8, 512


def paragraphs(text: Column) -> Column:
    """The units of a text: lines, sentences, and within them runs of words that their own words end."""
    ends = F.transform(F.split(text, TOKEN), lambda t: F.when(F.pmod(F.xxhash64(t), F.lit(RUN)) == 0, F.concat(t, F.lit("\n"))).otherwise(t))
    runs = F.split(F.array_join(ends, ""), PARAGRAPH)
    parts = F.flatten(F.transform(runs, lambda r: F.when(F.length(r) > LONGEST, F.split(r, rf"(?s)(?<=\G.{{{LONGEST}}})")).otherwise(F.array(r))))
    return F.filter(parts, lambda p: p != "")


def lane_add(a: Column, b: Column) -> Column:
    """Lane-wise sum modulo 2^16 of two numbers of four lanes."""

    def part(x: Column, y: Column) -> Column:
        return (x.bitwiseAND(F.lit(EVEN)) + y.bitwiseAND(F.lit(EVEN))).bitwiseAND(F.lit(EVEN))

    odd = part(F.shiftrightunsigned(a, 16), F.shiftrightunsigned(b, 16))
    return part(a, b).bitwiseOR(F.shiftleft(odd, 16))


def lane_negate(a: Column) -> Column:
    """Lane-wise negative modulo 2^16: the complement plus one."""
    return lane_add(F.bitwise_not(a), F.lit(ONES))


def vector(text: Column) -> Column:
    """Fingerprint of a text: the number of paragraphs, then ``LONGS`` numbers of four lanes."""

    def of(parts: Column) -> Column:
        both = [F.transform(parts, lambda p: F.xxhash64(p)), F.transform(parts, lambda p: F.xxhash64(F.lit("second"), p))]

        zero = F.lit(0).cast("long")

        def add(hashes: Column, shift: int) -> Column:
            def plain(c: Column) -> Column:
                own = F.slice(hashes, c * CHUNK + 1, F.lit(CHUNK))
                return F.aggregate(own, zero, lambda acc, h: acc + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(ONES)))

            chunks = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(hashes) - 1, F.lit(0)) / CHUNK).cast("int")), plain)
            return F.aggregate(chunks, zero, lane_add)

        lanes = [bind(h, lambda h: F.array(*[add(h, s) for s in range(16)])) for h in both]
        return F.concat(F.array(F.size(parts).cast("long")), *lanes)

    return bind(paragraphs(text), of)


def combined(a: Column, b: Column, remove: bool = False) -> Column:
    """The fingerprint of both multisets together, or of ``a`` without ``b``."""
    count = F.array(F.get(a, F.lit(0)) + (-1 if remove else 1) * F.get(b, F.lit(0)))
    other = F.transform(b, lambda x: lane_negate(x)) if remove else b
    lanes = F.zip_with(F.slice(a, 2, LONGS), F.slice(other, 2, LONGS), lane_add)
    return F.concat(count, lanes)


def written(v: Column) -> Column:
    """Hexadecimal digits of the count and all lanes."""
    return F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two fingerprints, 0 to 1: about the share of common paragraphs; 1 if equal."""

    def centred(v: Column) -> Column:
        lanes = F.flatten(F.transform(F.slice(v, 2, LONGS), lambda x: F.array(*[F.shiftrightunsigned(x, s).bitwiseAND(F.lit(0xFFFF)) for s in (0, 16, 32, 48)])))
        return bind(F.pmod(F.get(v, F.lit(0)), F.lit(1 << 16)), lambda n: F.transform(lanes, lambda c: _signed(2 * c - n)))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    def cosine(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        size = F.sqrt(dot(x, x) * dot(y, y))
        return F.when(size > 0, F.least(F.greatest(dot(x, y) / size, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)

    none = (F.get(a, F.lit(0)) == 0) | (F.get(b, F.lit(0)) == 0)
    return F.when(a == b, 1.0).when(none, 0.0).otherwise(bind(F.struct(centred(a).alias("x"), centred(b).alias("y")), cosine))


def _signed(x: Column) -> Column:
    """A sum of signs modulo 2^16, taken as lying between -2^15 and 2^15."""
    return (F.pmod(x + (1 << 15), F.lit(1 << 16)) - (1 << 15)).cast("double")


def with_next(docs: DataFrame, buckets: int, text: str, derived: dict[str, Column]) -> DataFrame:
    """``docs`` with ``derived`` columns of its text, and ``next_<column>`` of the text and them for
    the following row by ``doc_id``; the last row is followed by the first.

    Rows meet in ranges of ``doc_id`` that quantiles cut, so each text is shuffled once and
    no task sees more than its ranges.  The first row of a range follows the last one of
    the range before.  Rows without an id come first; rows of one id are in order of their texts.
    """
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets))) or [0.0]
    bucket = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("doc_id")))
    columns = [text, *derived]
    rows = docs.withColumn("__bucket", bucket).withColumn("__order", F.xxhash64(text))
    order = [F.col("doc_id").asc_nulls_first(), F.col("__order")]
    own = Window.partitionBy("__bucket").orderBy(*order)
    led = rows.withColumns(derived).withColumns({f"next_{c}": F.lead(c).over(own) for c in columns}).withColumn("__last", F.lead("__order").over(own).isNull())
    # one row per bucket, at most ``buckets`` of them
    first = rows.groupBy("__bucket").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.col("__order").alias("o"))).alias("f"))
    by_bucket = Window.orderBy("__bucket")
    follows = first.withColumn("__before", F.lag("__bucket").over(by_bucket)).withColumn("__end", F.max("__bucket").over(Window.partitionBy()))
    heads = follows.select(F.coalesce("__before", "__end").alias("__prev"), "f.id", "f.o")
    head_rows = rows.join(
        F.broadcast(heads), (F.coalesce(rows["doc_id"], F.lit(-(1 << 63))) == F.col("id")) & (rows["__order"] == F.col("o"))
    ).dropDuplicates(["__prev"]).withColumns(derived)
    heads = head_rows.select(F.col("__prev").alias("__bucket"), *[F.col(c).alias(f"__head_{c}") for c in columns])
    met = led.join(heads, "__bucket")
    out = {f"next_{c}": F.when(F.col("__last"), F.col(f"__head_{c}")).otherwise(F.col(f"next_{c}")) for c in columns}
    return met.withColumns(out).drop("__bucket", "__order", "__last", *[f"__head_{c}" for c in columns])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``, an array of numbers (see ``vector``); null texts count as empty."""
    return docs.withColumn("fingerprint", vector(F.coalesce(F.col(text), F.lit(""))))
