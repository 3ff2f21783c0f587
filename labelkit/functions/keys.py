"""Hash keys: the only source of randomness in the package."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hex digits of an order key used as its bucket: 16**4 = 65,536 equal buckets.
BUCKET_DIGITS = 4


def keyed_text(seed: int | Column, stage: str, *parts: Column) -> Column:
    """``"seed:stage:part[:part...]"``, the text behind every random decision."""
    seed_col = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    return F.concat_ws(":", seed_col, F.lit(stage), *[p.cast("string") for p in parts])


def order_key(seed: int | Column, stage: str, *parts: Column) -> Column:
    """md5 of :func:`keyed_text`: sorting by it is a seeded shuffle of the rows."""
    return F.md5(keyed_text(seed, stage, *parts))


def bucket_of(order: Column) -> Column:
    return F.substring(order, 1, BUCKET_DIGITS)


def hash_int(text: Column, digits: int = 7) -> Column:
    """The first ``digits`` (at most 15) hex digits of the md5 of ``text`` as BIGINT."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def hash_uniform(text: Column) -> Column:
    """A number in [0, 1) with 52 random bits, from the md5 of ``text``."""
    return hash_int(text, 13).cast("double") / F.lit(float(16**13))
