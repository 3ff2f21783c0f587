"""Row-local token and id-array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved ids in front of the vocabulary, and the id a loss ignores.
PAD_ID = 0
EOS_ID = 1
UNK_ID = 2
FIRST_TOKEN_ID = 3
IGNORE_ID = -100

# Token separator, and the padded lengths of source and target.
SEPARATOR = "[ \\t\\n\\r\\f]+"
SOURCE_LEN = 512
TARGET_LEN = 16


def tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens of the whole text; an empty array for NULL."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATOR), "")


def pad_truncate(ids: Column, length: int, eos_id: int | None = EOS_ID) -> Column:
    """Exactly ``length`` ids: cut, closed with the end id, zero-padded on the right."""
    if eos_id is None:
        body = F.slice(ids, 1, length)
    else:
        body = F.concat(F.slice(ids, 1, length - 1), F.array(F.lit(eos_id)))
    return F.concat(body, F.array_repeat(F.lit(PAD_ID), F.lit(length) - F.size(body)))


def attention_mask(padded: Column) -> Column:
    """1 on real positions, 0 on padding."""
    return F.transform(padded, lambda x: F.when(x == PAD_ID, 0).otherwise(1))


def mask_targets(padded: Column) -> Column:
    """Padding replaced by the id a loss ignores."""
    return F.transform(padded, lambda x: F.when(x == PAD_ID, IGNORE_ID).otherwise(x))
