"""Corpus vocabulary, id encoding and decoding, batches.

A vocabulary is a table ``(token, id, count)``.  Encoding and decoding take either that
table, of any size, or the :class:`Dictionary` that :func:`compact` makes of it when its size
allows.  A dictionary is an open-addressed table of tokens in flat arrays: every row is
encoded where it is read.  With a larger vocabulary the most frequent tokens are such a table
and only what lies outside of it is joined.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkit.functions import encoding as E
from labelkit.functions.lookup import TokenTable, Words, count_tokens, joined, runs, slices
from labelkit.operators.ranks import TOP_N_LIMIT, ordered_rank
from labelkit.session import stage_table

#: Tokens of a dictionary at most: about 40 bytes each, in the driver and in every worker.
DICTIONARY_LIMIT = 500_000
#: Most frequent tokens that are looked up in place when the vocabulary is larger.
FREQUENT_TOKENS = 100_000
#: Ids that are decoded at once.
SLICE_IDS = 100_000


def build_vocab(df: DataFrame, columns: Sequence[str], size: int | None = None) -> DataFrame:
    """``(token, id, count)`` of all tokens of the whole texts, or of the ``size`` most frequent.

    Ids follow frequency, then the token, after the reserved ones.  Tasks send each distinct
    token once per table that they fill; a large vocabulary is numbered by one range shuffle.
    """
    counts = count_tokens(df.select(F.concat_ws(" ", *columns).alias("_joined")), "_joined")
    if size is None or size > TOP_N_LIMIT:
        narrow = stage_table(counts.withColumn("_less", -F.col("count")), "tokens")
        ranked = ordered_rank(narrow, ["_less", "token"], name="_rank")
        if size is not None:
            ranked = ranked.filter(F.col("_rank") <= size)
        return ranked.select("token", (F.col("_rank") + (E.FIRST_TOKEN_ID - 1)).alias("id"), "count")
    top = counts.orderBy(F.desc("count"), "token").limit(size)
    by_frequency = Window.orderBy(F.desc("count"), "token")  # over the `size` rows kept above
    return top.select("token", (F.row_number().over(by_frequency) + (E.FIRST_TOKEN_ID - 1)).alias("id"), "count")


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


class Dictionary:
    """Tokens and their ids in flat arrays; lookups are Arrow functions of a column."""

    def __init__(self, tokens: pa.Array, ids: np.ndarray):
        self.table = TokenTable(tokens)
        self.by_entry = ids.astype(np.int32)
        self.by_id = np.full(int(ids.max(initial=-1)) + 1, -1, dtype=np.int32)
        self.by_id[ids] = np.arange(len(ids), dtype=np.int32)

    def __len__(self) -> int:
        return len(self.table)

    def _words(self, texts: pa.Array, limit: int | None) -> Iterator[Words]:
        texts = texts.cast(pa.binary())
        for start, stop in slices(texts):
            yield Words.of(texts.slice(start, stop - start).to_pylist(), limit)

    def _encode(self, words: Words) -> np.ndarray:
        entry = self.table.find(words)
        return np.where(entry < 0, np.int32(E.UNK_ID), self.by_entry[entry] if len(self) else np.int32(E.UNK_ID))

    def ids(self, text: Column, limit: int | None = None) -> Column:
        """Ids of the tokens of a text, or of its first ``limit``; the unknown id for other tokens."""

        def encode(texts: pa.Array) -> pa.Array:
            found = [(self._encode(w), w.counts) for w in self._words(texts, limit)]
            none = [(np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))]
            values, counts = (np.concatenate(x) for x in zip(*(found or none)))
            return _lists(pa.array(values.astype(np.int32)), counts)

        return F.arrow_udf(encode, "array<int>")(_lowered(text))

    def ids_and_rest(self, text: Column, limit: int | None = None) -> Column:
        """``struct(ids, pos, token)``: the ids, and the places and tokens that are not in the table."""

        def encode(texts: pa.Array) -> pa.Array:
            ids, counts, pos, rest, n_rest = [], [], [], [pa.array([], pa.string())], []
            for w in self._words(texts, limit):
                own = self._encode(w)
                unknown = np.flatnonzero(own == E.UNK_ID)
                first = np.cumsum(w.counts) - w.counts
                owner = np.repeat(np.arange(len(w.counts)), w.counts)[unknown]
                ids.append(own)
                counts.append(w.counts)
                pos.append((unknown - first[owner]).astype(np.int32))
                rest.append(w.tokens(unknown))  # in Arrow: an object per token would take ten times the text
                n_rest.append(np.bincount(owner, minlength=len(w.counts)))
            every = [np.concatenate([np.zeros(0, dtype=np.int32), *x]) for x in (ids, counts, pos, n_rest)]
            tokens = pa.concat_arrays(rest)
            columns = [
                _lists(pa.array(every[0].astype(np.int32)), every[1]),
                _lists(pa.array(every[2].astype(np.int32)), every[3]),
                _lists(tokens, every[3]),
            ]
            return pa.StructArray.from_arrays(columns, ["ids", "pos", "token"])

        return F.arrow_udf(encode, "struct<ids:array<int>,pos:array<int>,token:array<string>>")(_lowered(text))

    def text(self, ids: Column) -> Column:
        """Words of an array of ids, joined by blanks; reserved and unknown ids are skipped."""

        def decode(lists: pa.Array) -> pa.Array:
            return _decode(self, lists, None, None)

        return F.arrow_udf(decode, "string")(ids.cast("array<int>"))


def _lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text.cast("string"), F.lit("")))


def _decode(words: Dictionary, lists: pa.Array, pos: pa.Array | None, tokens: pa.Array | None) -> pa.Array:
    """Texts of lists of ids; ``tokens`` stand at the places ``pos`` of their lists.

    Lists are decoded ``SLICE_IDS`` ids at a time, or one longer list, without an object per token.
    """
    sizes = np.asarray(pc.fill_null(lists.value_lengths(), 0), dtype=np.int64)
    parts = [pa.array([], pa.string())]
    for start, stop in runs(sizes, SLICE_IDS):
        some = [x if x is None else x.slice(start, stop - start) for x in (lists, pos, tokens)]
        parts.append(_decode_slice(words, sizes[start:stop], *some))
    out = pa.concat_arrays(parts)
    if lists.null_count:
        out = pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), out)
    return out


def _decode_slice(words: Dictionary, counts: np.ndarray, lists: pa.Array, pos: pa.Array | None, tokens: pa.Array | None) -> pa.Array:
    table = words.table
    ids = np.asarray(pc.fill_null(lists.flatten(), -1), dtype=np.int64)
    known = (ids >= 0) & (ids < len(words.by_id))
    entry = np.full(len(ids), -1, dtype=np.int64)
    entry[known] = words.by_id[ids[known]]
    there = entry >= 0
    data, starts, lengths = table.blob, np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
    starts[there] = table.offsets[entry[there]]
    lengths[there] = table.offsets[entry[there] + 1] - starts[there]
    if tokens is not None:
        given = tokens.flatten().cast(pa.large_string())
        owner = np.repeat(np.arange(len(counts)), np.asarray(pc.fill_null(pos.value_lengths(), 0), dtype=np.int64))
        at = (np.cumsum(counts) - counts)[owner] + np.asarray(pos.flatten(), dtype=np.int64)
        offsets = np.frombuffer(given.buffers()[1], dtype=np.int64)[given.offset : given.offset + len(given) + 1] if len(given) else np.zeros(1, dtype=np.int64)
        held = np.frombuffer(given.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, dtype=np.uint8)
        there[at] = True
        starts[at], lengths[at] = len(data) + offsets[:-1] - offsets[0], np.diff(offsets)
        data = np.concatenate([data, held])
    owner = np.repeat(np.arange(len(counts)), counts)[there]
    return joined(data, starts[there], lengths[there], np.bincount(owner, minlength=len(counts)))


def _dictionary(vocab: DataFrame) -> Dictionary:
    """The dictionary of a vocabulary of a checked size."""
    rows = vocab.select("token", F.col("id").cast("int").alias("id")).toArrow()
    tokens = rows.column("token").combine_chunks()
    tokens = pa.concat_arrays(tokens.chunks) if isinstance(tokens, pa.ChunkedArray) else tokens
    return Dictionary(tokens.cast(pa.string()), np.asarray(rows.column("id")))


def compact(vocab: DataFrame, limit: int = DICTIONARY_LIMIT) -> Dictionary | DataFrame:
    """The dictionary of a vocabulary of at most ``limit`` tokens, else the table unchanged.

    The vocabulary is written once, so that it is not counted twice; at most ``limit``
    tokens reach the driver.
    """
    kept = stage_table(vocab.select("token", "id"), "vocab")
    return vocab if kept.count() > limit else _dictionary(kept)


def encode_text(
    df: DataFrame, vocab: Dictionary | DataFrame, text: str = "input_text", key: str = "example_id"
) -> DataFrame:
    """``(key, ids)`` of the whole text; tokens outside the vocabulary become the unknown id.

    NULL and empty texts have no ids, repeated rows stay, and a text is encoded whole
    however long it is.
    """
    if isinstance(vocab, Dictionary):
        return df.select(key, vocab.ids(F.col(text)).alias("ids"))
    return _encode_with_rest(df, vocab, key, [(text, None, "ids")])


def encode_examples(
    df: DataFrame,
    vocab: Dictionary | DataFrame,
    source_len: int = E.SOURCE_LEN,
    target_len: int = E.TARGET_LEN,
    key: str = "example_id",
) -> DataFrame:
    """Padded source and target ids with their masks, the input shape of a text model.

    Tokens beyond the model's length are cut before the lookup.
    """
    fields = [("input_text", source_len, "_source"), ("label", target_len, "_target")]
    if isinstance(vocab, Dictionary):
        ids = df.select(key, *[vocab.ids(F.col(c), n).alias(name) for c, n, name in fields])
    else:
        ids = _encode_with_rest(df, vocab, key, fields)
    return ids.select(
        key,
        E.pad_truncate(F.col("_source"), source_len).alias("source_ids"),
        E.pad_truncate(F.col("_target"), target_len).alias("target_ids"),
    ).select(
        key,
        "source_ids",
        E.attention_mask(F.col("source_ids")).alias("source_mask"),
        "target_ids",
        E.attention_mask(F.col("target_ids")).alias("target_mask"),
    )


def _head(vocab: DataFrame) -> tuple[Dictionary, DataFrame]:
    """The ``FREQUENT_TOKENS`` lowest ids, which are the most frequent tokens, and the others as a table."""
    frequent = F.col("id") < E.FIRST_TOKEN_ID + FREQUENT_TOKENS
    kept = stage_table(vocab.select("token", F.col("id").cast("int").alias("id")), "vocab")
    return _dictionary(kept.filter(frequent)), kept.filter(~frequent)


def _put(ids: pa.Array, pos: pa.Array, new: pa.Array) -> pa.Array:
    """``ids`` with the values ``new`` at the places ``pos`` of each list."""
    counts = np.asarray(ids.value_lengths(), dtype=np.int64)
    values = np.asarray(ids.flatten(), dtype=np.int32).copy()
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), np.asarray(pc.fill_null(pos.value_lengths(), 0)))
    values[first[owner] + np.asarray(pos.flatten(), dtype=np.int64)] = np.asarray(new.flatten(), dtype=np.int32)
    return _lists(pa.array(values), counts)


def _encode_with_rest(
    df: DataFrame, vocab: DataFrame, key: str, fields: Sequence[tuple[str, int | None, str]]
) -> DataFrame:
    """Encode ``(column, length, name)`` fields with a vocabulary larger than a dictionary.

    Frequent tokens are looked up in place.  The others are joined with the rest of the
    vocabulary by a shuffle, and what is found goes back into its row.  Rows are told apart
    by a number of their own, so a repeated key gives as many rows as it has.
    """
    head, rest = _head(vocab)
    names = [name for _, _, name in fields]
    coded = df.select(key, *[head.ids_and_rest(F.col(c), n).alias(name) for c, n, name in fields])
    coded = stage_table(coded.withColumn("_row", F.monotonically_increasing_id()), "encoded")

    def items(i: int, name: str) -> Column:
        both = F.arrays_zip(F.col(f"{name}.pos").alias("pos"), F.col(f"{name}.token").alias("token"))
        return F.transform(both, lambda x: F.struct(F.lit(i).alias("field"), x["pos"].alias("pos"), x["token"].alias("token")))

    open_items = F.concat(*[items(i, name) for i, name in enumerate(names)])
    asked = coded.select("_row", F.explode(open_items).alias("_i")).select("_row", "_i.*")
    met = asked.join(rest, "token").select("_row", F.struct("field", "pos", "id").alias("_new"))
    news = met.groupBy("_row").agg(F.collect_list("_new").alias("_new"))  # at most the tokens of a row
    put = F.arrow_udf(_put, "array<int>")

    def ids(i: int, name: str) -> Column:
        own = F.filter(F.coalesce("_new", F.array()), lambda x: x["field"] == i)
        return put(F.col(f"{name}.ids"), own["pos"], own["id"]).alias(name)

    joined = coded.join(news, "_row", "left")
    return joined.select(key, *[ids(i, name) for i, name in enumerate(names)])


def decode_ids(
    df: DataFrame, vocab: Dictionary | DataFrame, ids: str = "ids", key: str = "example_id"
) -> DataFrame:
    """``(key, text)`` with reserved ids (padding, end, unknown) skipped; NULL ids give NULL with a dictionary, else an empty text."""
    if isinstance(vocab, Dictionary):
        return df.select(key, vocab.text(F.col(ids)).alias("text"))
    head, rest = _head(vocab)
    frequent = E.FIRST_TOKEN_ID + FREQUENT_TOKENS
    listed = F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>"))
    rows = stage_table(df.select(key, listed.alias("_ids")).withColumn("_row", F.monotonically_increasing_id()), "ids")
    asked = rows.select("_row", F.posexplode("_ids").alias("_pos", "id")).filter(F.col("id") >= frequent)
    met = asked.join(rest, "id").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_pos", "token"))).alias("_new"))

    def decode(lists: pa.Array, pos: pa.Array, tokens: pa.Array) -> pa.Array:
        return _decode(head, lists, pos, tokens)

    decoded = F.arrow_udf(decode, "string")
    joined = rows.join(met, "_row", "left")
    return joined.select(key, decoded(F.col("_ids"), F.col("_new._pos"), F.col("_new.token")).alias("text"))


def assign_batches(
    df: DataFrame, size: int, length: Column, drop_last: bool = False, key: str = "example_id"
) -> DataFrame:
    """``(key, batch_id, batch_rows, pad_to)``: consecutive batches in key order.

    ``pad_to`` is the greatest ``length`` of the batch.  ``drop_last`` leaves out an
    incomplete last batch.
    """
    narrow = stage_table(df.select(key, length.cast("bigint").alias("_length")), "lengths")
    numbered = ordered_rank(narrow, [key], name="_rank").withColumn(
        "batch_id", F.floor((F.col("_rank") - 1) / F.lit(size))
    )
    batch = Window.partitionBy("batch_id")  # at most `size` rows each
    out = numbered.select(
        key,
        "batch_id",
        F.count(F.lit(1)).over(batch).alias("batch_rows"),
        F.max("_length").over(batch).alias("pad_to"),
    )
    return out.filter(F.col("batch_rows") == size) if drop_last else out
