"""Encoding, decoding and batches."""

from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelkit.functions import encoding as E
from labelkit.operators import text as T


def texts(spark):
    return spark.createDataFrame(
        [(1, "The cat\n\tthe  DOG ", "yes"), (2, "", "no"), (3, None, None), (4, "cat cat zebra", "yes no")],
        "example_id long, input_text string, label string",
    )


@pytest.fixture(scope="module")
def vocab(spark):
    return T.build_vocab(texts(spark), ["input_text", "label"], 4).cache()


def test_vocab_order_and_reserved_ids(vocab):
    got = [(r["token"], r["id"], r["count"]) for r in vocab.orderBy("id").collect()]
    assert got == [("cat", 3, 3), ("no", 4, 2), ("the", 5, 2), ("yes", 6, 2)]


@pytest.mark.parametrize("small", [True, False])
def test_encode_and_decode(spark, vocab, small):
    v = T.compact(vocab) if small else vocab
    assert isinstance(v, T.Dictionary) == small
    encoded = T.encode_text(texts(spark), v)
    assert {r["example_id"]: r["ids"] for r in encoded.collect()} == {1: [5, 3, 5, 2], 2: [], 3: [], 4: [3, 3, 2]}
    assert {r["example_id"]: r["text"] for r in T.decode_ids(encoded, v).collect()} == {
        1: "the cat the", 2: "", 3: "", 4: "cat cat"
    }


def test_both_ways_of_encoding_examples_agree(spark, vocab):
    a = T.encode_examples(texts(spark), T.compact(vocab), 5, 3)
    b = T.encode_examples(texts(spark), vocab, 5, 3)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    row = a.filter("example_id = 1").first()
    assert row["source_ids"] == [5, 3, 5, 2, E.EOS_ID] and row["source_mask"] == [1] * 5
    assert row["target_ids"] == [6, E.EOS_ID, E.PAD_ID] and row["target_mask"] == [1, 1, 0]


def test_compact_keeps_a_large_vocabulary_as_a_table(vocab):
    assert T.compact(vocab, limit=3) is vocab
    assert isinstance(T.compact(vocab, limit=4), T.Dictionary)


def test_pad_truncate_and_masks(spark):
    df = spark.createDataFrame([([7, 8, 9, 7, 8],), ([7],), ([],)], "ids array<int>")
    padded = df.select(E.pad_truncate(F.col("ids"), 4).alias("p")).select("p", E.mask_targets(F.col("p")))
    assert [tuple(r) for r in padded.collect()] == [
        ([7, 8, 9, 1], [7, 8, 9, 1]), ([7, 1, 0, 0], [7, 1, -100, -100]), ([1, 0, 0, 0], [1, -100, -100, -100])
    ]
    assert df.select(E.pad_truncate(F.col("ids"), 3, None)).first()[0] == [7, 8, 9]


@pytest.mark.parametrize("drop_last", [True, False])
def test_batches(spark, drop_last):
    n, size = 103, 10
    df = spark.range(n).select((F.col("id") * 3).alias("example_id"), (F.col("id") % 17).alias("n")).repartition(6)
    got = T.assign_batches(df, size, F.col("n"), drop_last).collect()
    assert len(got) == (n // size * size if drop_last else n)
    for r in got:
        place = r["example_id"] // 3
        members = range(place // size * size, min(place // size * size + size, n))
        assert r["batch_id"] == place // size and r["batch_rows"] == len(members)
        assert r["pad_to"] == max(i % 17 for i in members)
    assert len({r["batch_id"] for r in got}) == (n // size if drop_last else math.ceil(n / size))


def test_both_ways_agree_on_repeated_keys(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (1, "b c", None), (2, None, "y")]
    df = spark.createDataFrame(rows, "example_id long, input_text string, label string")
    vocab = T.build_vocab(df, ["input_text", "label"])
    by_join = T.encode_text(df, vocab)
    assert sorted(map(str, by_join.collect())) == sorted(map(str, T.encode_text(df, T.compact(vocab)).collect()))
    assert by_join.count() == 4
    words = sorted(map(str, T.decode_ids(by_join, vocab).collect()))
    assert words == sorted(map(str, T.decode_ids(by_join, T.compact(vocab)).collect()))


def test_a_large_vocabulary_joins_only_what_is_rare(spark, monkeypatch):
    monkeypatch.setattr(T, "FREQUENT_TOKENS", 3)
    rows = [(i, " ".join(f"w{j}" for j in range(i % 9)) + " rare" * (i == 5), f"w{i % 4}") for i in range(40)] + [(50, None, None), (50, "", "w0 w8")]
    df = spark.createDataFrame(rows, "example_id long, input_text string, label string")
    vocab = T.build_vocab(df, ["input_text", "label"])
    small = T.compact(vocab)
    assert len(small) == vocab.count()
    for limit in (None, 4):
        cut = vocab if limit is None else vocab.filter(F.col("id") < E.FIRST_TOKEN_ID + 5)
        a, b = T.encode_text(df, cut), T.encode_text(df, T.compact(cut))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        x, y = T.encode_examples(df, cut, 4, 3), T.encode_examples(df, T.compact(cut), 4, 3)
        assert sorted(map(str, x.collect())) == sorted(map(str, y.collect()))
    ids = T.encode_text(df, small)
    assert sorted(map(str, T.decode_ids(ids, vocab).collect())) == sorted(map(str, T.decode_ids(ids, small).collect()))


def test_only_rare_tokens_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(T, "FREQUENT_TOKENS", 1)
    df = texts(spark)
    T.encode_text(df, T.build_vocab(df, ["input_text", "label"])).collect()
    head, _ = T._head(T.build_vocab(df, ["input_text", "label"]))
    rest = df.select(head.ids_and_rest(F.col("input_text")).alias("c")).select(F.explode("c.token").alias("t")).collect()
    assert "cat" not in {r["t"] for r in rest} and {r["t"] for r in rest} == {"the", "dog", "zebra"}


def test_more_than_one_slice_of_texts(spark):
    long = " ".join(f"t{i % 1000}" for i in range(400_000))
    df = spark.createDataFrame([(1, long, "a"), (2, "t1 t2", "b"), (3, long, None)], "example_id long, input_text string, label string").coalesce(1)
    vocab = T.compact(T.build_vocab(df, ["input_text", "label"]))
    found = {r["example_id"]: r["n"] for r in T.encode_text(df, vocab).select("example_id", F.size("ids").alias("n")).collect()}
    assert found == {1: 400_000, 2: 2, 3: 400_000}
    words = {r["example_id"]: r["text"] for r in T.decode_ids(T.encode_text(df, vocab), vocab).collect()}
    assert words == {1: long, 2: "t1 t2", 3: long}


def _peak_mb(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_decoding_makes_no_object_per_token():
    n, each = 2_000, 300
    words = T.Dictionary(pa.array(["a", "bc"]), np.array([3, 4]))
    lists = pa.array([[3, 99] * (each // 2), None, [1, 4, 7], []] + [[3, 99] * (each // 2)] * n, pa.list_(pa.int32()))
    pos = pa.array([list(range(1, each, 2)), None, None, None] + [list(range(1, each, 2))] * n, pa.list_(pa.int32()))
    tokens = pa.array([[f"r{i}" for i in range(each // 2)], None, None, None] + [[f"r{i}" for i in range(each // 2)]] * n, pa.list_(pa.string()))
    text = " ".join(f"a r{i}" for i in range(each // 2))
    out, peak = _peak_mb(lambda: T._decode(words, lists, pos, tokens))
    assert out[:4].to_pylist() == [text, None, "bc", ""] and set(out[4:].to_pylist()) == {text}
    assert peak < 40, peak
    plain, peak = _peak_mb(lambda: T._decode(words, lists, None, None))
    assert plain[:4].to_pylist() == [" ".join(["a"] * (each // 2)), None, "bc", ""] and peak < 40, peak
    cut = T._decode(words, lists.slice(2, 1500), pos.slice(2, 1500), tokens.slice(2, 1500))
    assert cut.equals(out.slice(2, 1500))


def test_tokens_outside_of_the_dictionary_stay_in_arrow(monkeypatch):
    words, found = T.Dictionary(pa.array(["a"]), np.array([3])), {}
    monkeypatch.setattr(T.F, "arrow_udf", lambda fn, kind: found.setdefault("fn", fn) and (lambda text: text))
    monkeypatch.setattr(T, "_lowered", lambda text: text)
    words.ids_and_rest(None)
    texts = pa.array(["a " + " ".join(f"r{i}" for i in range(400_000)), None, "", "x\u00e9 a y"])
    out, peak = _peak_mb(lambda: found["fn"](texts))
    assert out.field("pos")[3].as_py() == [0, 2] and out.field("token")[3].as_py() == ["x\u00e9", "y"] and out.field("token")[1].as_py() == []
    assert len(out.field("token")[0]) == 400_000 and out.field("ids")[3].as_py() == [2, 3, 2]
    few = [" ".join(f"r{i}" for i in range(1000))] * 5000
    out, peak = _peak_mb(lambda: found["fn"](pa.array(few)))
    assert peak < 150 and out.field("token")[4999].as_py() == few[0].split(), peak
