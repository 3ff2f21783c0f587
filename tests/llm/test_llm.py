"""The training-data operators against brute force, on hand-made and on given tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labelkit.llm import fingerprints, language, language_model, licenses, line_dedup, neighbours, ngram_join, packing, personal_data, pieces, shingles
from labelkit.llm.common import components
from labelkit.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL

WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = "the quick brown fox jumps over the lazy dog while nobody looks at the sky "
MESSY = [
    (1, LONG * 3 + "\nshort", "en"),
    (2, LONG * 3 + "\nshort", "en"),
    (2, LONG * 3 + "\nshort", "en"),
    (3, None, None),
    (4, "", "de"),
    (5, "###  123", "de"),
    (6, "Ünïcode ÉTÉ mail a.b@c.org now +1 (729) 555-7725", "fr"),
    (None, LONG * 3 + "\nother", None),
    (7, "x" * 3000 + " " + "1 " * 500, "en"),
]


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(*r, "clash", 1.0, 5, 9) for r in MESSY]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double, n_lines int, length int")


@pytest.fixture(scope="module")
def empty(messy):
    return messy.filter("doc_id = -1")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(name, spark):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    theirs = con.sql(ORACLES[name])
    mine = QUERIES[name](spark, SMALL).select(*theirs.columns)
    assert sorted(map(tuple, mine.collect())) == sorted(theirs.fetchall())


# 1 packing


def test_packing_places_every_piece(messy, empty):
    found = packing.pack(packing.encode_pieces(messy, WORDS, capacity=64), 64, group_pieces=4).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    wanted = Counter()
    for doc, text, _ in MESSY:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for start in range(0, len(ids), 64):
            part = ids[start : start + 64]
            wanted[doc, start, len(part), np.array(part, dtype="<u4").tobytes()] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], bytes(r["ids"])) for r in found) == wanted
    ends: dict[int, int] = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 64
    assert packing.pack(packing.encode_pieces(empty, WORDS)).count() == 0


def test_swaps_empty_a_bin():
    lengths = np.array([6, 6, 5, 5, 4, 4])  # best fit decreasing: 6 4, 6 4, 5 5
    bins = [[0, 2], [1, 3], [4], [5]]  # poor: 11, 11, 4, 4 of 15
    better = packing.local_search(bins, lengths, 15)
    assert sorted(k for b in better for k in b) == list(range(6))
    assert len(better) == 2
    assert all(lengths[b].sum() <= 15 for b in better)


# 2 language


def test_language_of_held_out_texts(docs):
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language.fit(docs.filter(~held), sample_chars=60_000)
    found = language.identify(docs.filter(held), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.9 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_code_length_is_that_of_the_counts():
    text = b"abab"
    rows = [(0, j + 1, int.from_bytes((b"\n\n" + text)[i - j + 2 : i + 3], "big")) for i in range(4) for j in range(3)]
    counts = Counter(rows)
    lang, length, key = (np.array(x) for x in zip(*counts))
    model = language.freeze(["x"], 2, lang, length, key.astype(np.uint64), np.array(list(counts.values())))

    def cost(context: bytes, c: int) -> float:
        seen = {k & 255: n for (_, size, k), n in counts.items() if size == len(context) + 1 and k >> 8 == int.from_bytes(context, "big")}
        n, d = sum(seen.values()), len(seen)
        if c in seen:
            return -math.log2(seen[c] / (n + d))
        rest = cost(context[1:], c) if context else 8.0
        return rest + (-math.log2(d / (n + d)) if n else 0.0)

    for word in (b"abab", b"ba", b"xyz", b"aab"):
        padded = b"\n\n" + word
        assert model.bits([word])[0, 0] == pytest.approx(sum(cost(padded[i : i + 2], padded[i + 2]) for i in range(len(word))), rel=1e-5)


def test_language_of_messy_rows(messy, empty):
    found = language.identify(messy, language.fit(messy))
    assert found.columns.count("score") == 1 and found.count() == len(MESSY)
    pred = by_id(found, "lang_pred")
    assert pred[3] == pred[4] == pred[5] == ("und",)
    assert language.fit(empty) is None
    assert language.identify(messy, None).filter("lang_pred <> 'und'").count() == 0


# 3 language model


def test_lm_scores(messy, empty):
    training = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 != 0
    keep = {r["doc_id"] for r in messy.filter(training).collect()}
    words = lambda t: [*(t or "").encode().lower().split(), None]
    c = Counter(w for doc, t, _ in MESSY if doc in keep for w in words(t))
    n, v = sum(c.values()), len(c)
    found = language_model.score(messy, training, WORDS).collect()
    assert len(found) == len(MESSY)
    for r in found:
        text = next(t for doc, t, _ in MESSY if doc == r["doc_id"])
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(text))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words(text)), sum(c[w] > 0 for w in words(text)), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert language_model.score(empty, training, WORDS).count() == 0


def test_attention_gradient_and_windows():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 300, 500)
    per_text = np.array([1, 120, 0, 379])
    model = language_model.train(ids, per_text, 300, steps=1, batch=8)
    inputs, targets = model.windows(model.slot_of[ids], per_text)
    assert (targets[targets >= 0] == model.slot_of[ids]).all()  # each subword once, in order
    grads = language_model._gradients(model, inputs, targets)

    def loss():
        return -(model.log_probs(ids, per_text) - model.within[ids]).mean()

    for name, at in (("q", (1, 2)), ("v", (3, 1)), ("embed", (int(model.slot_of[ids[0]]), 0)), ("place", (20, 4))):
        w = model.weights[name]
        was, step = w[at], np.float32(2e-2)
        w[at] = was + step
        up = loss()
        w[at] = was - step
        down = loss()
        w[at] = was
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_lm_learns_from_all_training_texts(spark):
    texts = [f"alpha beta gamma delta {'zebra ' * 5}" * 40 for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(99, " ".join(texts))], "doc_id long, text string").repartition(3)
    rows = language_model.segments(docs, "text")
    pieces_ = rows.select("text", "last").collect()
    assert sum(len(r["text"].split()) for r in pieces_) == 2 * sum(len(t.split()) for t in texts)
    assert sum(r["last"] for r in pieces_) == 61 and max(len(r["text"].split()) for r in pieces_) <= 2000
    n = language_model.subword_counts(rows, WORDS, 49_408, 1)
    cache = packing.word_cache(WORDS)
    whole = np.bincount(language_model.subwords(cache, pa.array([d["text"] for d in docs.collect()]), 1)[0], minlength=49_408)
    assert (n == whole).all()
    model = language_model.train(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 49_408, counts=n)
    ids, _, per_text = language_model.subwords(cache, pa.array(texts[:2]), 1)
    before = model.log_probs(ids, per_text).mean()
    assert language_model.go_on(rows, model, WORDS, 1, batch=8, rate=0.02) == n.sum()
    assert model.log_probs(ids, per_text).mean() > before + 0.5
    # few long texts: some of each is learnt from, whatever the draw of a sample
    scorer = language_model.fit(docs.filter("doc_id = 99"), language_model.word_counts(docs.filter("doc_id = 99"), "text"), WORDS, 49_408, 1, sample_chars=10)
    assert scorer.attention.log_probs(ids, per_text).mean() > -8


def test_lm_encodes_training_texts_once(spark):
    texts = ["Alpha beta\u00a0gamma \u0144\u0085x\x1cy " * 30, "", "tail \x0b end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = language_model.encoded(language_model.segments(docs, "text"), WORDS, 49_408, 1)
    plain = [i for t in texts for w in t.encode().lower().split() for i in packing.word_cache(WORDS).ids([w.decode()])[0]]
    # no later pass needs the texts or the tokenizer
    held = rows.drop("text")
    n = language_model.subword_counts(held, "/no/tokenizer", 49_408, 1)
    assert (n == np.bincount([*plain, 1, 1, 1], minlength=49_408)).all()
    model = language_model.train(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 49_408, counts=n)
    assert language_model.go_on(held, model, "/no/tokenizer", 1) == n.sum()


def test_softmax_of_large_logits():
    logits = np.array([[500.0, 0.0, -500.0, 499.0], [-900.0, -901.0, -2000.0, -900.0], [1.0, 2.0, 3.0, 4.0]])
    want = logits - np.logaddexp.reduce(logits, axis=1)[:, None]
    for at in range(4):
        found = language_model._log_softmax_at(logits.astype(np.float32), np.full(3, at))
        assert np.allclose(found, want[:, at], rtol=1e-4)
    w = {k: v * 60 for k, v in language_model.train(np.arange(200), np.array([200]), 300, steps=1, batch=8).weights.items()}
    f = language_model.Attention(w, np.arange(300), np.zeros(300)).forward(np.arange(64).reshape(2, 32).astype(np.int16), w)
    assert np.allclose(f["attend"].sum(axis=2), 1, atol=1e-4) and not f["attend"][:, ~language_model.SEEN].any()


# 4 fingerprints


def test_fingerprints_ignore_order_and_allow_edits(spark):
    rows = spark.createDataFrame([("a\nb\nc", "c\na\nb", "b", "a\nc", "x\ny\nz", "")], "t string, same string, part string, rest string, far string, none string")
    v = {c: fingerprints.vector(F.col(c)) for c in rows.columns}
    out = rows.select(
        (v["t"] == v["same"]).alias("order"),
        (fingerprints.combined(v["t"], v["part"], remove=True) == v["rest"]).alias("deleted"),
        (fingerprints.combined(v["rest"], v["part"]) == v["t"]).alias("inserted"),
        fingerprints.likeness(v["t"], v["rest"]).alias("near"),
        fingerprints.likeness(v["t"], v["far"]).alias("far"),
        fingerprints.likeness(v["none"], v["none"]).alias("none"),
        fingerprints.likeness(v["t"], v["none"]).alias("half"),
    ).first()
    assert out["order"] and out["deleted"] and out["inserted"]
    assert out["near"] > 0.6 > 0.4 > out["far"]
    assert (out["none"], out["half"]) == (1.0, 0.0)


def test_next_document_wraps_around(messy, empty, docs):
    rows = fingerprints.with_next(messy.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), 4, "text", {"n": F.length("text")})
    found = rows.filter("doc_id IN (4, 7)").collect()
    assert {r["doc_id"]: (r["next_text"][:6], r["next_n"]) for r in found} == {4: ("###  1", 8), 7: (LONG[:6], len(LONG) * 3 + 6)}
    assert rows.count() == len(MESSY)
    assert fingerprints.with_next(empty.select("doc_id", "text"), 4, "text", {}).count() == 0
    one = docs.filter("doc_id = 3").select("doc_id", "text")
    assert fingerprints.with_next(one, 4, "text", {}).filter("text = next_text").count() == 1


# 5 personal data


def test_personal_data_rules(spark, messy, empty):
    texts = ["a.b@c.de, 1.2.3.4 and 999.1.1.1", "card 4111 1111 1111 1111 or 4111-1111-1111-1112", "call +1 (729) 555-7725 10.0.0.1", "12" * 3000 + "@x", "é +49 30 1234567"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: sorted((s["start"], personal_data.KINDS[s["kind"]], s["end"]) for s in r["spans"] if s["rule"]) for r in personal_data.personal_spans(rows).collect()}

    assert spans[0] == [(0, "email", 8), (10, "ip", 17)] and spans[1] == [(5, "card", 24)] and spans[4] == [(2, "phone", 16)]
    clean = by_id(personal_data.redact(messy), "text")
    assert clean[6] == ("Ünïcode ÉTÉ mail [EMAIL] now [PHONE]",)
    assert clean[3] == (None,) and clean[4] == ("",)
    assert personal_data.redact(messy).count() == len(MESSY)
    assert personal_data.personal_spans(empty).count() == 0


@pytest.fixture(scope="module")
def further(spark):
    """Numbers after words of their kind and after other words, well-formed and not, and what to judge."""

    def card(i, good):
        digits = f"4{i * 7919 % 10**14:014d}"
        last = -sum(sum(divmod(2 * int(c), 10)) if k % 2 == 0 else int(c) for k, c in enumerate(reversed(digits))) % 10
        return digits + str(last if good else (last + 1) % 10)

    texts = []
    for i in range(240):
        texts += [f"please call +1 (729) 555-{i:04d} soon", f"order 12-555-{i:04d} shipped", f"visa card {card(i, True)} was used", f"order {card(i, False)} shipped"]
    judged = ["please call 729-555-7725 soon", "order 1234-567-8901 shipped", "visa card 4111 1111 1111 1111 12 was used", "order 4111 1111 1111 1111 12 shipped"]
    judged += ["mail jane.doe [at] example [dot] org. Then we left", "x (at) 3.5", "host 10[.]0[.]0[.]1 is up", "host 1(.)2 (.) 3(.)4 is up", "host 999[.]0[.]0[.]1 is up"]
    rows = spark.createDataFrame(list(enumerate(judged + texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in personal_data.personal_spans(rows).filter("doc_id < 100").collect()}
    return {t: [t[s["start"] : s["end"]] for s in found.get(i, []) if not s["rule"]] for i, t in enumerate(judged)}


def test_trees_judge_numbers_by_context(further):
    assert further["please call 729-555-7725 soon"] == ["729-555-7725"]
    assert further["visa card 4111 1111 1111 1111 12 was used"] == ["4111 1111 1111 1111"]
    assert further["order 1234-567-8901 shipped"] == [] and further["order 4111 1111 1111 1111 12 shipped"] == []


def test_spelt_addresses_are_selected(further):
    assert further["mail jane.doe [at] example [dot] org. Then we left"] == ["jane.doe [at] example [dot] org"]
    assert further["host 10[.]0[.]0[.]1 is up"] == ["10[.]0[.]0[.]1"] and further["host 1(.)2 (.) 3(.)4 is up"] == ["1(.)2 (.) 3(.)4"]
    assert further["x (at) 3.5"] == [] and further["host 999[.]0[.]0[.]1 is up"] == []


# 6 lines


def test_line_dedup_keeps_the_last_holder(spark, messy, empty):
    line = "x" * 39 + "Y"
    rows = spark.createDataFrame([(i, f"a{i}\n {line if i % 2 else line.lower()} \n{line}") for i in range(5)] + [(9, None)], "doc_id long, text string")
    found = by_id(line_dedup.line_dedup(rows), "text", "n_lines", "n_dropped")
    assert found[0] == ("a0", 3, 2) and found[4] == (f"a4\n {line.lower()} \n{line}", 3, 0) and found[9] == ("", 1, 0)
    assert line_dedup.line_dedup(messy).count() == len(MESSY)
    assert line_dedup.line_dedup(empty).count() == 0


# 7 near duplicates


def brute_groups(rows, k, num, den):
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    group = {d: d for d in sets}

    def find(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                group[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("k, num, den", [(4, 85, 100), (5, 4, 5)])
def test_ngram_join_finds_all_links(spark, k, num, den):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = list(rng.choice(vocabulary, 30))
    base = [list(rng.choice(vocabulary, n)) for n in (60, 61, 200, 1500)]
    rows = []
    for i in range(160):
        words = list(base[i % 4])
        for at in rng.integers(0, len(words), rng.integers(0, 3 + len(words) // 60)):
            words[at] = f"e{rng.integers(6)}"
        if i % 5 == 0:
            words = shared + list(rng.choice(vocabulary, 20 + i))
        rows.append((i, " ".join(words)))
    rows += [(500, ""), (501, None), (502, "one two"), (503, "ONE\ttwo"), (504, "one two three four")]
    found = ngram_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k, num, den)
    assert by_id(found, "n_shingles", "component_id") == brute_groups(rows, k, num, den)


def test_ngram_join_of_messy_rows(messy, empty):
    found = ngram_join.near_groups(messy)
    assert found.count() == len(MESSY)
    assert by_id(found.filter("doc_id = 2"), "component_id")[2] == (1,)
    assert ngram_join.near_groups(empty).count() == 0


def test_shingles_cross_no_text():
    sets = shingles.shingle_sets(pa.array(["a b c", None, "A\tb  c d", "c a"]), 2)
    assert [len(s) for s in sets] == [2, 0, 3, 1]
    assert len(np.intersect1d(sets[0], sets[2])) == 2 and sets[3][0] not in sets[0]


def test_components_of_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(101, 100), (102, 100), (7, 7), (None, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(21)}, 100: 100, 101: 100, 102: 100}


def test_fingerprints_of_texts_without_marks(spark):
    rng = np.random.default_rng(3)

    def text(kind):
        if kind == "cjk":
            return "".join(chr(c) for c in rng.integers(0x4E00, 0x9000, 3000))
        if kind == "solid":
            return "".join(chr(c) for c in rng.integers(97, 123, 40_000))
        words = [f"w{i}" for i in rng.integers(0, 5000, 3000)]
        return {"comma": ",", "list": "; ", "blank": " ", "stop": "\u3002"}[kind].join(words)

    rows = []
    for kind in ("comma", "list", "blank", "stop", "cjk", "solid"):
        a, b = text(kind), text(kind)
        n = len(a) // 4
        rows.append((kind, a, a[: len(a) - n] + b[:n], b))
    rows.append(("same words", "lo ra mi " * 3000, "lo ra mi " * 2250 + rows[0][3][:6000], rows[0][3]))
    v = fingerprints.vector
    found = spark.createDataFrame(rows, "kind string, a string, edited string, other string").select(
        "kind", fingerprints.likeness(v(F.col("a")), v(F.col("edited"))).alias("near"), fingerprints.likeness(v(F.col("a")), v(F.col("other"))).alias("far")
    )
    for r in found.collect():
        assert r["near"] > 0.55 and r["far"] < 0.4, r


# 8 licences


def test_license_spans(spark, messy, empty):
    texts = ["Released under the MIT License.", "Licensed under the Apache licence, Version 2.0", "x cc by y CC-BY", "permission is hereby granted, free of ANY charge, to any person obtaining a copy of this software and associated files", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_words"], sorted((s["label"], s["phrase"], s["start"]) for s in r["spans"])) for r in licenses.scan(rows).collect()}
    assert found[0] == (5, [("mit", False, 0), ("mit", True, 3)])
    assert found[2] == (6, [("cc-by", True, 1), ("cc-by", True, 4)])
    assert found[3][1] == [("mit", False, 0)]
    assert found[4] == (0, [])
    assert licenses.scan(messy).count() == len(MESSY) and licenses.scan(empty).count() == 0


def test_repeated_short_notices_are_found(spark):
    rows = spark.createDataFrame([(k, "all rights reserved " * k) for k in range(1, 5)], "doc_id long, text string")
    found = {r["doc_id"]: sorted(s["start"] for s in r["spans"] if s["label"] == "all-rights-reserved") for r in licenses.scan(rows).collect()}
    assert found == {k: [3 * i for i in range(k)] for k in range(1, 5)}


# 9 pieces


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.load(public_tokenizers.path("piece_bpe_32k.model"))


def test_viterbi_finds_the_best_path(model):
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    score = {file.id_to_piece(i): file.get_score(i) for i in range(259, file.get_piece_size())}

    def best(word: str) -> float:
        top = [0.0] + [-math.inf] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                piece = word[start:end]
                value = score.get(piece, model.unknown if end - start == 1 else -math.inf)
                top[end] = max(top[end], top[start] + value)
        return top[-1]

    words = [" the", "entebest", " Éçeau", " hypothesis", " 12345", "日本語", " x" * 1, "a" * 90]
    for word, ids in zip(words, model.encode_words(words)):
        plain = [i for i in ids if i >= 259]
        unknown = len(b"".join(model.content[i] for i in ids if i < 259).decode())
        assert sum(model.score[plain]) + unknown * model.unknown == pytest.approx(best(word.replace(" ", pieces.MARK)))
        assert b"".join(model.content[i] for i in ids).decode() == word


def test_pieces_round_trip(model, messy, empty):
    rows = messy.withColumn("ids", pieces.encode(model, F.col("text"))).withColumn("back", pieces.decode(model, F.col("ids")))
    assert rows.filter("coalesce(text, '') <> back").count() == 0
    assert empty.withColumn("ids", pieces.encode(model, F.col("text"))).count() == 0


# 10 neighbours


def test_neighbours_recall(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    found = neighbours.nearest(vectors, F.col("id") % 5 == 0, k=10).collect()
    table = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in vectors.collect()}
    ids = np.array(sorted(table))
    x = np.stack([table[i] for i in ids])
    hits = 0
    for q in ids[ids % 5 == 0]:
        product = (x * table[q]).sum(axis=1)
        true = [i for i in ids[np.lexsort((ids, -product))] if i != q][:10]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, 11))
        assert all(s == pytest.approx(table[i] @ table[q]) for _, i, s in own)
        hits += len({i for _, i, _ in own} & set(true))
    assert hits >= 0.9 * 10 * np.count_nonzero(ids % 5 == 0)


def test_neighbours_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (3, [0.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in neighbours.nearest(vectors, F.col("id") <= 1, k=5).collect()}
    assert found == {(0, 1): (1, 1.0), (0, 2): (2, 1.0), (0, 3): (3, 0.0), (1, 1): (0, 1.0), (1, 2): (2, 1.0), (1, 3): (3, 0.0)}
    assert neighbours.nearest(vectors.filter("vec_id = 4"), F.col("id") >= 0).count() == 0


# pipeline


def test_pipeline_stages(spark, docs, tmp_path):
    rows, seen = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, SMALL).write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
        seen.append(rows.count())
        if name != "best_fit_packing":
            assert rows.columns == docs.columns
        if name == "line_dedup":
            before = [(r["doc_id"], r["text"]) for r in rows.collect()]
        if name == "ngram_jaccard_join":
            groups = brute_groups(before, 5, 4, 5)
            assert {r["doc_id"] for r in rows.collect()} == {d for d, (_, g) in groups.items() if d == g}
        if name == "personal_data":
            assert not [t for (t,) in rows.select("text").collect() if re.search(r"[a-z0-9]@[a-z0-9]+\.[a-z]", t)]
            last = rows.count()
    assert seen[1] == seen[2] == seen[0]
    assert rows.select("doc_id").distinct().count() == last


def test_held_out_rows_follow_the_contract(docs):
    from labelkit.llm.queries_documents import held_out

    found = by_id(docs.select("doc_id", held_out(5).alias("h")), "h")
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, (h,) in found.items())
