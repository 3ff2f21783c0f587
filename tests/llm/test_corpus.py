"""Resampling, source divergence and chat formatting against brute force and round trips."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labelkit.llm import chat, common, divergence, importance, language, line_dedup, neighbours, packing, personal_data, pieces
from labelkit.llm.common import encode_column

MESSY = [
    (1, "Hello hello WORLD, été ÉTÉ x9", "en", "a"),
    (1, "Hello hello WORLD, été ÉTÉ x9", "en", "a"),
    (2, None, "en", None),
    (3, "", None, "b"),
    (4, "### 12 !!", "en", "b"),
    (None, "hello world again " * 30, "en", "b"),
    (5, "one two three " * 40, "en", "a"),
    (6, "one two hello " * 2000, "de", "a"),
    (7, "w" * 70_000 + " tail", "de", "c"),
    (8, "one two three " * 40, "en", "c"),
    (9, "hello one", "de", "a"),
    (10, "hello one world", "de", "b"),
]


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(*r, "clash", 1, 2, 3.0) for r in MESSY]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, features string, weight int, g int, rank double").repartition(3)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "hello world hello"), (2, None), (3, "")], "item_id long, text string")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def test_registers_of_long_data():
    crc = importance.Crc()
    data = np.random.default_rng(1).integers(0, 256, 2_500_000, dtype=np.uint8)
    places = np.array([0, 0, 1, 1023, 1024, 1025, 1 << 20, (1 << 20) + 1, 2_000_000, len(data), len(data)])
    registers = crc.prefixes(data, places)
    for i in range(len(places)):
        for j in range(i, len(places)):
            length = np.array([places[j] - places[i]])
            assert crc.runs(registers[[i]], registers[[j]], length)[0] == zlib.crc32(data[places[i] : places[j]].tobytes())


@pytest.mark.parametrize("longest", [1, 3])
def test_features_of_texts(longest):
    texts = [r[1] or "" for r in MESSY]
    n_words, n_features, found = importance.Features(longest, 10_000).of([t.encode() for t in texts])
    every = []
    for text, n, total in zip(texts, n_words, n_features):
        own = words(text)
        runs = [" ".join(own[i : i + k]) for k in range(1, longest + 1) for i in range(len(own) - k + 1)]
        assert (n, total) == (len(own), len(runs))
        every += [zlib.crc32(r.encode()) % 10_000 for r in runs]
    assert found.tolist() == every


def brute_resample(rows, target, percent, least, buckets):
    own = [[zlib.crc32(w.encode()) % buckets for w in words(r[1])] for r in rows]
    s, t = Counter(b for x in own for b in x), Counter(zlib.crc32(w.encode()) % buckets for x in target for w in words(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for r, x in zip(rows, own):
        gains = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in x]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[3], -1 if x[0] is None else x[0]))
    drawn = able[: percent * len(able) // 100]
    return sorted([(*x, i + 1) for i, x in enumerate(drawn)] + [(*x, None) for x in able[len(drawn) :] + [x for x in out if x[1] < least]], key=str)


def test_resample(messy, target):
    found = importance.resample(messy, target, percent=50, least_words=3)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_resample(MESSY, ["hello world hello"], 50, 3, 10_000)


def test_resample_without_rows(messy, target):
    none = messy.filter("doc_id = -1")
    assert importance.resample(none, target).count() == 0
    alone = importance.resample(messy, target.filter("item_id < 0"), percent=100, least_words=0)
    assert sorted(r["rank"] for r in alone.collect()) == list(range(1, len(MESSY) + 1))


def test_wide_buckets_and_long_runs(messy, target):
    found = importance.resample(messy, target, longest=2, buckets=100_000)
    sizes = {r["doc_id"]: r["n_features"] for r in found.collect()}
    assert sizes[6] == 2 * 6000 - 1 and sizes[4] == 1 and sizes[7] == 3


def brute_audit(rows, least=3, limit=200):
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(r[1]))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        df = Counter(t for d in here for t in set(d[2]))
        kept = [t for t in df if df[t] >= least]
        counts = defaultdict(Counter)
        for _, source, found in here:
            counts[source].update(t for t in found if df[t] >= least)
        whole = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for a in counts:
            pairs = [(sum((share(counts[a], t) - share(counts[b], t)) ** 2 // share(counts[b], t) for t in kept), b) for b in counts if b != a]
            terms = [((share(counts[a], t) - share(whole, t)) ** 2 // share(whole, t), t) for t in kept if counts[a][t] and share(counts[a], t) > share(whole, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, a, part, item, value, i + 1) for i, (value, item) in enumerate(ranked) if part == "pair" or i < limit]
    return sorted(out)


@pytest.mark.parametrize("least,limit", [(1, 200), (2, 1), (3, 200), (50, 200)])
def test_audit(messy, least, limit):
    found = divergence.audit(messy, least_docs=least, limit=limit)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute_audit(MESSY, least, limit)


def test_audit_of_many_groups_in_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [
        (i, " ".join(f"t{chr(97 + int(t) % 26)}{chr(97 + int(t) // 26)}" for t in rng.zipf(1.3, 40) % 600), "xy"[i % 2], f"s{int(rng.integers(0, 30))}")
        for i in range(400)
    ]
    for name, value in (("BLOCK", 64), ("PRODUCTS", 50), ("HELD_TERMS", 100)):
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit(docs).collect())) == brute_audit(rows)


def test_audit_without_rows(messy):
    assert divergence.audit(messy.filter("doc_id = -1")).count() == 0


def test_audit_refuses_more_groups_than_it_can_pair(messy, monkeypatch):
    monkeypatch.setattr(divergence, "MOST_GROUPS", 2)
    with pytest.raises(ValueError, match="more than 2 groups"):
        divergence.audit(messy)


def test_shares_of_large_counts():
    n = np.array([0, 1, 10**13, 10**15 - 1], dtype=np.int64)
    d = np.array([7, 2, 3 * 10**13 + 1, 10**15], dtype=np.int64)
    assert divergence.share(n, d).tolist() == [1 + 10**9 * (int(a) + 1) // int(b) for a, b in zip(n, d)]


PARTS = f"conv_id long, turn long, role string, parts array<{chat.PART}>, formatted string, loss int"


def text(t):
    return ("text", t, None, None, None, None, None)


def part(kind, ref, width=None, height=None, seconds=None, pages=None):
    return (kind, None, ref, width, height, seconds, pages)


CHATS = [
    (1, 0, "user", [text("Look: <image 0> \\l \\"), part("image", "a.png", 57, 28), part("audio", "b.wav", seconds=2.01), text(""), text("é𝄞>\n")]),
    (1, 1, "assistant", [text("### Assistant: </turn>\n"), part("document", "c.pdf", pages=3)]),
    (1, 2, "assistant", [text("again")]),
    (2, None, None, None),
    (2, 0, "user", []),
    (2, 0, "user", []),
    (3, 5, "assistant", [text(None), None, part("image", None)]),
    (None, 0, "tool>\n<x", [text("no id")]),
    (4, 1, "assistant", [text("second " * 20_000)]),
    (4, 0, "user", [text("first")]),
]


@pytest.fixture(scope="module")
def formatted(spark):
    messages = spark.createDataFrame([(*r, "clash", 1) for r in CHATS], PARTS)
    return {r["conv_id"]: r for r in chat.format_conversations(messages).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "read", F.transform("turns", lambda t: chat.read_parts(t["body"]))).withColumn("learnt", chat.masked_text(F.col("formatted"), F.col("loss"))).collect()}


def test_conversations_are_read_back(formatted):
    assert set(formatted) == {1, 2, 3, 4, None}
    first = formatted[1]
    assert [t["role"] for t in first["turns"]] == ["user", "assistant", "assistant"]
    assert [[tuple(p) for p in x] for x in first["read"]] == [
        [("Look: <image 0> \\l \\", None, None), (None, "image", 0), (None, "audio", 1), ("é𝄞>\n", None, None)],
        [("### Assistant: </turn>\n", None, None), (None, "document", 2)],
        [("again", None, None)],
    ]
    assert [t["role"] for t in formatted[2]["turns"]] == ["", "user", "user"] and formatted[2]["read"] == [[], [], []]
    assert formatted[None]["turns"][0]["role"] == "tool>\n<x"
    assert [x[0]["text"] for x in formatted[4]["read"]] == ["first", "second " * 20_000]


def test_attachments_and_their_tokens(formatted):
    first = formatted[1]
    got = [(a["number"], a["kind"], a["ref"], a["turn"], a["tokens"]) for a in first["attachments"]]
    assert got == [(0, "image", "a.png", 0, 3), (1, "audio", "b.wav", 0, 51), (2, "document", "c.pdf", 1, 1536)]
    for a in first["attachments"]:
        assert first["formatted"][a["place"] :].startswith(f"<{a['kind']} {a['number']}>")
    assert first["text_tokens"] == len("Look: <image 0> \\l \\ é𝄞> ### Assistant: </turn> again".split())
    assert first["expanded_tokens"] == first["text_tokens"] + 3 + 51 + 1536
    assert formatted[3]["attachments"][0]["tokens"] == 256 and formatted[2]["expanded_tokens"] == 0


def test_loss_covers_what_the_assistant_says(formatted):
    first = formatted[1]
    spans = [first["formatted"][s["start"] : s["end"]] for s in first["loss"]]
    assert spans == [chat.escape("### Assistant: </turn>\n") + "<document 2>", "again"]
    assert formatted[4]["learnt"] == "second " * 20_000
    assert formatted[2]["loss"] == [] and formatted[2]["learnt"] == ""


def test_every_control_string_survives(spark):
    hard = ["\\", "<", ">", "\\s", "\\l", "\\\\s", "</turn>\n", "<turn user>\n", "\\### Assistant: </turn> ok", "<image 0>", "a\\<b>\\g", "\n>\n", "\0", "𝄞" * 3]
    every = [a + b for a in hard for b in hard]
    rows = spark.createDataFrame([(i, 0, "assistant", [text(t)]) for i, t in enumerate(every)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    done = chat.format_conversations(rows).withColumn("learnt", chat.masked_text(F.col("formatted"), F.col("loss")))
    found = done.select("conv_id", "learnt", chat.read_parts(F.get(chat.read_turns(F.col("formatted")), F.lit(0))["body"]).alias("parts"), "formatted")
    for r in found.collect():
        assert r["learnt"] == every[r["conv_id"]]
        assert [p["text"] for p in r["parts"]] == [every[r["conv_id"]]]
        assert r["formatted"].count("<turn ") == r["formatted"].count("</turn>\n") == 1


def test_unknown_kinds_and_empty_tables(spark):
    schema = f"conv_id long, turn long, role string, parts array<{chat.PART}>"
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(Exception, match="no such kind of part"):
        chat.format_conversations(spark.createDataFrame([(1, 0, "user", [part("video", "x")])], schema)).collect()


def test_search_goes_on_until_no_bin_improves():
    lengths = np.random.default_rng(0).integers(1000, 1700, 2000)
    bins = packing.best_fit(lengths, 4096)
    found = packing.local_search(bins, lengths, 4096)
    assert sorted(k for b in found for k in b) == list(range(2000)) and max(lengths[b].sum() for b in found) <= 4096
    assert len(found) <= 0.94 * len(bins)
    again = packing._Open([b for b in found if lengths[b].sum() < 4096], lengths, 4096)
    if again.capacity * len(again.fill) - again.fill.sum() >= 4096 and len(again.piece) <= packing.BLOCK_PIECES:
        assert not any(again.improve(a) for a in range(len(again.fill)))


def test_underfull_bins_of_many_groups_meet(spark):
    sizes = [int(n) for n in np.random.default_rng(1).integers(1000, 1700, 3000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, length long")
    whole = packing.pack(pieces).select("sequence_id").distinct().count()
    parted = packing.pack(pieces, group_pieces=250)
    rows = parted.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert sum(r["n"] for r in rows) == sum(sizes) and all(r["n"] == r["end"] <= 4096 for r in rows)
    assert len(rows) <= 1.03 * whole


def test_words_are_encoded_as_in_their_text():
    from tokenizers import Tokenizer

    odd = ["'s 's. don't!'s x.'s ..., a,b.c 1.5 ÉTÉ İx Σας ΣΑΣ é ﬁ \x01 , . ,.  x\u0085y\x1cz", None, "", "A" * 5000 + " b.", "it's,fine. It'S", "…. „a”. ≠ .", "क़ख़ ज़"]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [plain.encode(t or "", add_special_tokens=False).ids for t in odd]
    cache = packing.word_cache.__wrapped__(public_tokenizers.path("word_bpe_49k.json"))
    for limit in (690_000, 3):
        cache.limit = limit
        for _ in range(3):
            ids, counts = encode_column(cache, pa.array(odd))
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected
    assert len(cache.index) < 100


def test_scan_finds_all_within_a_bound_and_leaves_out_the_own_row():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 24))
    x[100:400] = x[100]  # a large group of copies
    ids = rng.permutation(900).astype(np.int64)
    rotation = np.linalg.qr(rng.standard_normal((25, 25)))[0]
    index = neighbours.Index(float((x * x).sum(axis=1).max()), rotation, np.zeros((1, 25)), 1)
    some = np.array([100, 101, 5, 800, 333])
    exact = [sorted(((-float((x[j] * x[i]).sum()), int(ids[j])) for j in range(900) if j != i)) for i in some]
    for k in (1, 20):
        score = np.array([-e[k - 1][0] for e in exact])
        for bound in (None, score, np.where(np.arange(5) % 2, score, np.nan)):
            row, found, own = neighbours.scan_block(index, x, ids, x[some], ids[some], k, bound)
            for i, e in enumerate(exact):
                got = list(zip((-own[row == i]).tolist(), found[row == i].tolist()))
                assert len(got) == k and [g for _, g in got] == [g for _, g in e[:k]], (k, i)


def test_neighbours_within_a_large_group_of_copies(spark):
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(150)] + [(i, [math.sin(i), math.cos(i), 0.0]) for i in range(150, 400)] + [(7, [1.0, 2.0, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(vectors, F.col("id") % 50 == 0, k=5).collect()
    own = {q: [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 50, 100)}
    assert own == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4]}
    assert len(found) == 8 * 5


def test_pieces_recode(spark):
    model = pieces.PieceModel.load(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["", "plain words", "  two  spaces ", "tab\tand\nline", "日本語 x" * 50, "a" * 300, None, "é𝄞 \x01"]
    docs = spark.createDataFrame([(i, t, [9]) for i, t in enumerate(texts)] + [(1, "plain words", [9])], "doc_id long, text string, ids array<int>")
    found = pieces.recode(model, docs).collect()
    assert sorted(r["doc_id"] for r in found) == sorted([*range(len(texts)), 1])
    assert all(r["same"] == (texts[r["doc_id"]] is not None) for r in found)
    assert all((r["ids"] == []) == (not texts[r["doc_id"]]) for r in found)
    ids = {r["doc_id"]: r["ids"] for r in docs.select("doc_id", pieces.encode(model, F.col("text")).alias("ids")).collect()}
    assert all(ids[r["doc_id"]] == r["ids"] for r in found)
    assert pieces.recode(model, docs.filter("doc_id < 0")).count() == 0


LONG = "the quick brown fox jumps over the lazy dog while nobody looks at the sky "


def test_one_row_of_each_group_stays(spark):
    rows = [
        (5, LONG + "a b c"), (5, LONG + "a b c"), (7, LONG + "a b c"), (None, LONG + "a b c"),
        (9, "wholly other words that stand in no other text at all"), (9, "wholly other words that stand in no other text at all"),
        (None, "only rows without an id have these words in them"), (None, "only rows without an id have these words in them"),
        (11, ""), (11, ""), (None, None), (None, None), (12, "###"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    found = Counter((r["doc_id"], (r["text"] or "")[:6]) for r in kept.collect())
    assert found == {(5, "the qu"): 1, (9, "wholly"): 1, (None, "only r"): 1, (11, ""): 2, (None, ""): 2, (12, "###"): 1}


def test_a_language_of_few_long_texts_is_learnt(spark):
    english, german = "this is the house of the old man and the sea ", "das ist das haus und der alte mann am meer "
    rows = [(i, english * 3000, "en") for i in (1, 2)] + [(i, german * 3, "de") for i in range(10, 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for shift in (0, 1000, 5000):
        model = language.fit(docs.withColumn("doc_id", F.col("doc_id") + shift), sample_chars=2_000)
        assert model.languages == ["de", "en"]


def test_columns_with_the_names_of_helpers(spark):
    names = ["__doc", "__text", "__dropped", "__hash", "__spans", "__ppm"]
    rows = [(i, f"{LONG}\nmail me at a{i}@b.org", *["x"] * len(names)) for i in range(6)]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in names]]))
    deduped = line_dedup.line_dedup(docs)
    assert [r["n_dropped"] for r in deduped.orderBy("doc_id").collect()] == [1] * 5 + [0]
    assert set(names) <= set(deduped.columns)
    clean = personal_data.redact(docs)
    assert clean.columns == docs.columns and clean.filter("text LIKE '%[EMAIL]%' AND __doc = 'x' AND __spans = 'x'").count() == 6
    named = language.identify(docs, None)
    model = language.fit(docs.withColumn("lang", F.lit("en")))
    assert language.identify(docs, model).filter("__ppm = 'x' AND lang_pred = 'en'").count() == 6 and "__ppm" in named.columns


def base_spans(text):
    """The fixed rules in ``re``."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def middle(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(4)


def test_personal_data_of_a_whole_table(middle):
    found = {r["doc_id"]: r["spans"] for r in personal_data.personal_spans(middle).collect()}
    added = 0
    for doc, text in middle.collect():
        spans = found.get(doc, [])
        assert sorted((s["start"], s["kind"], s["end"]) for s in spans if s["rule"]) == base_spans(text or ""), doc
        for s in spans:
            if not s["rule"]:
                value = text[s["start"] : s["end"]]
                added += 1
                assert personal_data.ALL_KINDS[s["kind"]] == "secret" and sum(c.isdigit() for c in value) >= 3, value
        announced = {m.group(1) for m in re.finditer(r"(?:token = \"|password=)([0-9a-f]{16,})", text or "")}
        assert announced <= {text[s["start"] : s["end"]] for s in spans}
    assert added >= 10


def test_trees_decide_on_what_is_added(middle):
    spans = personal_data.candidates(middle).cache()
    model = personal_data.fit(spans)
    assert model.trees is not None and model.thresholds[personal_data.SECRET] >= 0.5

    def added(m):
        every = personal_data.chosen(spans, m).select("doc_id", F.explode("spans").alias("s")).filter("NOT s.rule")
        return {(r["doc_id"], r["s"]["start"], r["s"]["kind"]) for r in every.collect()}

    own = added(model)
    assert own and not added(personal_data.SpanModel(None, {}))
    everything = added(personal_data.SpanModel(None, {k: 0.0 for k in range(len(personal_data.ALL_KINDS))}))
    assert own < everything  # proposals that pass their check and that the trees refuse


def test_trees_learn_from_every_labelled_span(spark, monkeypatch):
    n = 60_000
    rows = spark.range(2 * n).select(
        F.col("id").alias("doc_id"), F.col("id").alias("text_hash"), F.lit(1).alias("kind"), F.lit(9).alias("start"), F.lit(16).alias("end"), F.lit(True).alias("rule"),
        F.lit("1.2.3.4").alias("value"), F.when(F.col("id") < n, "host is ").otherwise("version ").alias("before"), F.lit(" ").alias("after"), (F.col("id") < n).alias("valid"),
    )
    written, write = {}, personal_data.stage_table
    monkeypatch.setattr(personal_data, "stage_table", lambda df, name: written.setdefault(name, write(df, name)))
    personal_data.fit(rows)
    (learnt,) = written.values()
    own = F.col("n") if "n" in learnt.columns else F.lit(1)
    assert {r["label"]: r["spans"] for r in learnt.groupBy("label").agg(F.sum(own).alias("spans")).collect()} == {1.0: n, 0.0: n}
    assert learnt.count() <= 8  # two kinds of context in four folds


def test_languages_are_learnt_from_whole_texts_of_all_documents(spark):
    rows = [(i, f"word{i % 10} zq{i:04d}", "en" if i % 2 else "de") for i in range(400)]
    docs = spark.createDataFrame([(9000, "x" * 2_000_000 + " qqqq", "en"), *rows], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    last = model.order
    for text in ["zq0001", "zq0198", "zq0399", "x qqqq"]:
        key = int.from_bytes(text[-last - 1 :].encode())
        assert model.grams[last].find(np.array([key], dtype=np.uint64))[0] >= 0, text
    # every byte and every end of a text counts once, however rows are cut into batches and partitions
    again = language.fit(docs.repartition(7))
    for a, b in zip([*model.cost, *model.escape], [*again.cost, *again.escape]):
        assert np.array_equal(a, b)


def test_a_language_model_of_bounded_size_keeps_the_frequent_strings(spark):
    docs = spark.createDataFrame([(i, "the house the house" if i < 50 else f"q{i}z{i * 7919}", "en") for i in range(100)], "doc_id long, text string, lang string")
    whole, few = language.fit(docs), language.fit(docs, most_strings=120)
    held = lambda m: sum(len(c) for c in m.cost)
    assert held(few) <= 120 < held(whole)
    texts = [b"the house", b"unseen 99z"]
    assert np.isfinite(few.bits(texts)).all() and abs(few.bits(texts)[0, 0] - whole.bits(texts)[0, 0]) < 8


def test_components_digest_each_state_once(spark, monkeypatch):
    calls, digest, stage = [], common._digest, common.stage_table
    monkeypatch.setattr(common, "_digest", lambda links: calls.append("digest") or digest(links))
    monkeypatch.setattr(common, "stage_table", lambda df, name: calls.append(name) or stage(df, name))
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8)], "a long, b long")
    assert {r["node"]: r["component"] for r in common.components(links).collect()} == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}
    assert calls.count("digest") == 1 + calls.count("small-star")


def test_components_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    calls, stage = [], common.stage_table
    monkeypatch.setattr(common, "stage_table", lambda df, name: calls.append(name) or stage(df, name))
    chain = [(i, i + 1) for i in range(3000) if i % 1000 != 999]
    links = spark.createDataFrame([*chain, *chain, (5, 5), (None, 4)], "a long, b long").repartition(5)
    found = {r["node"]: r["component"] for r in common.components(links).collect()}
    assert found == {i: i // 1000 * 1000 for i in range(3000)}
    assert calls.count("small-star") <= 2


def test_local_stars_keep_components_whatever_a_task_holds(spark):
    rng = np.random.default_rng(3)
    pairs = {(int(max(p)), int(min(p))) for p in rng.integers(0, 400, (330, 2)) if p[0] != p[1]}
    links = spark.createDataFrame(sorted(pairs), "a long, b long").repartition(3)
    want = {r["node"]: r["component"] for r in common.components(links).collect()}
    best = {n: n for p in pairs for n in p}
    for _ in best:
        for a, b in pairs:
            best[a] = best[b] = min(best[a], best[b])
    assert want == best
    for most in (1, 7, 1 << 20):
        again = common._local_stars(links, most)
        assert all(r["a"] > r["b"] for r in again.collect())
        assert {r["node"]: r["component"] for r in common.components(again).collect()} == best
