"""Personal data: generators propose spans, boosted trees score them, thresholds select.

Everything that touches a text is a SQL expression on its row; candidates are few and
narrow.  Spans are found without Python by laying the matches of a pattern between the gaps
that ``split`` leaves.  Repeated groups are possessive, so that a long run of digits costs linear
time and no stack.

Spans that satisfy a kind's fixed rule are always kept.  The generators also propose what
the rules' greedy matches miss, such as a number inside a longer chain, and a kind without a
rule: secrets, long runs of letters and digits.  Those must pass the check of their kind,
and trees judge them by their context and format.

Labels and features of a kind are kept apart.  Numbers and addresses are labelled by their
check, against near misses that fail it or are part of a longer word; the trees see the
context, and of a phone number the marks in it.  Secrets are labelled by their context, what
is assigned to a name of a secret, against long words of other shapes; the trees see their
format only, and so find those that nothing announces.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import bind, unused
from labelkit.session import stage_table

# Kinds in their order, and the alphabets of the rules.
KINDS = ["email", "ip", "card", "phone"]
#: All kinds; those behind the ones with a rule are found by the trees alone.
ALL_KINDS = [*KINDS, "secret"]
SECRET = len(KINDS)
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
CHAIN = "[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# Further candidates of the generators.
EMAIL_SPELT = r"(?i)[a-z0-9_+-]{1,64}(?:\.[a-z0-9_+-]{1,64}){0,5} ?[\[(] ?at ?[\])] ?[a-z0-9-]{1,63}(?:(?:\.| \. | ?[\[(] ?dot ?[\])] ?)[a-z0-9-]{1,63}){1,5}"
IP_SPELT = r"(?<![0-9])[0-9]{1,3}(?: ?[\[(]\.[\])] ?[0-9]{1,3}){3}(?![0-9])"
# How the signs of an address are spelt, and what it must be when they are written out.
SPELT_AT = r"(?i) ?[\[(] ?at ?[\])] ?"
SPELT_DOT = r"(?i) ?[\[(] ?(?:\.|dot) ?[\])] ?| \. "
ADDRESS = r"(?i)^(?=.{6,254}$)[a-z0-9_+-]+(?:\.[a-z0-9_+-]+)*@(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,63}$"
CARD_PART = r"(?<!\w)(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4})(?!\w)"
PHONE_PART = r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{4}(?!\w)"

DIGIT_RUN = r"(?<![0-9])[0-9]{7,19}+(?![0-9])"
LONG_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,512}+(?![A-Za-z0-9+/_@-])"
# What names a secret in front of its value.
ASSIGNED = r"(?i)(?:token|passw(?:or)?d|pwd|secret|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential)s?[\"']?[ \t]*[=:][ \t]*[\"']?$"

SPAN = "array<struct<kind:int,start:int,end:int,value:string,rule:boolean>>"
#: Kinds, context and format: what decides on the label of a kind is not among the features that it has.
CONTEXT = ["k1", "k2", "k3", "own_word", "number_word", "touch_before", "touch_after", "colon_before", "open_before", "sign_before", "line_start", "letters_before", "digits_before", "digits_after", "stop_after", "marks"]
FORMAT = ["digit_share", "upper_share", "vowel_share", "turns", "size"]
#: Words before a span that name its kind, by kind, and those that name another number.
WORDS = ["mail|contact|write", "ip|host|addr|server|ping", "card|visa|credit|debit|pay|amex", "tel|phone|call|fax|mobil|cell|ring|dial|whatsapp"]
NUMBER_WORDS = "order|invoice|part|item|article|serial|ticket|batch|case|tracking|model|version|isbn|issn|sku|ref|code|id|no|nr|num|number|#"
#: Kinds whose further generators ask for signs in brackets.
ADDRESSES = [0, 1]


def found(text: Column, pattern: str, kind: int, rule: bool) -> Column:
    """All leftmost matches in ``text`` as spans."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(F.split(text, pattern).alias("gap"), matches.alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), SPAN).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.length(F.coalesce(pair["hit"], F.lit("")))
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), pair["hit"].alias("value"), F.lit(rule).alias("rule"))
        return F.struct(end.alias("at"), F.when(pair["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    return F.aggregate(zipped, start, step, lambda acc: acc["out"])


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def letters_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^A-Za-z]", "")


def turns(value: Column) -> Column:
    """How often letters and digits follow each other."""
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[^A-Za-z0-9]", ""), "[0-9]+", "0"), "[A-Za-z]+", "a")
    return F.length(kinds)


def luhn(digits: Column) -> Column:
    """Whether the sum of the digits, every second one from the right doubled, ends in 0."""

    def part(c: Column, i: Column) -> Column:
        d = F.ascii(c) - 48
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    parts = F.transform(F.split(F.reverse(digits), ""), part)
    return F.aggregate(parts, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(kind: Column, value: Column) -> Column:
    """The check of each kind beyond its pattern; a plain e-mail has none."""
    digits = digits_of(value)
    n = F.length(digits)
    return (
        F.when(kind == 0, F.contains(value, F.lit("@")) | F.regexp_replace(F.regexp_replace(value, SPELT_AT, "@"), SPELT_DOT, ".").rlike(ADDRESS))
        .when(kind == 1, F.regexp_replace(value, SPELT_DOT, ".").rlike(OCTETS))
        .when(kind == 2, F.when((n >= 14) & (n <= 19), luhn(digits)).otherwise(False))
        .when(kind == SECRET, (n >= 3) & (F.length(letters_of(value)) >= 3) & (turns(value) >= 4))
        .otherwise((n >= 10) & (n <= 15))
    )


def proposals(text: Column) -> Column:
    """Spans of all generators for one text; patterns run only where a cheap test lets them."""
    none = F.from_json(F.lit("[]"), SPAN)

    def if_like(test: Column, spans: Column) -> Column:
        return F.when(test, spans).otherwise(none)

    quad = text.rlike(r"[0-9]\.[0-9]")
    # unless it begins with a plus, a number of any kind has nine digits, blanks or marks in a row
    number = text.rlike(r"[0-9][0-9 ().-]{8}")
    return F.concat(
        if_like(F.contains(text, F.lit("@")), found(text, EMAIL, 0, True)),
        if_like(quad, found(text, IP, 1, True)),
        if_like(text.rlike("[0-9][0-9 -]{12}"), found(text, CHAIN, 2, True)),
        if_like(text.rlike(r"\+[0-9]"), found(text, PHONE, 3, True)),
        if_like(text.rlike(r"(?i)[\[(] ?at ?[\])]"), found(text, EMAIL_SPELT, 0, False)),
        if_like(text.rlike(r"[0-9] ?[\[(]\.[\])]"), found(text, IP_SPELT, 1, False)),
        if_like(number, found(text, CARD_PART, 2, False)),
        if_like(number, found(text, PHONE_PART, 3, False)),
        if_like(text.rlike("[0-9]{7}"), found(text, DIGIT_RUN, 3, False)),
        if_like(text.rlike("[A-Za-z0-9+/_-]{16}"), found(text, LONG_RUN, SECRET, False)),
    )


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per proposed span with its check and context; ``text_hash`` tells rows of one id apart."""
    source = F.coalesce(F.col(text), F.lit(""))
    hasty = source.rlike(r"[0-9@]|(?i)[\[(] ?at ?[\])]|[A-Za-z0-9+/_-]{16}")
    # the text itself goes on only where something was proposed
    rows = docs.select("doc_id", F.xxhash64(source).alias("text_hash"), source.alias("__text")).filter(hasty)
    spans = rows.select("doc_id", "text_hash", "__text", F.explode(bind(F.col("__text"), proposals)).alias("s"))
    return spans.select(
        "doc_id",
        "text_hash",
        "s.kind",
        "s.start",
        "s.end",
        "s.rule",
        "s.value",
        F.substr("__text", F.greatest(F.col("s.start") - 23, F.lit(1)), F.least(F.col("s.start"), F.lit(24))).alias("before"),
        F.substr("__text", F.col("s.end") + 1, F.lit(4)).alias("after"),
    ).withColumn("valid", valid(F.col("kind"), F.col("value")))


def with_features(spans: DataFrame) -> DataFrame:
    """``CONTEXT``, which the trees of numbers and addresses see, and ``FORMAT``, which those of secrets see."""
    kind, before, after, value = F.col("kind"), F.col("before"), F.col("after"), F.col("value")
    n = F.length(value)
    own = F.lit(False)
    for k, words in enumerate(WORDS):
        own = own | ((kind == k) & before.rlike(rf"(?i)\b(?:e-?)?(?:{words})[^\n]{{0,12}}$"))
    number = {
        "k1": kind == 1,
        "k2": kind == 2,
        "k3": kind == 3,
        "own_word": own,
        "number_word": before.rlike(rf"(?i)(?<![a-z])(?:{NUMBER_WORDS})s?(?![a-z])[^\n]{{0,12}}$"),
        "touch_before": before.rlike(r"\w$"),
        "touch_after": after.rlike(r"^\w"),
        "colon_before": before.rlike(r":[ \t]*$"),
        "open_before": before.rlike(r"[(\[{<\"'][ \t]*$"),
        "sign_before": before.rlike(r"[#=/_*-][ \t]*$"),
        "line_start": before.rlike(r"(?:^|\n)[ \t]*$"),
        "letters_before": F.length(F.regexp_replace(before, "[^A-Za-z]", "")),
        "digits_before": F.length(digits_of(before)),
        "digits_after": F.length(digits_of(after)),
        "stop_after": after.rlike(r"^(?:[.,;!?)]|\s*$)"),
        "marks": F.when(kind == 3, F.length(F.regexp_replace(value, "[^ ().-]", ""))),
    }
    secret = {
        "digit_share": F.length(digits_of(value)) / n,
        "upper_share": F.length(F.regexp_replace(value, "[^A-Z]", "")) / n,
        "vowel_share": F.length(F.regexp_replace(value, "[^AEIOUYaeiouy]", "")) / n,
        "turns": turns(value) / n,
        "size": n,
    }
    return spans.withColumns({f"f_{k}": F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in (number | secret).items()})


def _assembled(spans: DataFrame, names: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=[f"f_{k}" for k in names], outputCol="features").transform(spans)


def _families() -> list[tuple[Column, list[str], int]]:
    """Kinds with trees of their own: which spans, their features, and the rounds of boosting."""
    secret = F.col("kind") == SECRET
    return [(~secret, CONTEXT, 8), (secret, FORMAT, 4)]


@dataclass
class SpanModel:
    """Boosted trees and, for each kind, the score from which held-out spans are nearly all right; 0 takes all that pass."""

    trees: list | None  # in the order of ``_families``; None for one that could not be fitted
    thresholds: dict[int, float]


def fit(spans: DataFrame, precision: float = 0.98, seed: int = 7) -> SpanModel:
    """Trees from proposed spans with labels.

    Numbers and addresses of a rule that pass their check are right; proposals that fail it,
    and runs of digits within a word, are wrong.  Long runs assigned to a name of a secret
    are right, those with fewer than two runs of digits wrong.  All other proposals have no
    label; they are what the trees judge.  Every labelled span counts, spans with the same
    features as one row of their number; either label of a kind weighs the same.  Thresholds
    are calibrated on a quarter of the documents that the trees do not see.  A kind gets none if no threshold
    reaches ``precision`` there, and then only its rule counts; for an address spelt with
    brackets its check decides then.
    """
    n_digits = F.length(digits_of(F.col("value")))
    size = F.when(F.col("kind") == 2, n_digits.between(13, 19)).when(F.col("kind") == 3, n_digits.between(7, 18)).otherwise(True)
    within = (F.col("kind") == 3) & ~F.col("rule") & (F.col("before").rlike("[A-Za-z]$") | F.col("after").rlike("^[A-Za-z]"))
    number = F.when(F.col("rule") & F.col("valid"), 1.0).when((~F.col("valid") & size) | within, 0.0)
    secret = F.when(F.col("valid") & F.col("before").rlike(ASSIGNED), 1.0).when(turns(F.col("value")) < 4, 0.0)
    label = F.when(F.col("kind") == SECRET, secret).otherwise(number)
    known = with_features(spans).withColumn("label", label).filter("label IS NOT NULL")
    known = known.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)))
    # what the trees of a kind do not see would only keep its rows apart
    unseen = [(f"f_{k}", own) for own, names, _ in _families() for k in CONTEXT + FORMAT if k not in names]
    known = known.withColumns({c: F.when(~own, F.col(c)).otherwise(0.0) for c, own in unseen})
    # written, so that every pass of the fit reads distinct features only
    learnt = stage_table(known.groupBy(*[c for c, _ in unseen], "label", "kind", "fold").agg(F.count(F.lit(1)).alias("n")), "pii-learnt")
    counts = {(row["kind"], row["label"]): row["n"] for row in learnt.groupBy("kind", "label").agg(F.sum("n").alias("n")).collect()}
    untaught = SpanModel(None, {k: 0.0 for k in ADDRESSES})  # only what needs no near misses
    if len({label for _, label in counts}) < 2:
        return untaught
    share = F.create_map(*[F.lit(x) for (k, of), n in counts.items() for x in (2 * k + int(of), 1000.0 / n)])
    weight = F.col("n") * F.element_at(share, F.col("kind") * 2 + F.col("label").cast("int"))
    weighted = learnt.withColumn("weight", weight)
    fitted, thresholds = [], dict(untaught.thresholds)
    for own, names, rounds in _families():
        rows = _assembled(weighted.filter(own), names)
        train = rows.filter("fold <> 0")
        if train.select("label").distinct().count() < 2:
            fitted.append(None)
            continue
        trees = GBTClassifier(maxIter=rounds, maxDepth=3, seed=seed, maxBins=32, weightCol="weight", cacheNodeIds=False, checkpointInterval=-1).fit(train)
        scored = trees.transform(rows.filter("fold = 0")).withColumn("p", F.round(vector_to_array("probability")[1], 3))
        steps = scored.groupBy("kind", "p").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("all")).collect()
        thresholds |= calibrated([(r["kind"], r["p"], r["right"], r["all"] - r["right"]) for r in steps], precision)
        fitted.append(trees)
    return SpanModel(fitted, thresholds) if any(fitted) else untaught


def calibrated(steps: list[tuple[int, float, float, float]], precision: float) -> dict[int, float]:
    """Scores from which ``precision`` holds, from (kind, score, right, wrong), if either label were as frequent.

    A threshold lies halfway between the lowest score that still reaches it and the next.  Half a miss more than was found counts as wrong, so that a threshold needs the more
    held-out near misses the higher ``precision`` is.
    """
    thresholds: dict[int, float] = {}
    for kind in range(len(ALL_KINDS)):
        own = sorted((s[1:] for s in steps if s[0] == kind), reverse=True)
        hits, misses = sum(s[1] for s in own), sum(s[2] for s in own)
        right = wrong = 0.0
        for i, (p, r, w) in enumerate(own):
            right, wrong = right + r, wrong + w
            share = (wrong + 0.5) / (misses + 1)
            if right and misses and right / hits >= precision * (right / hits + share) and p >= 0.5:
                below = own[i + 1][0] if i + 1 < len(own) else 0.0
                thresholds[kind] = max(0.5, (p + below) / 2)
    return thresholds


def chosen(spans: DataFrame, model: SpanModel) -> DataFrame:
    """Per text the spans ``(kind, start, end, rule)``: rules that pass, then what the trees select.

    A selected span yields to a rule's span of any kind that it overlaps, and to a longer
    or earlier selected one.
    """
    base = spans.filter(F.col("rule") & F.col("valid")).select("doc_id", "text_hash", "kind", "start", "end", "rule")
    parts = base
    if model.thresholds:
        extra = spans.filter(~F.col("rule") & F.col("valid"))
        limit = F.element_at(F.create_map(*[F.lit(x) for k, p in model.thresholds.items() for x in (k, p)]), F.col("kind"))
        featured = with_features(extra)
        for i, (own, names, _) in enumerate(_families()):
            trees = model.trees[i] if model.trees is not None else None
            rows = featured.filter(own)
            if trees is None:
                rows = rows.filter(limit <= 0)
            else:
                rows = trees.transform(_assembled(rows, names)).filter(F.round(vector_to_array("probability")[1], 3) >= limit)
            parts = parts.unionByName(rows.select("doc_id", "text_hash", "kind", "start", "end", F.lit(False).alias("rule")))
    grouped = parts.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("kind", "start", "end", "rule")).alias("spans"))
    kept = F.filter("spans", lambda s: s["rule"])
    extra = F.array_sort(F.filter("spans", lambda s: ~s["rule"]), lambda a, b: _order(a, b))

    def add(acc: Column, s: Column) -> Column:
        clash = F.exists(acc, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
        return F.when(clash, acc).otherwise(F.concat(acc, F.array(s)))

    return grouped.select("doc_id", "text_hash", F.aggregate(extra, kept, add).alias("spans"))


def _order(a: Column, b: Column) -> Column:
    """Longer first, then earlier, then by kind."""
    key = [(b["end"] - b["start"]) - (a["end"] - a["start"]), a["start"] - b["start"], a["kind"] - b["kind"]]
    return F.when(key[0] != 0, key[0]).when(key[1] != 0, key[1]).otherwise(key[2])


def personal_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, spans)`` of the texts that hold personal data.

    Kinds are numbers of ``ALL_KINDS``.  Offsets count code points, ends are exclusive.  Spans of the fixed rules may overlap
    across kinds and are all there.  Null and empty texts have no spans; repeated rows
    give one row; rows without an id are told apart by their texts only.
    """
    spans = stage_table(candidates(docs, text), "pii-candidates")
    return chosen(spans, fit(spans))


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    name = F.array(*[F.lit(k) for k in ALL_KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; overlapping spans by one.

    All other columns stay as they are; a null text stays null.
    """
    doc, text_hash, found_ = unused(docs, "__doc", "__hash", "__spans")
    spans = personal_spans(docs, text).withColumnsRenamed({"doc_id": doc, "text_hash": text_hash, "spans": found_})
    own = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    met = docs.join(spans, docs["doc_id"].eqNullSafe(F.col(doc)) & (own == F.col(text_hash)), "left")
    ordered = F.array_sort(F.transform(found_, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    begin = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), "array<string>").alias("out"))
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in ALL_KINDS])

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(F.col(text), acc["at"] + 1, s["start"] - acc["at"])
        more = F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(gap, F.get(name, s["kind"]))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substr(F.col(text), acc["at"] + 1, F.length(F.col(text))))

    clean = F.when(F.col(found_).isNull(), F.col(text)).otherwise(F.aggregate(ordered, begin, step, finish))
    return met.select(*[clean.alias(c) if c == text else docs[c] for c in docs.columns])
