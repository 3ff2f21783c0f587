"""A label model that aggregations fit: multinomial naive Bayes over token counts.

The model is a table of token counts per label and a few numbers per label.  One scan counts
for any number of models at once: ``groups`` (such as the trial) are further columns of the
same counts.  Rows are scored where they are read, against a table of tokens with one column
of log weights per label; a model beyond ``CELLS_LIMIT`` weights keeps its most frequent
tokens in that table and joins the others.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.functions.lookup import TokenTable, Words, count_tokens, slices
from labelkit.functions.scores import let
from labelkit.session import SMALL_SIDE_ROWS, stage_table

#: Weights (tokens x labels x groups) that are sent to every task at most, 8 bytes each.
CELLS_LIMIT = 8_000_000
#: Version of the saved form.
FORMAT = 1


@dataclass(frozen=True)
class Slot:
    """One label of one model: its group, its documents and tokens (with pseudo-counts)."""

    group: tuple
    label: str
    docs: float
    tokens: float


@dataclass(frozen=True)
class BayesModel:
    """``counts (slot, token, n)`` and what there is once per slot or group."""

    groups: tuple[str, ...]
    slots: list[Slot]
    vocabulary: dict[tuple, int]
    counts: DataFrame
    alpha: float

    def group_values(self) -> list[tuple]:
        return list(dict.fromkeys(s.group for s in self.slots))


def _order(values: tuple) -> tuple:
    return tuple((v is not None, v) for v in values)


def fit_bayes(
    train: DataFrame,
    alpha: float = 1.0,
    groups: Sequence[str] = (),
    source: BayesModel | None = None,
    source_weight: float = 0.1,
    text: str = "input_text",
    label: str = "label",
) -> BayesModel:
    """Count tokens and documents per label, for each value of ``groups`` a model of its own.

    Rows without a label are left out; NULL texts are documents without tokens.  With an
    ungrouped ``source`` model its counts, times ``source_weight``, are added to every
    model as pseudo-counts: what the target rows say little about follows the source.
    """
    if alpha <= 0:
        raise ValueError("alpha has to be positive")
    groups = list(groups)
    by = [*groups, "_label"]
    rows = train.filter(F.col(label).isNotNull()).select(
        *groups, F.col(label).cast("string").alias("_label"), F.col(text).alias("_text")
    )
    counted = stage_table(count_tokens(rows, "_text", by), "token-counts")
    found = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("docs")).limit(SMALL_SIDE_ROWS + 1).collect()
    if len(found) > SMALL_SIDE_ROWS:
        raise ValueError(f"more than {SMALL_SIDE_ROWS} labels of models")
    docs = {tuple(r[:-1]): float(r["docs"]) for r in found}
    tokens = {tuple(r[:-1]): float(r["n"]) for r in counted.groupBy(*by).agg(F.sum("count").alias("n")).collect()}
    prior = {} if source is None else {s.label: (i, s) for i, s in enumerate(source.slots)}
    slots = []
    for group in sorted({k[:-1] for k in docs}, key=_order):
        for name in sorted({k[-1] for k in docs if k[:-1] == group} | set(prior)):
            _, old = prior.get(name, (None, Slot((), name, 0.0, 0.0)))
            own = (*group, name)
            slots.append(
                Slot(group, name, docs.get(own, 0.0) + source_weight * old.docs, tokens.get(own, 0.0) + source_weight * old.tokens)
            )
    spark = train.sparkSession
    numbered = [(i, *s.group, s.label) for i, s in enumerate(slots)]
    fields = ", ".join(["_slot int", *[f"`_g{i}` {rows.schema[c].dataType.simpleString()}" for i, c in enumerate(groups)], "_name string"])
    names = F.broadcast(spark.createDataFrame(numbered, fields))  # at most SMALL_SIDE_ROWS rows
    same = F.col("_label") == F.col("_name")
    for i, c in enumerate(groups):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    counts = counted.join(names, same).select(F.col("_slot").alias("slot"), "token", F.col("count").cast("double").alias("n"))
    if source is not None:
        goes_to = [[j for j, t in enumerate(slots) if t.label == s.label] for s in source.slots]
        targets = F.get(F.array(*[F.array(*map(F.lit, js)).cast("array<int>") for js in goes_to]), F.col("slot"))
        added = source.counts.select(F.explode(targets).alias("slot"), "token", (F.col("n") * F.lit(source_weight)).alias("n"))
        counts = counts.unionByName(added).groupBy("slot", "token").agg(F.sum("n").alias("n"))
    counts = stage_table(counts, "bayes")
    group_values = list(dict.fromkeys(s.group for s in slots))
    of_slot = F.array(*[F.lit(group_values.index(s.group)) for s in slots]) if slots else F.array().cast("array<int>")
    sizes = counts.select(F.get(of_slot, F.col("slot")).alias("_g"), "token").distinct().groupBy("_g").count().collect()
    vocabulary = {group: 0 for group in group_values} | {group_values[r["_g"]]: r["count"] for r in sizes}
    return BayesModel(tuple(groups), slots, vocabulary, counts, alpha)


class _Weights:
    """Log weights of tokens per slot, for the tokens in a table."""

    def __init__(self, model: BayesModel, counts: DataFrame):
        """``counts`` are the model's for some tokens, of a checked size."""
        rows = counts.toArrow()
        coded = rows.column("token").combine_chunks().cast(pa.string()).dictionary_encode()
        self.table = TokenTable(coded.dictionary.cast(pa.string()))
        slot = np.asarray(rows.column("slot"), dtype=np.int64)
        counted = np.zeros((len(self.table), len(model.slots)))
        counted[np.asarray(coded.indices, dtype=np.int64), slot] = np.asarray(rows.column("n"))
        self.weights = np.zeros_like(counted)
        values = model.group_values()
        self.known = np.zeros((len(self.table), len(values)), dtype=bool)
        for g, value in enumerate(values):
            own = [i for i, s in enumerate(model.slots) if s.group == value]
            known = self.known[:, g] = counted[:, own].any(axis=1)
            for i in own:
                total = model.slots[i].tokens + model.alpha * model.vocabulary[value]
                self.weights[known, i] = np.log((counted[known, i] + model.alpha) / total)

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[tuple[int, bytes]]]:
        """Sums of weights and known tokens per group of each text, and the tokens outside of the table by row."""
        texts = texts.cast(pa.binary())
        sums = np.zeros((len(texts), self.weights.shape[1]))
        known = np.zeros((len(texts), self.known.shape[1]), dtype=np.int64)
        rest: list[tuple[int, bytes]] = []
        for start, stop in slices(texts):
            words = Words.of(texts.slice(start, stop - start).to_pylist())
            entry = self.table.find(words)
            owner = np.repeat(np.arange(start, stop), words.counts)
            rest += [(int(owner[i]), words.token(i)) for i in np.flatnonzero(entry < 0)]
            met = entry >= 0
            rows, entry = owner[met], entry[met]
            edges = np.searchsorted(rows, np.arange(start, stop + 1))
            full = np.flatnonzero(np.diff(edges))  # texts with a token of the table
            if len(full):
                sums[start + full] = np.add.reduceat(self.weights[entry], edges[full], axis=0)
                known[start + full] = np.add.reduceat(self.known[entry].astype(np.int64), edges[full], axis=0)
        return sums, known, rest


def score_rows(model: BayesModel, df: DataFrame, text: str = "input_text", keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, scores, known)``: log joint score per slot and known tokens per group.

    Tokens that no training row of a group has do not count in it.  NULL and empty texts
    have the log shares of the labels as scores.
    """
    keep = list(keep)
    prior = []
    for s in model.slots:
        total = sum(x.docs for x in model.slots if x.group == s.group)
        prior.append(math.log(s.docs / total) if s.docs > 0 else -math.inf)
    lowered = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    n_tokens = model.counts.select("token").distinct().count()
    n_slots, groups = max(len(model.slots), 1), model.group_values()
    share = F.array(*map(F.lit, prior)) if prior else F.array().cast("array<double>")
    if n_tokens * n_slots <= CELLS_LIMIT:
        weights = _Weights(model, model.counts)

        def score(texts: pa.Array) -> pa.Array:
            sums, known, _ = weights.score(texts)
            return pa.StructArray.from_arrays([_fixed(sums), _fixed(known)], ["sums", "known"])

        found = F.arrow_udf(score, "struct<sums:array<double>,known:array<long>>")(lowered)
        rows = df.select(*keep, found.alias("_s"))
        return rows.select(*keep, F.zip_with("_s.sums", share, lambda a, b: a + b).alias("scores"), F.col("_s.known").alias("known"))

    totals = model.counts.groupBy("token").agg(F.sum("n").alias("_n"))
    frequent = stage_table(totals.orderBy(F.desc("_n"), "token").limit(CELLS_LIMIT // n_slots).select("token"), "frequent")
    head = _Weights(model, model.counts.join(F.broadcast(frequent), "token"))  # CELLS_LIMIT cells at most
    others = model.counts.join(frequent, "token", "left_anti")

    def part(texts: pa.Array) -> pa.Array:
        sums, known, rest = head.score(texts)
        sizes = np.bincount([r for r, _ in rest], minlength=len(texts)) if rest else np.zeros(len(texts), dtype=np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        tokens = pa.array([t for _, t in rest], type=pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays([_fixed(sums), _fixed(known), pa.ListArray.from_arrays(offsets, tokens)], ["sums", "known", "rest"])

    found = F.arrow_udf(part, "struct<sums:array<double>,known:array<long>,rest:array<string>>")(lowered)
    rows = stage_table(df.select(*keep, found.alias("_s")).withColumn("_row", F.monotonically_increasing_id()), "scored")
    # weights of the other tokens, one row per token, with NULL where a group does not know it
    by_slot = [F.max(F.when(F.col("slot") == i, F.col("n"))).alias(f"_{i}") for i in range(len(model.slots))]
    wide = others.groupBy("token").agg(*by_slot)
    logs, knows = [], []
    for i, s in enumerate(model.slots):
        own = [j for j, x in enumerate(model.slots) if x.group == s.group]
        there = F.coalesce(*[F.col(f"_{j}") for j in own]).isNotNull()
        total = s.tokens + model.alpha * model.vocabulary[s.group]
        logs.append(F.when(there, F.log((F.coalesce(f"_{i}", F.lit(0.0)) + model.alpha) / total)).otherwise(0.0).alias(f"_{i}"))
        if i == own[0]:
            knows.append(there.cast("long").alias(f"_k{len(knows)}"))
    asked = rows.select("_row", F.explode("_s.rest").alias("token")).groupBy("_row", "token").agg(F.count(F.lit(1)).alias("_c"))
    met = asked.join(wide.select("token", *logs, *knows), "token")
    added = met.groupBy("_row").agg(
        F.array(*[F.sum(F.col("_c") * F.col(f"_{i}")) for i in range(len(model.slots))]).alias("_sums"),
        F.array(*[F.sum(F.col("_c") * F.col(f"_k{g}")) for g in range(len(groups))]).alias("_known"),
    )
    joined = rows.join(added, "_row", "left")
    own = F.zip_with("_s.sums", share, lambda a, b: a + b)
    return joined.select(
        *keep,
        F.when(F.col("_sums").isNull(), own).otherwise(F.zip_with(own, "_sums", lambda a, b: a + b)).alias("scores"),
        F.when(F.col("_known").isNull(), F.col("_s.known")).otherwise(F.zip_with("_s.known", "_known", lambda a, b: a + b)).alias("known"),
    )


def _fixed(values: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def predict_bayes(
    model: BayesModel, df: DataFrame, text: str = "input_text", truth: str = "label", key: str = "example_id", keep: Sequence[str] = ()
) -> DataFrame:
    """``(*groups, key, predicted, ground_truth, score, margin, *keep)``: a row per model and row of ``df``.

    ``score`` is the probability of the label, ``margin`` its log odds against the second
    best per known token (NULL with one label).  Scores are compared to nine digits; the
    smaller label wins a tie.  A model without labels predicts nothing: no rows.
    """
    keep = list(keep)
    scored = score_rows(model, df.withColumn("_truth", F.col(truth).cast("string")), text, [key, "_truth", *keep])
    every = []
    for g, value in enumerate(model.group_values()):
        own = [i for i, s in enumerate(model.slots) if s.group == value]
        entries = F.array(
            *[F.struct((-F.round(F.get("scores", F.lit(i)), 9)).alias("less"), F.lit(model.slots[i].label).alias("label")) for i in own]
        )
        values = [F.lit(v).alias(c) for v, c in zip(value, model.groups)]
        every.append(F.struct(*values, F.array_sort(entries).alias("_order"), F.get("known", F.lit(g)).alias("_known")))
    none = "array<struct<_order:array<struct<less:double,label:string>>,_known:long>>"
    exploded = scored.select(key, "_truth", *keep, F.explode(F.array(*every) if every else F.array().cast(none)).alias("_m"))
    order = F.col("_m._order")
    first, second = F.get(order, F.lit(0)), F.get(order, F.lit(1))

    def probability(entries: Column) -> Column:
        return let(F.get(entries, F.lit(0))["less"], lambda low: 1.0 / F.aggregate(entries, F.lit(0.0), lambda acc, x: acc + F.exp(low - x["less"])))

    known = F.greatest(F.col("_m._known"), F.lit(1)).cast("double")
    return exploded.select(
        *[F.col(f"_m.`{c}`").alias(c) for c in model.groups],
        key,
        first["label"].alias("predicted"),
        F.col("_truth").alias("ground_truth"),
        probability(order).alias("score"),
        ((second["less"] - first["less"]) / known).alias("margin"),
        *keep,
    )


def save_bayes(model: BayesModel, path: str) -> None:
    """Counts as parquet and the few numbers as one JSON document, under one folder.

    Group values have to be numbers, texts or NULL.  An existing folder is not overwritten;
    the document is written last, so a bundle that has it is whole.
    """
    spark = model.counts.sparkSession
    model.counts.write.mode("errorifexists").parquet(f"{path}/counts")
    document = {
        "format": FORMAT,
        "alpha": model.alpha,
        "groups": list(model.groups),
        "slots": [[list(s.group), s.label, s.docs, s.tokens] for s in model.slots],
        "vocabulary": [[list(g), n] for g, n in model.vocabulary.items()],
    }
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/model")


def load_bayes(spark: SparkSession, path: str) -> BayesModel:
    """A saved model; an unknown version ends with an error."""
    document = json.loads(spark.read.text(f"{path}/model").first()["value"])
    if document["format"] != FORMAT:
        raise ValueError(f"format {document['format']} of a model is not known")
    return BayesModel(
        tuple(document["groups"]),
        [Slot(tuple(g), label, docs, tokens) for g, label, docs, tokens in document["slots"]],
        {tuple(g): n for g, n in document["vocabulary"]},
        spark.read.schema("slot int, token string, n double").parquet(f"{path}/counts"),
        document["alpha"],
    )
