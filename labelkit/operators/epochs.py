"""A softmax regression fitted epoch by epoch, with a validation set and early stopping.

Rows are turned into sparse hashed features once and written.  An epoch is one narrow pass:
each task sums the gradient of its training rows and the losses of its training and
validation rows; the sums meet by feature.  The weights, ``features x labels`` numbers, are
what the driver holds and sends out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.functions.lookup import Words, slices
from labelkit.session import SMALL_SIDE_ROWS, stage_table

FORMAT = 1


@dataclass(frozen=True)
class EpochModel:
    """Weights per feature and label; the last row is the bias."""

    labels: list[str]
    weights: np.ndarray

    @property
    def features(self) -> int:
        return len(self.weights) - 1


@dataclass(frozen=True)
class Fit:
    """The model of the best epoch and ``log (run_id, step, metric, value)`` of all epochs."""

    model: EpochModel
    log: DataFrame
    best: int


def hashed_counts(df: DataFrame, features: int, keep: Sequence[str], text: str = "input_text") -> DataFrame:
    """``(*keep, at, value)``: hashed token counts of each text, scaled to length 1.

    A token's feature is the number in the first seven digits of its md5, modulo
    ``features``.  A text without tokens has no features.
    """
    def count(texts: pa.Array) -> pa.Array:
        known: dict[bytes, int] = {}
        texts = texts.cast(pa.binary())
        at, value, sizes = [np.zeros(0, dtype=np.int64)], [np.zeros(0)], [np.zeros(0, dtype=np.int64)]
        for start, stop in slices(texts):
            words = Words.of(texts.slice(start, stop - start).to_pylist())
            hashes, first, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
            own = np.zeros(len(hashes), dtype=np.int64)
            for i, place in enumerate(first):
                token = words.token(place)
                if token not in known:
                    known[token] = int(hashlib.md5(token).hexdigest()[:7], 16) % features
                own[i] = known[token]
            owner = np.repeat(np.arange(stop - start), words.counts)
            cell, n = np.unique(owner * features + own[back], return_counts=True)
            rows = cell // features
            norm = np.sqrt(np.bincount(rows, weights=n.astype(float) ** 2, minlength=stop - start))
            at.append(cell % features)
            value.append(n / norm[rows])
            sizes.append(np.bincount(rows, minlength=stop - start))
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32))
        columns = [pa.array(np.concatenate(at).astype(np.int32)), pa.array(np.concatenate(value))]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, c) for c in columns], ["at", "value"])

    lowered = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    found = F.arrow_udf(count, "struct<at:array<int>,value:array<double>>")(lowered)
    return df.select(*keep, found.alias("_f")).select(*keep, "_f.at", "_f.value")


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, features and values of the entries of a batch."""
    sizes = np.asarray(batch.column("at").value_lengths(), dtype=np.int64)
    at = np.asarray(batch.column("at").flatten(), dtype=np.int64)
    return np.repeat(np.arange(batch.num_rows), sizes), at, np.asarray(batch.column("value").flatten())


def _probabilities(weights: np.ndarray, rows: np.ndarray, at: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    z = np.tile(weights[-1], (n, 1))
    for c in range(weights.shape[1]):
        z[:, c] += np.bincount(rows, weights=value * weights[at, c], minlength=n)
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def _epoch(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """The gradient of the training loss, and both mean losses, in one pass over the written rows."""
    n_rows, n_labels = weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient = np.zeros_like(weights)
        sums = np.zeros(4)  # loss and weight of training rows, of validation rows
        for batch in batches:
            n = batch.num_rows
            row, at, value = _matrix(batch)
            y = np.asarray(batch.column("y"), dtype=np.int64)
            w = np.asarray(batch.column("weight"), dtype=float)
            train = np.asarray(batch.column("train").cast(pa.int8())) == 1
            p = _probabilities(weights, row, at, value, n)
            loss = -w * np.log(np.maximum(p[np.arange(n), y], 1e-300))
            sums += [loss[train].sum(), w[train].sum(), loss[~train].sum(), w[~train].sum()]
            p[np.arange(n), y] -= 1
            p *= (w * train)[:, None]
            for c in range(n_labels):
                gradient[:-1, c] += np.bincount(at, weights=value * p[row, c], minlength=n_rows - 1)
            gradient[-1] += p.sum(axis=0)
        feature, label = np.nonzero(gradient)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([feature, np.full(4, n_rows)]).astype(np.int32)),
                pa.array(np.concatenate([label, np.arange(4)]).astype(np.int32)),
                pa.array(np.concatenate([gradient[feature, label], sums])),
            ],
            names=["feature", "label", "value"],
        )

    sent = rows.select("y", "weight", "train", "at", "value").mapInArrow(run, "feature int, label int, value double")
    # features x labels sums and four more numbers reach the driver
    total = sent.groupBy("feature", "label").agg(F.sum("value").alias("value")).toArrow()
    feature, label, value = (np.asarray(total.column(c)) for c in ("feature", "label", "value"))
    gradient, sums = np.zeros_like(weights), np.zeros(4)
    own = feature < n_rows
    gradient[feature[own], label[own]] = value[own]
    sums[label[~own]] = value[~own]
    losses = [float(sums[i] / sums[i + 1]) if sums[i + 1] > 0 else float("nan") for i in (0, 2)]
    return gradient / max(sums[1], 1e-300), losses


def fit_epochs(
    splits: DataFrame,
    features: int = 1 << 14,
    rate: float = 1.0,
    decay: float = 0.0,
    max_epochs: int = 50,
    patience: int = 5,
    run_id: int = 1,
    weight: str | None = None,
    text: str = "input_text",
    label: str = "label",
) -> Fit:
    """Full-batch gradient steps on ``split = 'train'``, judged on ``split = 'val'`` after every step.

    Step ``e`` of the log is the model after ``e`` updates; step 0 is all zeros.  The fit
    ends after ``max_epochs`` updates, or ``patience`` steps after the last new minimum of
    the validation loss, and keeps the weights of that minimum.  Without validation rows
    it runs to the end and keeps the last weights.  Rows without a label are left out.
    """
    rows = splits.filter(F.col(label).isNotNull() & F.col("split").isin("train", "val"))
    labels = [r[0] for r in rows.filter("split = 'train'").select(F.col(label).cast("string")).distinct().limit(SMALL_SIDE_ROWS + 1).collect()]
    if not labels or len(labels) > SMALL_SIDE_ROWS:
        raise ValueError(f"a fit needs 1 to {SMALL_SIDE_ROWS} labels among its training rows")
    labels.sort()
    # a validation row with a label that no training row has is judged by no weight
    number = F.array_position(F.array(*map(F.lit, labels)), F.col(label).cast("string")) - 1
    narrow = rows.select(
        F.col(text).alias("_text"),
        number.cast("int").alias("y"),
        (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("weight"),
        (F.col("split") == "train").alias("train"),
    ).filter("y >= 0")
    staged = stage_table(hashed_counts(narrow, features, ["y", "weight", "train"], "_text"), "features")
    weights = np.zeros((features + 1, len(labels)))
    best, best_loss, best_weights, log = 0, np.inf, weights, []
    for epoch in range(max_epochs + 1):
        gradient, (train_loss, val_loss) = _epoch(staged, weights)
        log += [(run_id, epoch, "train_loss", train_loss), (run_id, epoch, "val_loss", val_loss)]
        if val_loss < best_loss or np.isnan(val_loss):
            best, best_loss, best_weights = epoch, val_loss if val_loss < best_loss else best_loss, weights
        elif epoch - best >= patience:
            break
        weights = weights - rate * (gradient + decay * weights)
    spark = splits.sparkSession
    table = spark.createDataFrame(log, "run_id long, step long, metric string, value double")
    return Fit(EpochModel(labels, best_weights), table, best)


def apply_epochs(model: EpochModel, df: DataFrame, key: str = "example_id", text: str = "input_text", label: str = "label") -> DataFrame:
    """``(key, predicted, ground_truth, score)`` for any rows; the smaller label wins a tie."""
    rows = df.select(F.col(key).alias("_key"), F.col(label).cast("string").alias("_truth"), F.col(text).alias("_text"))
    coded = hashed_counts(rows, model.features, ["_key", "_truth"], "_text")
    weights, labels = model.weights, model.labels

    def predict(at: pa.Array, value: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([at, value], names=["at", "value"])
        p = _probabilities(weights, *_matrix(batch), batch.num_rows)
        best = np.argmax(np.round(p, 12), axis=1)
        names = pa.array([labels[i] for i in best], type=pa.string())
        return pa.StructArray.from_arrays([names, pa.array(p[np.arange(len(best)), best])], ["label", "score"])

    found = F.arrow_udf(predict, "struct<label:string,score:double>")(F.col("at"), F.col("value"))
    return coded.select("_key", "_truth", found.alias("_p")).select(
        F.col("_key").alias(key), F.col("_p.label").alias("predicted"), F.col("_truth").alias("ground_truth"), F.col("_p.score").alias("score")
    )


def save_epochs(spark: SparkSession, model: EpochModel, path: str) -> None:
    """Weights that are not zero as parquet, and labels and sizes as one JSON document, written last."""
    feature, label = np.nonzero(model.weights)
    entries = [(int(f), int(c), float(model.weights[f, c])) for f, c in zip(feature, label)]
    spark.createDataFrame(entries, "feature int, label int, weight double").write.mode("errorifexists").parquet(f"{path}/weights")
    document = json.dumps({"format": FORMAT, "labels": model.labels, "features": model.features})
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/model")


def load_epochs(spark: SparkSession, path: str) -> EpochModel:
    document = json.loads(spark.read.text(f"{path}/model").first()["value"])
    if document["format"] != FORMAT:
        raise ValueError(f"format {document['format']} of a model is not known")
    weights = np.zeros((document["features"] + 1, len(document["labels"])))
    rows = spark.read.schema("feature int, label int, weight double").parquet(f"{path}/weights").toArrow()
    weights[np.asarray(rows.column("feature")), np.asarray(rows.column("label"))] = np.asarray(rows.column("weight"))
    return EpochModel(document["labels"], weights)
