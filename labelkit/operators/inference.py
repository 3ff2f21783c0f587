"""Batch application of any user-supplied model, and table-level label sampling.

A model is a ``load`` function without arguments that returns a function on numpy
batches.  ``predict_batch_udf`` calls ``load`` once per Python worker, keeps the result,
and feeds it Arrow batches of the input columns alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.functions.keys import hash_uniform, keyed_text
from labelkit.functions.scores import SPARSE, is_sparse, let

Model = Callable[[np.ndarray], np.ndarray]


def predict(
    df: DataFrame,
    load: Callable[[], Model],
    batch_size: int = 256,
    text: str = "input_text",
    truth: str = "label",
    key: str = "example_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(key, predicted, ground_truth, *keep)``; ``load()`` maps an array of texts to labels."""
    model = predict_batch_udf(load, return_type=T.StringType(), batch_size=batch_size)
    return df.select(
        key,
        model(F.coalesce(F.col(text), F.lit(""))).alias("predicted"),
        F.col(truth).cast("string").alias("ground_truth"),
        *keep,
    )


def predict_scores(
    df: DataFrame,
    load: Callable[[], Model],
    steps: int,
    classes: int,
    batch_size: int = 256,
    text: str = "input_text",
    key: str = "example_id",
) -> DataFrame:
    """``(key, step, logits)``: scores of every generation step, keyed by example and step.

    ``load()`` maps n texts to an ``n x (steps * classes)`` array, step after step; an
    array of another length ends the job with an error.
    """
    model = predict_batch_udf(load, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    wrong = F.lit(f"a model must give {steps * classes} scores per text")

    def cut(step: Column) -> Column:
        return F.slice("_flat", step * classes + 1, F.lit(classes))

    return (
        df.select(key, model(F.coalesce(F.col(text), F.lit(""))).alias("_flat"))
        .select(key, F.when(F.size("_flat") == steps * classes, F.col("_flat")).otherwise(F.raise_error(wrong)).alias("_flat"))
        # the slices first: exploding would copy the whole array for every step
        .select(key, F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), cut).alias("_steps"))
        .select(key, F.posexplode("_steps").alias("step", "logits"))
    )


def predict_sparse_scores(
    df: DataFrame,
    load: Callable[[], Model],
    steps: int,
    classes: int,
    top: int,
    wanted: Sequence[int] = (),
    batch_size: int = 256,
    text: str = "input_text",
    key: str = "example_id",
) -> DataFrame:
    """``(key, step, logits)`` as :func:`predict_scores`, but with ``logits`` in the ``SPARSE`` form.

    What the model gives for a batch is cut down in the worker that ran it: a row holds the
    ``top`` best classes and the ``wanted`` ones, never all of them.
    """
    asked = np.array(sorted({i for i in wanted if 0 <= i < classes}), dtype=np.int64)
    top = min(top, classes)

    def cut(dense: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        high = dense.max(axis=1)
        lse = high + np.log(np.exp(dense - high[:, None]).sum(axis=1))
        best = np.argsort(-dense, axis=1, kind="stable")[:, :top]
        more = np.broadcast_to(asked, (len(dense), len(asked)))
        ids = np.concatenate([best, more], axis=1)
        keep = np.concatenate([np.ones_like(best, dtype=bool), ~(more[:, :, None] == best[:, None, :]).any(axis=2)], axis=1)
        return lse, ids, keep

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for texts in batches:
            every = []
            for at in range(0, len(texts), batch_size):
                some = np.array(texts.slice(at, batch_size).to_pylist(), dtype=object)
                flat = np.asarray(model(some), dtype=np.float64)
                if flat.shape != (len(some), steps * classes):
                    raise ValueError(f"a model must give {steps * classes} scores per text")
                dense = flat.reshape(-1, classes)
                lse, ids, keep = cut(dense)
                z = np.take_along_axis(dense, ids, axis=1)
                offsets = pa.array(np.concatenate([[0], np.cumsum(keep.sum(axis=1))]).astype(np.int32))
                columns = [
                    pa.array(lse),
                    pa.array(np.full(len(lse), top, dtype=np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(ids[keep].astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(z[keep])),
                ]
                rows = pa.StructArray.from_arrays(columns, ["lse", "top", "ids", "z"])
                every.append(pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * steps), rows))
            yield pa.concat_arrays(every) if every else pa.nulls(0, pa.list_(kind))

    kind = pa.struct([("lse", pa.float64()), ("top", pa.int32()), ("ids", pa.list_(pa.int32())), ("z", pa.list_(pa.float64()))])
    model = F.arrow_udf(run, f"array<{SPARSE}>")
    rows = df.select(key, model(F.coalesce(F.col(text), F.lit(""))).alias("_steps"))
    return rows.select(key, F.posexplode("_steps").alias("step", "logits"))


def pseudo_label(
    unlabeled: DataFrame, load: Callable[[], Model], path: str, batch_size: int = 256, key: str = "example_id"
) -> DataFrame:
    """Label the whole unlabelled pool, save it as parquet and return the saved table."""
    predictions = predict(unlabeled, load, batch_size, key=key)
    predictions.write.mode("errorifexists").parquet(path)
    return unlabeled.sparkSession.read.schema(predictions.schema).parquet(path)


def label_in_buckets(
    unlabeled: DataFrame,
    load: Callable[[], Model],
    path: str,
    buckets: int = 64,
    per_job: int = 8,
    batch_size: int = 256,
    key: str = "example_id",
    text: str = "input_text",
    truth: str = "label",
) -> DataFrame:
    """Label the pool bucket by bucket under ``path``; a rerun labels only what is missing.

    A row's bucket is a hash of its key, so every run cuts alike.  The pool is written by
    bucket first; then jobs of ``per_job`` buckets each replace their folder and, once that
    is written, add it to the manifest.  A run that ends at any point leaves folders that
    the manifest does not name, and the next run writes those again.  The result is read
    from the finished folders alone.  ``path`` belongs to one pool, model and number of
    buckets; a manifest of another number ends with an error.
    """
    spark = unlabeled.sparkSession
    pool = f"{path}/pool"
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    narrow = unlabeled.select(key, F.col(text).alias("input_text"), F.col(truth).cast("string").alias("label"), bucket)
    done = _finished(spark, path, buckets)
    if "pool" not in done:
        narrow.repartition("bucket", F.pmod(F.xxhash64(key, F.lit(1)), F.lit(16))).write.mode("overwrite").partitionBy("bucket").parquet(pool)
        _finish(spark, path, "pool", buckets)
    every = [range(a, min(a + per_job, buckets)) for a in range(0, buckets, per_job)]
    for own in every:
        name = f"{own[0]:06d}-{own[-1]:06d}"
        if name in done:
            continue
        rows = spark.read.schema(narrow.schema).parquet(pool).filter(F.col("bucket").isin(list(own)))
        predict(rows, load, batch_size, key=key).write.mode("overwrite").parquet(f"{path}/labels/{name}")
        _finish(spark, path, name, buckets)
    folders = [f"{path}/labels/{own[0]:06d}-{own[-1]:06d}" for own in every]
    schema = T.StructType([unlabeled.schema[key]]).add("predicted", "string").add("ground_truth", "string")
    return spark.read.schema(schema).parquet(*folders)


def _finished(spark: SparkSession, path: str, buckets: int) -> set[str]:
    """Names in the manifest, one small file per name; a missing manifest is an empty one."""
    try:
        rows = spark.read.schema("name string, buckets int").parquet(f"{path}/manifest/*").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    if any(r["buckets"] != buckets for r in rows):
        raise ValueError(f"{path} was begun with another number of buckets")
    return {r["name"] for r in rows}


def _finish(spark: SparkSession, path: str, name: str, buckets: int) -> None:
    row = spark.createDataFrame([(name, buckets)], "name string, buckets int").coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}/manifest/{name}")


def sample_labels(
    df: DataFrame,
    n: int,
    seed: int,
    temperature: float = 0.5,
    top_k: int = 40,
    logits: str = "logits",
    key: str = "example_id",
) -> DataFrame:
    """``(key, draw, token)``: ``n`` draws per row from the tempered, truncated softmax.

    The ``top_k`` largest logits (the lower token on a tie) share the probability
    ``exp(z / T)``; draw ``i`` takes the first token, in id order, whose cumulative
    probability exceeds a hash-uniform.  Everything is row-local: no shuffle.  Sparse rows
    have to hold ``top_k`` classes or more.
    """
    z = F.col(logits)
    scale = F.lit(float(temperature))
    if is_sparse(df, logits):
        best = F.slice(F.arrays_zip(z["z"].alias("z"), z["ids"].alias("id")), 1, top_k)
        few = F.raise_error(F.lit(f"sparse rows of scores must hold the {top_k} best classes"))
        entries = F.transform(
            F.when(z["top"] >= top_k, best).otherwise(few), lambda x: F.struct((-x["z"]).alias("negative"), x["id"].alias("token"))
        )
    else:
        entries = F.transform(z, lambda x, i: F.struct((-x).alias("negative"), i.alias("token")))
    weights = let(
        F.slice(F.array_sort(entries), 1, top_k),
        lambda top: let(
            F.get(top, 0)["negative"],
            lambda lowest: F.array_sort(
                F.transform(
                    top, lambda t: F.struct(t["token"].alias("token"), F.exp((lowest - t["negative"]) / scale).alias("w"))
                )
            ),
        ),
    )
    rows = df.select(key, weights.alias("_weights"))
    total = F.aggregate("_weights", F.lit(0.0), lambda acc, x: acc + x["w"])
    draws = rows.select(key, "_weights", total.alias("_total"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw"))
    start = F.struct(F.lit(0.0).alias("below"), F.lit(None).cast("int").alias("token"))

    def reached(u: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            below = acc["below"] + x["w"]
            hit = F.round(below / F.col("_total"), 9) > u
            token = F.when(acc["token"].isNotNull(), acc["token"]).when(hit, x["token"])
            return F.struct(below.alias("below"), token.alias("token"))

        return F.aggregate("_weights", start, step)

    uniform = hash_uniform(keyed_text(seed, "draw", F.col(key), F.col("draw")))
    last = F.get("_weights", F.size("_weights") - 1)["token"]  # a uniform above the rounded total
    return draws.select(key, "draw", F.coalesce(let(uniform, reached)["token"], last).alias("token"))
