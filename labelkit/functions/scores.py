"""Row-local score arithmetic on ``ARRAY<DOUBLE>`` columns of logits.

Everything is linear in the number of classes: a value used inside a lambda is bound with
:func:`let` first, because Spark evaluates a lambda's body once per element, whatever it
refers to.

A row of scores over a large vocabulary can be held as ``SPARSE``: the log of the sum of all
exponentials, the ``top`` best classes, best first, and the classes that somebody will ask
for.  That is all that probabilities of those classes need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: ``ids`` are the ``top`` best classes, the lower id first on a tie, then the other wanted ones.
SPARSE = "struct<lse:double,top:int,ids:array<int>,z:array<double>>"


def is_sparse(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StructType)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), 0)


def normalizer(logits: Column) -> Column:
    """``struct(top, total)``: the largest logit and the sum of ``exp(z - top)``."""

    def total(top: Column) -> Column:
        sum_exp = F.aggregate(logits, F.lit(0.0), lambda acc, z: acc + F.exp(z - top))
        return F.struct(top.alias("top"), sum_exp.alias("total"))

    return let(F.array_max(logits), total)


def log_sum_exp(logits: Column) -> Column:
    return let(normalizer(logits), lambda n: n["top"] + F.log(n["total"]))


def best_index(logits: Column) -> Column:
    """Zero-based argmax; the lowest index wins a tie."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def best_probability(logits: Column) -> Column:
    """The largest softmax value: ``exp(0)`` over the shifted sum."""
    return F.lit(1.0) / normalizer(logits)["total"]


def probability_at(logits: Column, index: Column, norm: Column) -> Column:
    """Softmax value of one position, given the :func:`normalizer`; NULL outside the array."""
    return F.exp(F.get(logits, index) - norm["top"]) / norm["total"]


def softmax(logits: Column) -> Column:
    """Softmax over the whole array."""
    return let(normalizer(logits), lambda n: F.transform(logits, lambda z: F.exp(z - n["top"]) / n["total"]))


def sparse(logits: Column, top: int, wanted: Sequence[int] = ()) -> Column:
    """The ``SPARSE`` form of an array of logits; wanted ids outside of the array are left out."""
    entries = F.transform(logits, lambda z, i: F.struct((-z).alias("less"), i.alias("id")))

    def held(best: Column) -> Column:
        others = [F.when(~F.array_contains(best["id"], i) & (F.size(logits) > i), F.lit(i)) for i in sorted(set(wanted))]
        more = F.array_compact(F.array(*others)) if others else F.array().cast("array<int>")
        ids = F.concat(best["id"], more)
        return F.struct(
            log_sum_exp(logits).alias("lse"),
            F.size(best).alias("top"),
            ids.alias("ids"),
            F.transform(ids, lambda i: F.get(logits, i)).alias("z"),
        )

    return let(F.slice(F.array_sort(entries), 1, top), held)


def score_at(scores: Column, index: Column) -> Column:
    """Score of one class of a sparse row; NULL if the row does not hold it."""
    return F.get(scores["z"], F.array_position(scores["ids"], index).cast("int") - 1)


def sparse_softmax(scores: Column) -> Column:
    """``array<struct<id, p>>`` of the classes that a sparse row holds, in its order."""
    pairs = F.arrays_zip(scores["ids"].alias("id"), scores["z"].alias("z"))
    return F.transform(pairs, lambda x: F.struct(x["id"].alias("id"), F.exp(x["z"] - scores["lse"]).alias("p")))


def best_of(scores: Column, held_sparse: bool) -> tuple[Column, Column]:
    """The best class and its probability, of either form."""
    if held_sparse:
        return F.get(scores["ids"], 0), F.exp(F.get(scores["z"], 0) - scores["lse"])
    return best_index(scores), best_probability(scores)
