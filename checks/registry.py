"""Registration of a query together with its SQL, and the common output form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tidy(df: DataFrame) -> DataFrame:
    """BIGINT, DOUBLE (6 digits) and STRING columns only; id arrays as comma-joined text."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            col = col.cast("bigint")
        elif isinstance(field.dataType, T.FractionalType):
            col = F.round(col.cast("double"), 6)
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(F.transform(col, lambda x: x.cast("string")), ",")
        columns.append(col.alias(field.name))
    return df.select(*columns)
