"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from checks import registry
from tests.conftest import ROOT, SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
NAMES = sorted(entry.oracle_sql())
SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(SMALL, name)}.parquet'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tidy = [tuple(r[i] if not isinstance(r[i], float) else round(r[i], 6) for i in order) for r in rows]
    return sorted(tidy, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(name, spark, duck):
    df = entry.queries()[name](spark, SMALL)
    relation = duck.sql(entry.oracle_sql()[name])
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == {c: str(t) for c, t in zip(relation.columns, relation.types)}
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    theirs = normal(relation.columns, relation.fetchall())
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, abs_tol=2e-6)), (a, b)


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_without_the_training_data_operators():
    code = "import sys; sys.modules['labelkit.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    count, names = done.stdout.strip().splitlines()[-1].split(" ", 1)
    assert int(count) == len(registry.QUERIES) and names == "[]"
