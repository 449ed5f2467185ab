"""Every catalog query against its SQL oracle (DuckDB) on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

from conftest import SF

import __spark_entry__ as E
from corvid.plans import catalog, oracle

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
DIR = f"{SF}/sf0.001"


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def n(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(DIR):
        pytest.skip("driver tables not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(catalog.QUERIES)


SQL_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, DIR)
    got = df.collect()
    rel = con.sql(E.oracle_sql()[name])
    cols, types = rel.columns, [str(t) for t in rel.types]
    exp = rel.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert {c: SQL_TYPE.get(t, t) for c, t in df.dtypes} == dict(zip(cols, types))
    assert _norm(got, df.columns) == _norm(exp, cols)


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 10
