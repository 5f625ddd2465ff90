"""Every named query against its SQL on the same tables."""

import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_point
from conftest import SMALL
from quillvec.plans.registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def plain(value):
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((plain(tuple(r[c] for c in columns)) for r in df.collect()), key=repr)
    result = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((plain(tuple(r[i] for i in at)) for r in result.fetchall()), key=repr)


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
