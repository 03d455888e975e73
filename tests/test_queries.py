"""Every registered query of the library against its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from dialoom import plans

QUERIES, SQL = plans.load()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, (list, np.ndarray)):
        return str([plain(v) for v in value])
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, (bool, np.bool_)):
        return str(bool(value))
    if isinstance(value, (int, float, np.integer, np.floating)):
        return f"{float(value):.9g}"
    return str(value)


def rows(df: pd.DataFrame) -> list[tuple]:
    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{data}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, data, duck, name):
    got, want = QUERIES[name](spark, data).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
