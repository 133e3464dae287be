"""Every registered query against its DuckDB oracle (row count, column
names, order-insensitive values) on the smallest test scale."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from bancalyt.plans.registry import REGISTRY
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_catalogue_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.queries()) and set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [c[0] for c in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id_cliente", "cliente", "provincia", "saldo", "ranking"]
    assert df.count() > 0
