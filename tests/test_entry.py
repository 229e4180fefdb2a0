"""Driver contract: entry(), queries(), oracle_sql(); every query vs DuckDB at sf0.001."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from encore.registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns[:4] == ["rank", "artist", "song", "genre"] and len(rows) == 10


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = df.collect()
    rel = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(dcols)
    want = [tuple(r[dcols.index(c)] for c in cols) for r in rel.fetchall()]
    assert Counter(tuple(map(_norm, r)) for r in got) == Counter(tuple(map(_norm, r)) for r in want)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
                 "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, duck, name):
    spark_types = dict(E.queries()[name](spark, SF_SMALL).dtypes)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    for col, t in spark_types.items():
        assert duck_types.get(col) == SPARK_TO_DUCK.get(t, t.upper()), (col, t, duck_types.get(col))
