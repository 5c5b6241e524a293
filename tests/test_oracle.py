"""Every registered query against its DuckDB oracle on the smallest data set."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from clickflow.plans import registry as E
from conftest import SMOKE_DIR

TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def test_registry_complete():
    assert len(QUERIES) >= 60
    missing = set(QUERIES) - set(ORACLE)
    assert missing == set()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _canon(s_cols, s_rows) == _canon(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    out = df.collect()
    assert len(out) == 1
    assert df.columns[:2] == ["taskid", "session_count"]
