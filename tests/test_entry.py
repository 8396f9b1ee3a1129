"""Driver contract: entry() runs on sf0.001; every registered query matches its
DuckDB twin on sf0.001 (rows, column names, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns[0] == "analytics_date"
    assert df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return v.isoformat() if hasattr(v, "isoformat") else repr(v) if not isinstance(v, str) else v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("\x1f".join(str(_norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, sf, duck, name):
    df = entry_mod.queries()[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, cur.fetchall())
