"""The driver contract: entry(), queries() and oracle_sql() agree with DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from pressloom.plans import catalog
from pressloom.sources.tables import TABLES

from conftest import SF_SMALL

def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "fake", "n_pages", "n_titled", "title_chars"]
    assert len(rows) >= 1


def test_every_query_of_the_library_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, duck, key):
    sdf = catalog.QUERIES[key](spark, SF_SMALL)
    rel = duck.sql(catalog.ORACLES[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(rel.columns, rel.fetchall())
