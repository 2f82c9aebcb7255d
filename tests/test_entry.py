"""Driver contract: entry smoke, and every registered query against its
DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from ferryline.plans.catalog import QUERIES
from tests.conftest import SF0001

TABLES = [
    "customer", "events", "lineitem", "nation", "orders", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def test_entry_runs_and_has_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["event_date", "investigation_type"] and len(df.columns) == 14
    assert df.count() > 0


def test_every_query_of_the_jobs_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_stands_without_the_optional_part(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # an import of it fails as if it were not there
    try:
        importlib.reload(entry)
        assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(" ")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF0001)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(entry.oracle_sql()[name])
    want = _rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want) and got == want
