"""Every query with SQL against DuckDB on the smallest tables: rows, names and values, whatever the order."""

import duckdb
import pytest

import __spark_entry__ as entry
from quillspark.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(repr(float(v)) if isinstance(v, float) else str(v) for v in (r[k] for k in order)) for r in values), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    assert got.columns and got.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
