"""The contract's functions; every query with SQL against DuckDB on the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = entry.oracle_sql()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, datetime.date) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, duck, name):
    frame = entry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(plain(dict(zip(names, row, strict=True))[c]) for c in columns) for row in result.fetchall()), key=repr)
    assert sorted(names) == columns and got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names_match():
    assert set(SQL) <= set(entry.queries())
    if entry.HAS_LLM:
        assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in entry.queries())] == [] and "pipeline" in entry.queries()
