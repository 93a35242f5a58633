"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from wattledger.plans.registry import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    wanted = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert found[0] == wanted[0]
    assert found[1] == wanted[1]


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
