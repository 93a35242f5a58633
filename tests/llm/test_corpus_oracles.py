import duckdb
import pytest

from wattledger.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = queries.queries()[name](spark, FOLDER)
    found = sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))
    cursor = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert sorted(df.columns) == sorted(names)
    assert found == sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
