"""Queries with SQL equal DuckDB on the driver's tables and on the hard rows."""

import duckdb
import pytest

from cliptide.llm import queries


def compare(spark, path, name, table, glob):
    df = queries.QUERIES[name](spark, path)
    cols = sorted(df.columns)
    c = duckdb.connect()
    c.execute(f"create view {table} as select * from '{glob}'")
    r = c.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    key = lambda row: tuple(map(repr, row))
    want = sorted((tuple(row[names.index(k)] for k in cols) for row in r.fetchall()), key=key)
    got = sorted((tuple(x) for x in df.select(*cols).collect()), key=key)
    assert got == want and got


@pytest.mark.parametrize("name,table", [("op1_warc", "pages"), ("op7_quality", "documents")])
def test_query_equals_sql(spark, name, table):
    path = "/root/testdata/sf0.01"
    compare(spark, path, name, table, f"{path}/{table}.parquet")


def test_hard_rows(spark, docs):
    compare(spark, docs, "op7_quality", "documents", f"{docs}/documents.parquet/*.parquet")
