"""Queries that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest
from matchloom.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_matches_its_sql(spark, name, scale):
    sf = f"/root/testdata/{scale}"
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    wanted = con.sql(SQL[name])
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(wanted.columns)
    assert sorted(map(tuple, df.select(*wanted.columns).collect())) == sorted(wanted.fetchall())
