"""Every registered query against its SQL, at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return ("nan" if math.isnan(v) else float(f"{v:.9g}")) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=repr)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["tier", "reason", "battles"] and df.count() > 0
