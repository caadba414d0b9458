"""The SQL of the operators that SQL can express, run by DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from verdancy.llm import quality_rules, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_registered_sql(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    result = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(result.fetchall())


def test_base_counts_of_the_quality_rules(spark, duck):
    result = duck.execute(quality_rules.ORACLE)
    names = [d[0] for d in result.description]
    df = queries.queries()["op9_quality_rules"](spark, DATA)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(result.fetchall())
