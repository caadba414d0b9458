"""Every registered query with an oracle against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from verdancy.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _text(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_oracle(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(_text(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(tuple(_text(r[i]) for i in places) for r in result.fetchall())


def test_catalogue_loads_without_a_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(o) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
