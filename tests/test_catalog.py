"""Each query against its SQL in DuckDB on the smallest tables."""

import datetime
import decimal
import pathlib
import subprocess
import sys

import duckdb
import pytest

from tallystone.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def plain(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return f"{value:.6g}"
    return value.isoformat()[:10] if isinstance(value, datetime.date) else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    found = sorted("|".join(plain(r[c]) for c in columns) for r in df.collect())
    told = duck.sql(catalog.oracle_sql()[name])
    assert sorted(told.columns) == columns
    at = [told.columns.index(c) for c in columns]
    assert found == sorted("|".join(plain(r[i]) for i in at) for r in told.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_the_training_data_operators():
    """Without their folder the entry has the engine's queries alone."""
    code = "import sys; sys.modules['tallystone.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=pathlib.Path(__file__).parents[1], capture_output=True, text=True, check=True, timeout=100)
    assert out.stdout.split() == [str(len(catalog.queries()))] * 2
