"""Every registered query against its SQL, on whole tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    yield con
    con.close()


def sort_key(row):
    return tuple((value is None, str(type(value)), value) if value is not None else (True, "", 0) for value in row)


def test_same_names():
    """Queries without SQL belong to the training-text part, which tests them itself."""
    without = set(driver.queries()) - set(driver.oracle_sql())
    assert not set(driver.oracle_sql()) - set(driver.queries())
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in without)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, duck, name):
    frame = driver.queries()[name](spark, FOLDER)
    expected = duck.sql(driver.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    columns = sorted(frame.columns)
    got = [tuple(row) for row in frame.select(*columns).collect()]
    want = expected.select(*[f'"{c}"' for c in columns]).fetchall()
    assert len(got) == len(want)
    assert got, "an empty result checks nothing"
    assert sorted(got, key=sort_key) == sorted(want, key=sort_key)


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["month", "city_id", "merchant_name", "purchase_total", "no_of_sales"]
    assert frame.count() > 0
