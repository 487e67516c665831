"""Every registered query against its SQL on the smallest test tables."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from navloom_checks.oracle import SQL
from navloom_checks.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SPARK_TO_SQL = {
    "string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "int": "INTEGER",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    return connection


def comparable(row):
    return tuple(
        v.date() if isinstance(v, datetime.datetime) else v for v in row
    )


def in_order(rows):
    return sorted(map(comparable, rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    frame = QUERIES[name](spark, FOLDER)
    expected = sql.sql(SQL[name])
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: SPARK_TO_SQL[t] for c, t in frame.dtypes} == types
    found = in_order(frame.select(*[f"`{c}`" for c in columns]).collect())
    wanted = in_order(expected.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert len(found) > 0 or name == "missing_months"
    assert found == wanted


def test_flagship(spark):
    frame = driver.entry(spark)
    assert frame.columns[:3] == ["month", "rank", "class_id"]
    assert frame.count() > 0
