"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")
CHECKS = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    result = duck.execute(CHECKS[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert _sorted(frame.select(*columns).collect()) == _sorted(result.fetchall())


def test_every_check_belongs_to_a_query():
    assert set(CHECKS) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
