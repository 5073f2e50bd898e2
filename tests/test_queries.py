"""Every registered query against its SQL, on the smallest provided tables."""

from __future__ import annotations

import pathlib
import time

import duckdb
import pytest

from __spark_entry__ import entry
from nimbra.plans.catalog import ORACLES, QUERIES
from tools.check_queries import rows_of

SF_DIR = pathlib.Path("/root/testdata/sf0.001")

#: The optimizer must not be what a query waits for.
SECONDS_TO_PLAN = 5

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="provided tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, str(SF_DIR))
    began = time.perf_counter()
    frame._jdf.queryExecution().optimizedPlan()
    assert time.perf_counter() - began < SECONDS_TO_PLAN
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, answer.fetchall())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
