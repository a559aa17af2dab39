"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as driver

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    if not os.path.isdir(FOLDER):
        pytest.skip(f"no tables in {FOLDER}")
    return oracle_connection(FOLDER)


def test_every_query_has_an_oracle():
    without = set(driver.queries()) - set(driver.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") and name[2].isdigit() for name in without)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", driver.oracle_sql())
def test_query(spark, connection, name):
    assert difference(driver.queries()[name](spark, FOLDER), connection, driver.oracle_sql()[name]) is None


@pytest.fixture(scope="module")
def in_parts(spark, tmp_path_factory):
    """The same tables, each a folder of several files, as large tables are."""
    folder = tmp_path_factory.mktemp("parts")
    for path in sorted(os.listdir(FOLDER)):
        if path.endswith(".parquet"):
            spark.read.parquet(f"{FOLDER}/{path}").repartition(3).write.parquet(f"{folder}/{path}")
    return str(folder)


@pytest.mark.parametrize("name", driver.oracle_sql())
def test_query_on_tables_in_parts(spark, connection, in_parts, name):
    assert difference(driver.queries()[name](spark, in_parts), connection, driver.oracle_sql()[name]) is None


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 10 and rows[0].n >= rows[-1].n
