"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(spark_entry.queries())


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees(spark, con, name):
    build, sql = spark_entry.queries()[name], spark_entry.oracle_sql().get(name)
    if sql is None:
        assert build(spark, FOLDER).count() > 0
    else:
        assert compare(spark, con, FOLDER, build, sql) == ""


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_names_are_paired():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
