"""Every registered query against its SQL counterpart, on whole tables."""

import os

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as driver

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    connection = duck(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    names, rows = spark_rows(driver.queries()[name](spark, FOLDER))
    expected_names, expected = duck_rows(tables, driver.oracle_sql()[name])
    assert names == expected_names
    assert rows == expected
    assert rows


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert driver.queries()[name](spark, FOLDER).toArrow().num_rows > 0


def test_entry_is_stable(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["source_file", "num_chunks", "total_pages", "total_word_count"]
    assert frame.count() == 20


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
