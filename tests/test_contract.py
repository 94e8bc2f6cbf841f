"""Every registered query against its SQL on the smallest test tables."""

from pathlib import Path

import pytest
from check_contract import differences, open_tables

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    assert differences(queries()[name](spark, FOLDER), tables, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["item1", "item2", "n", "score"]
    assert entry(spark).count() > 0
