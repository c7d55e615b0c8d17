"""Every registered query against its SQL in DuckDB, on whole tables."""

import os

import comparing
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {k: f for k, f in registry.queries().items() if k not in registry.LLM_QUERIES}
SQL = {k: s for k, s in registry.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return comparing.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_and_types(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = comparing.spark_rows(df)
    assert found[1], "no rows"
    assert found == comparing.duck_rows(duck, SQL[name])
    assert comparing.type_names(df, duck, SQL[name]) == []


def test_entry(spark):
    assert registry.entry(spark).count() > 0
