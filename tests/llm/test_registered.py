"""Registered queries: against their SQL, and without it against another way to the result."""

import os

import comparing
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_all_are_registered():
    numbers = {name.split("_")[0] for name in registry.LLM_QUERIES}
    assert numbers == {"pipeline", *(f"op{n}" for n in range(1, 14))}
    assert set(registry.LLM_SQL) <= set(registry.LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(registry.LLM_SQL))
def test_same_rows_and_types(spark, name):
    con = comparing.connect(SF_DIR)
    df = registry.queries()[name](spark, SF_DIR)
    found = comparing.spark_rows(df)
    assert found[1] and found == comparing.duck_rows(con, registry.oracle_sql()[name])
    assert comparing.type_names(df, con, registry.oracle_sql()[name]) == []


ROWS = {"op1": "documents", "op2": "documents", "op4": "documents", "op7": "documents", "op10": "documents", "op12": "documents", "op13": "documents"}


@pytest.mark.parametrize("name", sorted(n for n in registry.LLM_QUERIES if n.split("_")[0] in ROWS))
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = registry.queries()[name](spark, SF_DIR).cache()
    assert found.count() == docs.count() == found.join(docs, "doc_id").count()
    found.unpersist()
