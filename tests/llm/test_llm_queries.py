"""Registered queries at the smallest scale, against SQL where there is one."""

import os

import duckdb
import pytest

from namebridge.llm import queries as llm

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for view in ("documents", "labels"):
        connection.execute(f"create view {view} as select * from '{SF_DIR}/{view}.parquet'")
    df = llm.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = connection.execute(llm.oracle_sql()[name])
    at = {d[0]: i for i, d in enumerate(result.description)}
    assert sorted(at) == columns
    expected = sorted(repr([r[at[c]] for c in columns]) for r in result.fetchall())
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == expected


#: Queries whose rows are not documents.
OTHER_ROWS = {"op8_template_decontamination", "op11_spelling_tiles"}


@pytest.mark.parametrize("name", sorted(set(llm.queries()) - set(llm.oracle_sql()) - OTHER_ROWS))
def test_query_returns_every_document(spark, name):
    count = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    got = llm.queries()[name](spark, SF_DIR)
    assert got.count() == count and got.select("doc_id").distinct().count() == count
