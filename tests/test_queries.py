"""Every query against its SQL counterpart at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from namebridge.plans import oracles, queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def rounded(value):
    return round(value, 9) if isinstance(value, float) else value


def test_every_query_has_an_sql_form():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(repr([rounded(r[c]) for c in columns]) for r in df.collect())
    result = database.execute(ORACLES[name])
    positions = {d[0]: i for i, d in enumerate(result.description)}
    assert sorted(positions) == columns
    expected = sorted(repr([rounded(r[positions[c]]) for c in columns]) for r in result.fetchall())
    assert got == expected


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0 and "internal_mapping_type" in result.columns


def test_the_incremental_query_matches_by_the_index(spark, monkeypatch):
    given = []

    def run(job):
        given.append(job.index)
        raise InterruptedError

    st = queries.stages(spark, SF_DIR)
    monkeypatch.setattr(queries.ArrivalJob, "run", run)
    with pytest.raises(InterruptedError):
        queries.incremental_matches(st)
    assert given == [st.index()]  # before: none, so each run shuffled the register and compared its pairs one by one
