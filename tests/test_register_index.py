"""Matching through the stored index equals matching without it, and shuffles no register table."""

import re

import pytest
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.operators import register_index as ri
from namebridge.operators.best_candidates import best_candidates
from namebridge.sources.tables import TableStore
from tests.builders import clients, reference
from tests.test_ranking import random_clients_and_reference


@pytest.mark.parametrize("cell", [1, 256])
@pytest.mark.parametrize("config", [
    MatchConfig(cell_rows=2), MatchConfig(similarity="levenshtein", include_empty_block=True, prefix_length=2)])
def test_equal_to_matching_without_the_index(spark, rows, monkeypatch, config, cell):
    monkeypatch.setattr(ri, "_CELL_NAMES", cell)
    monkeypatch.setattr(ri, "_LIST", cell)
    left, right = random_clients_and_reference(spark)
    index = ri.RegisterIndex.scratch(right, config)
    expected = best_candidates(left, right, config)
    assert rows(best_candidates(left, right, config, index=index), *expected.columns) == rows(expected)


def test_opened_again_from_its_store(spark, rows, tmp_path):
    left, right = random_clients_and_reference(spark)
    store = TableStore(spark, root=str(tmp_path))
    ri.RegisterIndex.build(right, store)
    expected = best_candidates(left, right)
    again = ri.RegisterIndex.open(store)
    assert rows(best_candidates(left, right, index=again), *expected.columns) == rows(expected)
    # A session that does not know the buckets reads the same files as plain tables.
    for name in ("index_names", "index_leis", "index_numbers", "index_copies"):
        spark.sql(f"drop table {store._bucketed_name(name)}")
    plain = ri.RegisterIndex.open(store)
    assert rows(best_candidates(left, right, index=plain), *expected.columns) == rows(expected)


def test_other_parameters_do_not_use_the_index(spark):
    right = reference(spark, ("L1", "Apple"))
    index = ri.RegisterIndex.scratch(right)
    assert index.fits(MatchConfig(), 5)
    assert not index.fits(MatchConfig(), 6) and not index.fits(MatchConfig(prefix_length=3), 5)
    assert not index.fits(MatchConfig(include_empty_block=True), 5)


def test_register_side_has_no_exchange(spark):
    """Every exchange is above a client table or above the pairs; the bucketed scans feed their joins directly."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = clients(spark, ("Apple", "us", "r1", "l1", "x")), reference(spark, ("L1", "Apple"))
        index = ri.RegisterIndex.scratch(right)
        for table in (index.names, index.leis, index.numbers):
            keyed = left.select(F.col("clean_name").alias("_key"), "client_entity_id")
            plan = table.join(keyed, ["client_entity_id"], 10)._jdf.queryExecution().executedPlan().toString()
            joined = plan[plan.rindex("SortMergeJoin"):]
            assert "Bucketed: true" in joined and joined.count("Exchange") == 1
        copies = left.selectExpr(*[f"clean_name || '{i}' as {c}" for i, c in enumerate(ri.PROFILE)]).join(index.copies, ri.PROFILE)
        plan = copies._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_name_with_many_profiles_and_hot_keys_on_both_sides(spark, rows):
    left = clients(spark, *[("Apple", c, "r1", f"l{i}", a) for i, (c, a) in enumerate(
        [(None, None), ("us", "a b"), ("us", "b"), ("gb", None)] * 20)])
    right = reference(spark, *[(f"L{i}", "Apple", "US" if i % 2 else "GB", "R1" if i % 3 else f"R{i}", f"a{i % 70} b")
                               for i in range(300)])
    config = MatchConfig(cell_rows=10)
    expected = best_candidates(left, right, config)
    index = ri.RegisterIndex.scratch(right, config)
    assert index.numbers.cells.count() == 1
    assert rows(best_candidates(left, right, config, index=index), *expected.columns) == rows(expected)


def test_lists_of_profiles_are_bounded(spark):
    many = spark.range(1000).selectExpr("'n' as name", "id as p")
    lists = ri.named_profiles(many, "name", ["p"]).select(F.size("_profiles").alias("n")).collect()
    assert sum(r.n for r in lists) == 1000 and max(r.n for r in lists) < 3 * ri._LIST


def test_empty_register(spark):
    left, right = clients(spark, ("Apple",)), reference(spark, ("L1", "Apple")).limit(0)
    assert best_candidates(left, right, index=ri.RegisterIndex.scratch(right)).collect() == []
    assert re.match(r"index_names_[0-9a-f]{16}$", TableStore(spark, root="/x")._bucketed_name("index_names"))
