import pytest

from namebridge.config import MatchConfig
from namebridge.operators import candidates as cand
from namebridge.operators.best_candidates import best_candidates
from namebridge.operators.ranking import match_results, rank_candidates, review_queue
from namebridge.operators.scoring import score_candidates
from tests.builders import clients, random_clients_and_reference, reference


def full_ranking(left, right, config, depth):
    pairs = cand.generate_candidates(left, right, config, ids_are_keys=True)
    return rank_candidates(score_candidates(pairs, config), depth)


@pytest.mark.parametrize(
    ("config", "depth", "seed"),
    [
        (MatchConfig(include_empty_block=True, cell_rows=5), 5, 8),
        (MatchConfig(similarity="levenshtein", prefix_length=2), 3, 9),
        (MatchConfig(country_bonus=0.5), 2, 10),
    ],
)
def test_best_candidates_equal_the_full_ranking(spark, rows, config, depth, seed):
    left, right = random_clients_and_reference(spark, seed=seed)
    expected = full_ranking(left, right, config, depth)
    best = best_candidates(left, right, config, depth)
    assert rows(best, *expected.columns) == rows(expected)


def test_ties_go_by_method_then_reference_id(spark):
    left = clients(spark, ("Apple", "us"))
    right = reference(spark, *[(f"L{i}", "Apple Inc", "US") for i in (3, 1, 2)])
    ranked = best_candidates(left, right, depth=4).orderBy("candidate_rank").collect()
    assert [(r.candidate_method, r.reference_id) for r in ranked] == [
        ("NAME_COUNTRY_BLOCK", "L1"), ("NAME_COUNTRY_BLOCK", "L2"), ("NAME_COUNTRY_BLOCK", "L3"),
        ("NAME_ONLY_BLOCK", "L1"),
    ]


@pytest.fixture(scope="module")
def ranked(spark):
    left, right = random_clients_and_reference(spark)
    return left, right, best_candidates(left, right).persist()


def test_result_does_not_depend_on_partitioning(rows, ranked):
    left, right, once = ranked
    again = best_candidates(left.repartition(7), right.repartition(3, "reference_id"))
    assert rows(again, *once.columns) == rows(once)


def test_one_best_match_per_client_with_candidates(ranked):
    left, right, rows = ranked
    with_candidates = cand.generate_candidates(left, right).select("client_entity_id").distinct().count()
    best = match_results(rows)
    assert best.count() == with_candidates == best.select("client_entity_id").distinct().count()


def test_clients_without_candidates_are_kept_on_request(spark):
    left, right = clients(spark, ("Apple",), ("Zebra",)), reference(spark, ("L1", "Apple"))
    ranked = best_candidates(left, right)
    assert match_results(ranked).count() == 1
    kept = match_results(ranked, MatchConfig(keep_unmatched=True), left).orderBy("client_entity_id").collect()
    assert [(r.submitted_name, r.confidence_band, r.match_score) for r in kept] == [
        ("Apple", "AUTO_MATCH", 0.9), ("Zebra", "NO_MATCH", None)
    ]
    with pytest.raises(ValueError, match="keep_unmatched"):
        match_results(ranked, MatchConfig(keep_unmatched=True))


def test_review_queue_has_every_band_and_starts_with_the_best_match(ranked):
    rows = ranked[2]
    config = MatchConfig(run_id="r7", review_depth=3)
    queue = review_queue(rows, config).collect()
    best = {r.client_entity_id: r.matched_reference_id for r in match_results(rows, config).collect()}
    assert {r.client_entity_id: r.matched_reference_id for r in queue if r.candidate_rank == 1} == best
    assert max(r.candidate_rank for r in queue) == 3
    assert {(r.run_id, r.review_status, r.reviewer, r.review_comment) for r in queue} == {("r7", "PENDING", None, None)}
    assert {r.confidence_band for r in rows.collect()} == {"AUTO_MATCH", "REVIEW", "LOW_CONFIDENCE"}


def test_many_copies_of_one_name(spark, rows):
    """A third of both sides is one name; pairs of profiles stay few."""
    left = clients(spark, *[("Apple",)] * 30, *[(f"Bank {i}",) for i in range(60)])
    right = reference(
        spark, *[(f"A{i:03}", "Apple", "US") for i in range(100)], *[(f"B{i:03}", f"Bank {i}") for i in range(200)]
    )
    expected = full_ranking(left, right, MatchConfig(), 2)
    assert rows(best_candidates(left, right, depth=2), *expected.columns) == rows(expected)


def test_plan_cuts_before_the_shuffle_and_has_no_nested_loop(spark):
    left, right = clients(spark, ("Apple", "us", "r1", "l1", "x")), reference(spark, ("L1", "Apple"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = best_candidates(left, right)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan and "Partial" in plan
