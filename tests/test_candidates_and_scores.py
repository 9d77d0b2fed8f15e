from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.operators import candidates as cand
from namebridge.operators.scoring import score_candidates
from tests.builders import clients, random_clients_and_reference, reference


def scored(spark, client, entity, config=MatchConfig()):
    pairs = cand.generate_candidates(clients(spark, client), reference(spark, entity), config)
    return {r.candidate_method: r for r in score_candidates(pairs, config).collect()}


def test_key_methods_ignore_missing_keys(spark, rows):
    left = clients(spark, ("x", None, "r1", "l1"), ("y", None, "", ""), ("z",))
    right = reference(spark, ("L1", "p", None, "R1"), ("L2", "q", None, ""), ("L3", "s"))
    assert rows(cand.lei_candidates(left, right), *cand.CANDIDATE_KEY) == [("C0", "L1", "EXACT_LEI")]
    found = rows(cand.registration_candidates(left, right), *cand.CANDIDATE_KEY)
    assert found == [("C0", "L1", "REGISTRATION_NUMBER")]


def test_country_block_is_a_subset_of_the_name_block(spark, rows):
    left, right = random_clients_and_reference(spark)
    key = ["client_entity_id", "reference_id"]
    by_country = rows(cand.name_country_candidates(left, right), *key)
    by_name = rows(cand.name_only_candidates(left, right), *key)
    assert by_country and set(by_country) < set(by_name)
    both = cand.name_candidates(left, right)
    assert rows(both.filter("candidate_method = 'NAME_COUNTRY_BLOCK'"), *key) == by_country
    assert rows(both.filter("candidate_method = 'NAME_ONLY_BLOCK'"), *key) == by_name


def test_candidates_are_distinct_with_and_without_the_deduplication(spark, rows):
    left, right = random_clients_and_reference(spark)
    checked = rows(cand.generate_candidates(left, right), *cand.CANDIDATE_KEY)
    assert checked == rows(cand.generate_candidates(left, right, ids_are_keys=True), *cand.CANDIDATE_KEY)
    assert len(checked) == len(set(checked))
    twice = left.unionByName(left)
    assert rows(cand.generate_candidates(twice, right), *cand.CANDIDATE_KEY) == checked


def test_pairs_are_only_deduplicated_where_an_id_repeats(spark, rows):
    left, right = random_clients_and_reference(spark)

    def aggregates(candidates):
        return "Deduplicate [client_entity_id" in candidates._jdf.queryExecution().analyzed().toString()

    assert not aggregates(cand.generate_candidates(left, right))  # before: all pairs were shuffled by their key
    twice = right.unionByName(right.limit(5))
    assert aggregates(cand.generate_candidates(left, twice))
    assert rows(cand.generate_candidates(left, twice), *cand.CANDIDATE_KEY) == rows(
        cand.generate_candidates(left, right), *cand.CANDIDATE_KEY)
    nameless = left.union(left.limit(2).withColumn("client_entity_id", F.lit(None).cast("string")))
    assert aggregates(cand.generate_candidates(nameless, right))


def test_register_rows_without_a_client_key_are_not_shuffled(spark, rows, monkeypatch):
    left, right = random_clients_and_reference(spark)
    for pairs in (cand.lei_candidates, cand.registration_candidates):
        few = pairs(left, right)
        assert "LeftSemi" in few._jdf.queryExecution().optimizedPlan().toString()  # before: the whole register was shuffled
        monkeypatch.setattr(cand, "KEYS_TO_ALL", 3)
        many = pairs(left, right)
        monkeypatch.undo()
        assert "LeftSemi" not in many._jdf.queryExecution().optimizedPlan().toString()
        assert rows(few) == rows(many) != []


def test_preview_builds_only_pairs_of_its_clients(spark):
    left, right = random_clients_and_reference(spark)
    left = left.union(left.limit(1).withColumn("client_entity_id", F.lit(None).cast("string")))
    for n in (1, 7, 100):
        first = cand.clients_in_preview(left, right, rows=n)
        shown = cand.candidate_preview(cand.generate_candidates(first, right), n).collect()
        assert shown == cand.candidate_preview(cand.generate_candidates(left, right), n).collect()  # before: of all clients
        found = cand.generate_candidates(left, right).select("client_entity_id").distinct()
        assert first.count() == min(n, found.count())


def test_empty_names_pair_only_on_request(spark):
    left, right = clients(spark, ("日本",)), reference(spark, ("L1", "中国"), ("L2", None))
    assert cand.name_only_candidates(left, right).count() == 0
    config = MatchConfig(include_empty_block=True)
    assert [r.reference_id for r in cand.name_only_candidates(left, right, config).collect()] == ["L1"]


def test_equal_name_alone_is_an_auto_match(spark):
    row = scored(spark, ("Apple",), ("L1", "Apple Inc", "US", "R9", "Cupertino"))["NAME_ONLY_BLOCK"]
    assert (row.match_score, row.confidence_band) == (0.9, "AUTO_MATCH")
    assert row.match_reason == "candidate_method=NAME_ONLY_BLOCK; country_not_provided_or_missing"
    assert row.country_match is False


def test_equal_lei_scores_the_same_under_every_method(spark):
    got = scored(spark, ("Apple", "us", None, "l1"), ("L1", "Apple", "US"))
    assert {m: r.match_score for m, r in got.items()} == {
        "EXACT_LEI": 0.99, "NAME_COUNTRY_BLOCK": 0.99, "NAME_ONLY_BLOCK": 0.99
    }
    assert got["EXACT_LEI"].match_reason == "candidate_method=EXACT_LEI; exact_lei_match; country_match=True"


def test_registration_can_reach_one(spark):
    got = scored(spark, ("Apple", "us", "r1"), ("L1", "Apple", "US", "R1"))
    assert got["REGISTRATION_NUMBER"].match_score == 1.0
    assert got["NAME_ONLY_BLOCK"].match_score == 1.0
    assert "registration_number_match" in got["NAME_ONLY_BLOCK"].match_reason


def test_cap_and_country_bonus(spark):
    got = scored(spark, ("Apple", "us", None, None, "main st"), ("L1", "Apple", "US", None, "main st"))
    assert {m: r.match_score for m, r in got.items()} == {"NAME_COUNTRY_BLOCK": 0.98, "NAME_ONLY_BLOCK": 0.98}


def test_name_rule_value(spark):
    got = scored(spark, ("apple asia", "us"), ("L1", "apple east asia", "FR", None, "x"))["NAME_ONLY_BLOCK"]
    ratio = SequenceMatcher(None, "apple asia", "apple east asia").ratio()
    assert got.match_score == pytest.approx(0.60 * ratio + 0.20 * 2 / 3 + 0.05 * 0.5, abs=5.1e-5)
    assert got.match_reason.endswith("country_match=False")


@pytest.mark.parametrize(
    ("client", "candidate", "expected"), [("US", "US", True), ("US", "FR", False), ("US", None, None), (None, "US", False)]
)
def test_country_match_has_three_values(spark, client, candidate, expected):
    got = scored(spark, ("Apple", client), ("L1", "Apple", candidate))["NAME_ONLY_BLOCK"]
    assert got.country_match is expected


def test_band_thresholds(spark):
    config = MatchConfig(auto_threshold=0.95, review_threshold=0.9)
    assert scored(spark, ("Apple",), ("L1", "Apple"), config)["NAME_ONLY_BLOCK"].confidence_band == "REVIEW"
    config = MatchConfig(auto_threshold=0.95, review_threshold=0.91)
    assert scored(spark, ("Apple",), ("L1", "Apple"), config)["NAME_ONLY_BLOCK"].confidence_band == "LOW_CONFIDENCE"


@pytest.mark.parametrize("similarity", ["sequence", "levenshtein"])
def test_scores_equal_a_row_by_row_computation(spark, similarity):
    left, right = random_clients_and_reference(spark, n_clients=20, n_entities=80)
    pairs = cand.generate_candidates(left, right, MatchConfig(include_empty_block=True))
    config = MatchConfig(similarity=similarity)
    for r in score_candidates(pairs, config).collect():
        assert r.match_score == pytest.approx(expected_score(r, similarity), abs=1.01e-4)
        assert 0.0 <= r.match_score <= 1.0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def expected_score(r, similarity):
    a, b = r.client_clean_name, r.candidate_clean_name
    if not a or not b:
        name = 0.0
    elif similarity == "sequence":
        name = SequenceMatcher(None, a, b).ratio()
    else:
        name = 1 - edit_distance(a, b) / max(len(a), len(b))

    def overlap(x, y):
        x, y = set((x or "").split()), set((y or "").split())
        return len(x & y) / len(x | y) if x and y else 0.0

    country = 0.5 if not r.client_country else 0.3 if not r.candidate_country else float(
        r.client_country == r.candidate_country)
    address = 0.5 if not r.client_address else 0.3 if not r.candidate_address else overlap(
        r.client_address, r.candidate_address)
    if r.client_lei and r.client_lei == r.candidate_lei:
        return 0.99
    if r.client_registration_number and r.client_registration_number == r.candidate_registration_number:
        return 0.8 + 0.1 * name + 0.1 * country
    bonus = 0.03 if r.candidate_method == "NAME_COUNTRY_BLOCK" else 0.0
    return min(0.98, 0.6 * name + 0.2 * overlap(a, b) + 0.15 * country + 0.05 * address + bonus)
