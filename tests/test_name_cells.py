"""Pairs compared a cell at a time: distances against plain loops, counts and leaving pairs against the pair table."""

import random

import pytest
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.functions.name_cells import common_subsequences, edit_distances
from namebridge.operators.best_candidates import band_counts, compared_by_index
from namebridge.operators.candidates import client_side, generate_candidates
from namebridge.operators.register_index import RegisterIndex, with_profile
from namebridge.operators.scoring import score_candidates
from tests.test_ranking import random_clients_and_reference


def plain_edits(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def plain_subsequence(a, b):
    above = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(above[j - 1] + 1 if x == y else max(above[j], row[-1]))
        above = row
    return above[-1]


@pytest.mark.parametrize("letters, longest", [("ab", 9), ("abcde ", 70), ("abé\U0001f600", 140)])
def test_distances_of_all_lengths(letters, longest):
    pick = random.Random(longest)
    left = ["".join(pick.choices(letters, k=pick.randint(0, longest))) for _ in range(12)] + ["", "a" * 64, "b" * 65]
    right = ["".join(pick.choices(letters + "z", k=pick.randint(0, longest))) for _ in range(12)] + ["", "a" * 129, left[0]]
    assert edit_distances(left, right).tolist() == [[plain_edits(a, b) for b in right] for a in left]
    assert common_subsequences(left, right).tolist() == [[plain_subsequence(a, b) for b in right] for a in left]


def test_bands_are_counted_without_the_pair_table(spark, rows):
    left, right = random_clients_and_reference(spark)
    config = MatchConfig(similarity="levenshtein")
    scored = score_candidates(generate_candidates(left, right, config), config)
    expected = scored.groupBy("candidate_method", "confidence_band").agg(F.count("*").alias("n"))
    counted = band_counts(left, right, config, RegisterIndex.scratch(right, config))
    assert rows(counted) == rows(expected)


def test_few_pairs_leave_their_cell(spark):
    """Before, each pair of profiles left its comparison and was sorted by score."""
    left, right = random_clients_and_reference(spark)
    profiles = with_profile(client_side(left), "client")
    index = RegisterIndex.scratch(right)
    one = compared_by_index(profiles, index, MatchConfig(similarity="levenshtein"), 1).count()
    every = compared_by_index(profiles, index, MatchConfig(similarity="levenshtein"), 0).count()
    assert 0 < one < every / 2
