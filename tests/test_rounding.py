import random
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from namebridge.config import MatchConfig
from namebridge.functions.rounding import half_even, rounded
from pyspark.sql import functions as F


def results(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return [r[0] for r in df.select(half_even(F.col("v"))).collect()]


def test_equal_to_python_at_and_beside_every_tie(spark):
    ties = [(2 * k + 1) / 20000 for k in range(10_500)]
    beside = [t + s * 2.0**-e for t in ties[::7] for e in (50, 53, 56) for s in (-1, 1)]
    exact = [k + j / 32 for k in (0, 1, 7, 1000) for j in range(32)]  # exact ties among them
    values = [*ties, *beside, *exact, *(-t for t in ties[::11]), 0.0, 5e-324, 0.00005, 123456.00005, 1e10]
    assert results(spark, values) == [round(v, 4) for v in values]


def test_the_two_rules_differ_at_ties_only(spark):
    ties = [(2 * k + 1) / 20000 for k in range(10_000)]
    df = spark.createDataFrame([(v,) for v in ties], "v double")
    up = [r[0] for r in df.select(rounded(F.col("v"), MatchConfig())).collect()]
    steps = {round((a - b) * 10_000) for a, b in zip(up, results(spark, ties), strict=True)}
    assert steps == {0, 1}


def test_ratios_and_weighted_scores(spark):
    pick = random.Random(4)
    ratios = [2 * m / n for n in range(2, 130) for m in range(n // 2 + 1)]
    scores = [0.6 * pick.choice(ratios) + 0.2 * pick.choice(ratios) + 0.15 * pick.choice((0.0, 0.3, 0.5, 1.0))
              + 0.05 * pick.choice(ratios) for _ in range(20_000)]
    assert results(spark, ratios + scores) == [round(v, 4) for v in ratios + scores]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=200))
def test_any_doubles(spark, values):
    assert results(spark, values) == [round(v, 4) for v in values]


def test_null_and_not_finite_values(spark):
    none, nan, up, down = results(spark, [None, float("nan"), float("inf"), float("-inf")])
    assert none is None and nan != nan and (up, down) == (float("inf"), float("-inf"))


def test_unknown_rule():
    with pytest.raises(ValueError, match="unknown rounding"):
        MatchConfig(rounding="up")


def test_scored_names_follow_the_option(spark):
    from namebridge.operators.scoring import score_by_name

    pairs = [(a, b) for a in ("alpha trading", "beta works", "gamma oil gas") for b in ("alpha trade", "beta work", "gas oil")]
    rows = [(SequenceMatcher(None, a, b, autojunk=False).ratio(), t, 1.0, 0.5, "other") for a, b in pairs for t in (0.0, 1 / 3, 0.5)]
    df = spark.createDataFrame(rows, "name_similarity double, token_score double, country_score double, "
                                     "address_score double, candidate_method string")
    got = [r[0] for r in df.select(score_by_name(MatchConfig(rounding="half_even"))).collect()]
    assert got == [round(min(0.6 * n + 0.2 * t + 0.15 * c + 0.05 * a + 0.0, MatchConfig().score_cap), 4) for n, t, c, a, _ in rows]
