import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from namebridge.functions.matching_blocks import ratios
from namebridge.functions.similarity import (
    address_score,
    field_match_score,
    levenshtein_similarity,
    sequence_ratio,
    token_overlap,
    token_set,
)


def random_pairs():
    rng = random.Random(3)

    def text(alphabet, most):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, most)))

    pairs = []
    for alphabet in ("ab", "abc ", "abcdefgh ", "é日a ", "\x00\x01\x02a", "\ud800a"):
        pairs += [(text(alphabet, 45), text(alphabet, 45)) for _ in range(600)]
    pairs += [(text("abcde ", 260), text("abcde ", 260)) for _ in range(100)]
    return pairs + [("x" * 300, "x" * 190), ("x" * 190, "x" * 300), ("ab" * 99, "ab" * 99), (None, "a"), ("", "")]


def test_ratios_equal_difflib():
    pairs = random_pairs()
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    for heuristic in (False, True):
        expected = [SequenceMatcher(None, a, b, heuristic).ratio() if a and b else 0.0 for a, b in pairs]
        assert ratios(left, right, heuristic).tolist() == expected


def test_ratio_is_not_symmetric_and_client_comes_first(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "a"), ("", "a")], "a string, b string")
    assert [r[0] for r in df.select(sequence_ratio("a", "b")).collect()] == [0.25, 0.5, 0.0, 0.0]


@pytest.mark.parametrize(
    ("left", "right", "expected"),
    [("a b b", "b c", 1 / 3), ("a", "a", 1.0), ("a", None, 0.0), ("", "a", 0.0), ("a\xa0b", "a b", 1.0)],
)
def test_token_overlap(spark, left, right, expected):
    df = spark.createDataFrame([(left, right)], "a string, b string")
    assert df.select(token_overlap(F.col("a"), F.col("b"))).first()[0] == expected


def test_missing_texts_overlap_nothing_without_ansi_mode(spark):
    df = spark.createDataFrame([(None, None), (None, "a")], "a string, b string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert [r[0] for r in df.select(token_overlap(F.col("a"), F.col("b"))).collect()] == [0.0, 0.0]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize(
    ("client", "candidate", "expected"),
    [(None, None, 0.5), ("", "x", 0.5), ("x", None, 0.3), ("x", "", 0.3), ("x", "x", 1.0), ("x", "y", 0.0)],
)
def test_field_match_score(spark, client, candidate, expected):
    df = spark.createDataFrame([(client, candidate)], "a string, b string")
    assert df.select(field_match_score(F.col("a"), F.col("b"))).first()[0] == expected


@pytest.mark.parametrize(
    ("client", "candidate", "expected"),
    [(None, "x", 0.5), ("x", None, 0.3), ("x", "", 0.3), ("x", "\t", 0.3), ("\t", "x", 0.3), ("1 a", "1 b", 1 / 3),
     ("1,", "1", 0.0)],
)
def test_address_score(spark, client, candidate, expected):
    df = spark.createDataFrame([(client, candidate)], "a string, b string")
    score = address_score(F.col("a"), token_set(F.col("a")), token_set(F.col("b")))
    assert df.select(score).first()[0] == expected


def test_levenshtein_similarity_guards_empty(spark):
    df = spark.createDataFrame([("", ""), ("abcd", "abcx"), (None, "a")], "a string, b string")
    assert [r[0] for r in df.select(levenshtein_similarity(F.col("a"), F.col("b"))).collect()] == [0.0, 0.75, 0.0]
