import random
import re

import pytest
from pyspark.sql import functions as F

from namebridge.functions.ids import surrogate_id
from namebridge.functions.text import LEGAL_WORDS, clean_name, first_token, name_prefix, normalise


def cleaned(spark, names, **options):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    return [r[0] for r in df.select(clean_name(F.col("n"), **options)).collect()]


def test_clean_name_cases(spark):
    names = ["A & B Ltd", "Société X SA", "Group Holdings Ltd", "日本", None, "  Apple\t Inc. ", "Cogent Co", "INC"]
    assert cleaned(spark, names) == ["a and b", "soci t x", "", "", None, "apple", "cogent", ""]


def test_clean_name_null_as_empty(spark):
    assert cleaned(spark, [None, "Apple"], null_as_empty=True) == ["", "apple"]


def test_legal_words_stay_when_asked(spark):
    assert cleaned(spark, ["Apple Inc"], strip_legal=False) == ["apple inc"]


def test_clean_name_matches_python_over_random_text(spark):
    rng = random.Random(1)
    alphabet = "abcXYZ09 &.,-\t\néß日" + "".join(LEGAL_WORDS[:3]) + " ltd inc "
    names = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) + rng.choice(["", " Ltd", " & Co"])
             for _ in range(500)]

    def expected(name):
        text = re.sub(r"[^a-z0-9\s]", " ", name.lower().replace("&", " and "))
        text = re.sub(r"\b(" + "|".join(LEGAL_WORDS) + r")\b", " ", text)
        return " ".join(text.split())

    result = cleaned(spark, names)
    assert result == [expected(n) for n in names]
    assert all(re.fullmatch(r"([a-z0-9]+( [a-z0-9]+)*)?", r) for r in result)


@pytest.mark.parametrize(("length", "prefix"), [(4, "appl"), (2, "ap")])
def test_block_parts(spark, length, prefix):
    df = spark.createDataFrame([("apple asia",), ("",)], "c string")
    got = df.select(first_token(F.col("c")), name_prefix(F.col("c"), length)).collect()
    assert [tuple(r) for r in got] == [("apple", prefix), ("", "")]


def test_normalise_keys_and_blocking_key(spark):
    df = spark.createDataFrame(
        [("Apple Inc", " us ", " r1 ", " lei1", " Main ST "), ("Apple", None, None, None, None)],
        "n string, country string, registration_number string, lei string, address string",
    )
    first, second = normalise(df, "n").collect()
    assert first[5:] == ("apple", "US", "R1", "LEI1", "main st", "apple", "appl", "US|appl")
    assert second.blocking_key == "appl"


def test_surrogate_ids_depend_on_content_only(spark):
    data = [("a", None), ("a", ""), ("a", "b"), ("ab", ""), ("1:a", None)]
    df = spark.createDataFrame(data, "x string, y string")
    one = {r[0] for r in df.select(surrogate_id("C", "x", "y")).collect()}
    many = {r[0] for r in df.repartition(5).select(surrogate_id("C", "x", "y")).collect()}
    assert one == many and len(one) == len(data) and all(len(i) == 33 and i[0] == "C" for i in one)
