"""Name cleaning, key normalisation and blocking keys as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The legal words that carry no identity.
LEGAL_WORDS = (
    "inc", "incorporated", "ltd", "limited", "llc", "plc", "corp", "corporation", "co", "company",
    "ag", "sa", "bv", "nv", "gmbh", "pte", "pty", "holdings", "holding", "group",
)
LEGAL_WORD_PATTERN = r"\b(" + "|".join(LEGAL_WORDS) + r")\b"

NORMALISED_COLUMNS = (
    "clean_name", "country_norm", "registration_number_norm", "lei_norm", "address_norm",
    "first_token", "name_prefix_4", "blocking_key",
)


def clean_name(name: Column, *, strip_legal: bool = True, null_as_empty: bool = False) -> Column:
    """Lower-case ASCII words without punctuation or legal words, single-spaced.

    Letters outside ``a-z`` become spaces; accents are not folded.
    """
    words = F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit(" and ")), r"[^a-z0-9\s]", " ")
    if strip_legal:
        words = F.regexp_replace(words, LEGAL_WORD_PATTERN, " ")
    cleaned = F.trim(F.regexp_replace(words, r"\s+", " "))
    return F.coalesce(cleaned, F.lit("")) if null_as_empty else cleaned


def upper_key(value: Column) -> Column:
    return F.upper(F.trim(value))


def lower_key(value: Column) -> Column:
    return F.lower(F.trim(value))


def null_if_blank(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def is_given(value: Column) -> Column:
    """True when the value is neither null nor empty (never null itself)."""
    return value.isNotNull() & (value != "")


def first_token(cleaned: Column) -> Column:
    return F.substring_index(cleaned, " ", 1)


def name_prefix(cleaned: Column, length: int = 4) -> Column:
    return F.substring(cleaned, 1, length)


def normalise(df: DataFrame, name_column: str, prefix_length: int = 4) -> DataFrame:
    """Add the cleaned name, the normalised keys and the blocking keys to an entity table."""
    keys = df.withColumns({
        "clean_name": clean_name(F.col(name_column)),
        "country_norm": upper_key(F.col("country")),
        "registration_number_norm": upper_key(F.col("registration_number")),
        "lei_norm": upper_key(F.col("lei")),
        "address_norm": lower_key(F.col("address")),
    })
    blocks = keys.withColumns({
        "first_token": first_token(F.col("clean_name")),
        "name_prefix_4": name_prefix(F.col("clean_name"), prefix_length),
    })
    return blocks.withColumn("blocking_key", F.concat_ws("|", "country_norm", "name_prefix_4"))
