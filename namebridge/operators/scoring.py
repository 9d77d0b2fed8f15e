"""Scores, bands and reasons of candidate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.functions.rounding import rounded
from namebridge.functions.similarity import (
    address_score,
    field_match_score,
    jaccard,
    levenshtein_similarity,
    name_similarity,
    token_set,
)
from namebridge.functions.text import is_given
from namebridge.operators.blocking import spread_rows
from namebridge.operators.candidates import NAME_COUNTRY_BLOCK, same_given
from namebridge.sources.tables import materialise

# Weights of the evidence.
REGISTRATION_BASE, REGISTRATION_NAME_WEIGHT, REGISTRATION_COUNTRY_WEIGHT = 0.80, 0.10, 0.10
NAME_WEIGHT, TOKEN_WEIGHT, COUNTRY_WEIGHT, ADDRESS_WEIGHT = 0.60, 0.20, 0.15, 0.05

_NAMES = ["client_clean_name", "candidate_clean_name"]


def same_lei() -> Column:
    return same_given(F.col("client_lei"), F.col("candidate_lei"))


def same_registration() -> Column:
    return same_given(F.col("client_registration_number"), F.col("candidate_registration_number"))


def country_evidence() -> Column:
    return field_match_score(F.col("client_country"), F.col("candidate_country"))


def with_evidence(candidates: DataFrame) -> DataFrame:
    """Add the four field scores a match score is made of, next to ``name_similarity``."""
    token_columns = ["client_clean_name", "candidate_clean_name", "client_address", "candidate_address"]
    tokens = candidates.withColumns({f"_{c}_tokens": token_set(F.col(c)) for c in token_columns})
    return tokens.withColumns({
        "token_score": jaccard(F.col("_client_clean_name_tokens"), F.col("_candidate_clean_name_tokens")),
        "country_score": country_evidence(),
        "address_score": address_score(
            F.col("client_address"), F.col("_client_address_tokens"), F.col("_candidate_address_tokens")
        ),
    }).drop(*[f"_{c}_tokens" for c in token_columns])


def score_by_name(config: MatchConfig) -> Column:
    """Weighted evidence with the bonus of the country block, capped and rounded."""
    total = (
        NAME_WEIGHT * F.col("name_similarity")
        + TOKEN_WEIGHT * F.col("token_score")
        + COUNTRY_WEIGHT * F.col("country_score")
        + ADDRESS_WEIGHT * F.col("address_score")
    )
    bonus = F.when(F.col("candidate_method") == NAME_COUNTRY_BLOCK, F.lit(config.country_bonus)).otherwise(F.lit(0.0))
    return rounded(F.least(total + bonus, F.lit(config.score_cap)), config)


def match_score(config: MatchConfig) -> Column:
    """Score of a row from its evidence; which rule applies depends on the fields alone."""
    by_registration = (
        F.lit(REGISTRATION_BASE)
        + REGISTRATION_NAME_WEIGHT * F.col("name_similarity")
        + REGISTRATION_COUNTRY_WEIGHT * F.col("country_score")
    )
    return (
        F.when(same_lei(), F.lit(config.lei_score))
        .when(same_registration(), rounded(by_registration, config))
        .otherwise(score_by_name(config))
    )


def confidence_band(score: Column, config: MatchConfig) -> Column:
    return (
        F.when(score.isNull(), "NO_MATCH")
        .when(score >= config.auto_threshold, "AUTO_MATCH")
        .when(score >= config.review_threshold, "REVIEW")
        .otherwise("LOW_CONFIDENCE")
    )


def match_reason() -> Column:
    client, candidate = F.col("client_country"), F.col("candidate_country")
    country = (
        F.when(~(is_given(client) & is_given(candidate)), "country_not_provided_or_missing")
        .when(client == candidate, "country_match=True")
        .otherwise("country_match=False")
    )
    return F.concat_ws(
        "; ",
        F.concat(F.lit("candidate_method="), F.col("candidate_method")),
        F.when(same_lei(), "exact_lei_match"),
        F.when(same_registration(), "registration_number_match"),
        country,
    )


def country_match() -> Column:
    """Null if only the candidate's country is missing, false if the client's is."""
    return F.col("client_country").isNotNull() & (F.col("client_country") == F.col("candidate_country"))


def with_verdict(scored: DataFrame, config: MatchConfig) -> DataFrame:
    return scored.withColumns({
        "confidence_band": confidence_band(F.col("match_score"), config),
        "match_reason": match_reason(),
        "country_match": country_match(),
    })


def with_name_similarity(candidates: DataFrame, config: MatchConfig) -> DataFrame:
    """Add ``name_similarity``. The UDF form runs once per distinct pair of names that needs it."""
    if config.similarity == "levenshtein":
        return candidates.withColumn("name_similarity", levenshtein_similarity(*map(F.col, _NAMES)))
    needed = candidates.filter(~same_lei() & is_given(F.col(_NAMES[0])) & is_given(F.col(_NAMES[1])))
    distinct = spread_rows(needed.select(*_NAMES).distinct(), *_NAMES)
    names = map(F.col, _NAMES)
    # Written, so that the join shuffles both sides and adaptive execution can split a frequent pair.
    ratios = materialise(distinct.withColumn("name_similarity", name_similarity(*names, config)), "ratios")
    return candidates.join(ratios, _NAMES, "left").withColumn(
        "name_similarity", F.coalesce("name_similarity", F.lit(0.0))
    )


def score_rows(rows: DataFrame, config: MatchConfig) -> DataFrame:
    """Rows that have their ``name_similarity``, with score, band, reason and country verdict."""
    scored = with_evidence(rows).withColumn("match_score", match_score(config))
    return with_verdict(
        scored.drop("name_similarity", "token_score", "country_score", "address_score"), config
    )


def score_candidates(candidates: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Every candidate row with its score, band, reason and country verdict."""
    return score_rows(with_name_similarity(candidates, config), config)
