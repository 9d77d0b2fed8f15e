"""Similarity of names and fields.

Everything is a native Column expression except the matching-blocks ratio, for which Spark has no
function; it is one Arrow UDF that takes a batch at a time, and callers hand it distinct names.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from namebridge.config import MatchConfig
from namebridge.functions import matching_blocks, name_cells
from namebridge.functions.matching_blocks import ratios
from namebridge.functions.text import is_given

# The UDF travels with its code, so executors need no installed package.
for module in (matching_blocks, name_cells, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(module)

# Whitespace as Python's str.split() sees it: Unicode white space and the separators 1c-1f.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"

#: Evidence of a field that the client did not give, and of one that only the candidate lacks.
FIELD_NOT_GIVEN, FIELD_MISSING = 0.5, 0.3
ADDRESS_NOT_GIVEN = 0.5


@F.pandas_udf(DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two names, 0 if either is missing. Not symmetric: client first."""
    return pd.Series(ratios(left.tolist(), right.tolist()))


@F.pandas_udf(DoubleType())
def sequence_ratio_with_heuristic(left: pd.Series, right: pd.Series) -> pd.Series:
    """The same with the popularity heuristic for long names on the right."""
    return pd.Series(ratios(left.tolist(), right.tolist(), popularity_heuristic=True))


def levenshtein_similarity(left: Column, right: Column) -> Column:
    """``1 - edits / longer length``; 0 if either is missing."""
    longer = F.greatest(F.length(left), F.length(right))
    return F.when(
        is_given(left) & is_given(right), F.lit(1.0) - F.levenshtein(left, right) / longer
    ).otherwise(F.lit(0.0))


def name_similarity(left: Column, right: Column, config: MatchConfig) -> Column:
    """The similarity that the configuration names."""
    if config.similarity == "levenshtein":
        return levenshtein_similarity(left, right)
    return (sequence_ratio_with_heuristic if config.popularity_heuristic else sequence_ratio)(left, right)


def token_set(text: Column) -> Column:
    """Distinct whitespace-separated tokens; null stays null."""
    return F.array_distinct(F.array_remove(F.split(text, WHITESPACE), ""))


def jaccard(left: Column, right: Column) -> Column:
    """Overlap of two distinct-token arrays; 0 if either is null or empty.

    Pass columns rather than expressions: the arrays are used more than once.
    """
    shared = F.array_size(F.array_intersect(left, right))
    return F.coalesce(shared / F.nullif(F.array_size(left) + F.array_size(right) - shared, F.lit(0)), F.lit(0.0))


def token_overlap(left: Column, right: Column) -> Column:
    """Jaccard overlap of the whitespace-separated tokens of two texts."""
    return jaccard(token_set(left), token_set(right))


def field_match_score(client: Column, candidate: Column) -> Column:
    """Evidence of an optional field: a client that gave none is neutral."""
    return (
        F.when(~is_given(client), F.lit(FIELD_NOT_GIVEN))
        .when(~is_given(candidate), F.lit(FIELD_MISSING))
        .when(client == candidate, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


def address_score(client: Column, client_tokens: Column, candidate_tokens: Column) -> Column:
    """Token overlap of the addresses; neutral without a client address, weak without a candidate's."""
    return (
        F.when(~is_given(client), F.lit(ADDRESS_NOT_GIVEN))
        .when((F.array_size(client_tokens) > 0) & (F.array_size(candidate_tokens) > 0), jaccard(client_tokens, candidate_tokens))
        .otherwise(F.lit(FIELD_MISSING))
    )
