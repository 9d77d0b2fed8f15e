"""Ranking of scored candidates: the best match and the review queue of each client."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.operators.candidates import METHODS


def candidate_order(reference_id: str) -> list[Column]:
    """Best score first, ties by method order and then reference id."""
    method_order = F.array_position(F.array(*map(F.lit, METHODS)), F.col("candidate_method"))
    return [F.desc("match_score"), method_order, F.col(reference_id)]


def rank_candidates(scored: DataFrame, depth: int | None = None) -> DataFrame:
    """Number the rows of each client, the best first.

    With ``depth`` only the leading rows stay; Spark then cuts every partition to that depth
    before the shuffle, so a client with very many candidates is no hot spot.
    """
    window = Window.partitionBy("client_entity_id").orderBy(*candidate_order("reference_id"))
    ranked = scored.withColumn("candidate_rank", F.row_number().over(window))
    return ranked if depth is None else ranked.filter(F.col("candidate_rank") <= depth)


def _result_columns(run_id: str) -> dict:
    return {
        "run_id": F.lit(run_id),
        "matched_reference_id": F.col("reference_id"),
        "matched_lei": F.col("candidate_lei"),
        "matched_name": F.col("candidate_name"),
        "matched_source": F.col("candidate_source"),
        "created_timestamp": F.current_timestamp(),
        "review_status": F.lit("PENDING"),
        "reviewer": F.lit(None).cast("string"),
        "review_comment": F.lit(None).cast("string"),
    }


# Columns of both results.
MATCH_RESULT_COLUMNS = [
    "run_id", "client_entity_id", "submitted_name", "matched_reference_id", "matched_lei", "matched_name",
    "matched_source", "candidate_method", "match_score", "confidence_band", "match_reason", "country_match",
    "created_timestamp",
]
REVIEW_QUEUE_COLUMNS = [
    "run_id", "client_entity_id", "submitted_name", "candidate_rank", "matched_reference_id", "matched_lei",
    "matched_name", "matched_source", "candidate_method", "match_score", "match_reason", "review_status",
    "reviewer", "review_comment", "created_timestamp",
]


def match_results(
    ranked: DataFrame, config: MatchConfig = MatchConfig(), clients: DataFrame | None = None
) -> DataFrame:
    """The best row of each client.

    With ``config.keep_unmatched`` the given ``clients`` without any candidate follow, in band
    ``NO_MATCH``, so that they can still reach the internal list by their submitted name.
    """
    best = ranked.filter(F.col("candidate_rank") == 1)
    if config.keep_unmatched:
        if clients is None:
            raise ValueError("keep_unmatched needs the clients")
        without = clients.select("client_entity_id", "submitted_name").join(
            best.select("client_entity_id"), "client_entity_id", "left_anti"
        )
        best = best.unionByName(
            without.withColumn("confidence_band", F.lit("NO_MATCH")), allowMissingColumns=True
        )
    return best.withColumns(_result_columns(config.run_id)).select(*MATCH_RESULT_COLUMNS)


def review_queue(ranked: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """The leading rows of each client, whatever their band."""
    leading = ranked.filter(F.col("candidate_rank") <= config.review_depth)
    return leading.withColumns(_result_columns(config.run_id)).select(*REVIEW_QUEUE_COLUMNS)
