"""Direct and ultimate parents of the matched register entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.functions.text import upper_key
from namebridge.operators.blocking import spread_join
from namebridge.sources.tables import materialise

# Relationship types of the register.
ROLES = {"direct": "IS_DIRECTLY_CONSOLIDATED_BY", "ultimate": "IS_ULTIMATELY_CONSOLIDATED_BY"}

# Columns of the result.
HIERARCHY_COLUMNS = [
    "run_id", "client_entity_id", "submitted_name", "matched_lei", "matched_name", "matched_source",
    "candidate_method",
    "direct_parent_lei", "direct_parent_name", "direct_relationship_status", "direct_period_start",
    "direct_period_end",
    "ultimate_parent_lei", "ultimate_parent_name", "ultimate_relationship_status", "ultimate_period_start",
    "ultimate_period_end",
    "match_score", "confidence_band", "match_reason",
]


def _role_filter(role: str) -> Column:
    return upper_key(F.col("relationship_type")) == ROLES[role]


def _latest_active(edges: DataFrame) -> DataFrame:
    """One ACTIVE parent per child: the latest period start, then the smallest parent LEI."""
    newest = Window.partitionBy("_child").orderBy(
        F.desc_nulls_last("period_start"), "parent_lei", F.desc_nulls_last("period_end")
    )
    active = edges.filter(upper_key(F.col("relationship_status")) == "ACTIVE")
    return active.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def parents(
    matched_leis: DataFrame, edges: DataFrame, entities: DataFrame, role: str, config: MatchConfig
) -> DataFrame:
    """Parent and parent name per matched LEI in one role, a row per edge.

    Only LEIs that were matched and only edges that have a parent reach the name lookup. So the
    hot LEI of many clients counts once, and no null key is shuffled.
    """
    role_edges = (
        edges.filter(_role_filter(role) & F.col("parent_lei").isNotNull())
        .withColumn("_child", upper_key(F.col("child_lei")))
        .join(matched_leis, F.col("_child") == F.col("matched_lei"), "left_semi")
    )
    if config.active_edges_only:
        role_edges = _latest_active(role_edges)
    names = entities.select(F.col("lei").alias("parent_lei"), F.col("legal_name").alias("_parent_name"))
    return role_edges.join(names, "parent_lei", "left").select(
        F.col("_child").alias("matched_lei"),
        F.col("parent_lei").alias(f"{role}_parent_lei"),
        F.col("_parent_name").alias(f"{role}_parent_name"),
        F.col("relationship_status").alias(f"{role}_relationship_status"),
        F.col("period_start").alias(f"{role}_period_start"),
        F.col("period_end").alias(f"{role}_period_end"),
    )


def enrich_hierarchy(
    matches: DataFrame, edges: DataFrame, entities: DataFrame, config: MatchConfig = MatchConfig()
) -> DataFrame:
    """Add both parents to the match results.

    A match with several parents in a role gives a row per parent unless
    ``config.active_edges_only`` is set.
    """
    given = F.col("matched_lei").isNotNull()
    # One row per LEI, written once: both roles, and the check for hot LEIs, read it.
    counted = materialise(matches.filter(given).groupBy("matched_lei").agg(F.count("*").alias("_matches")), "matched_leis")
    both = matched_leis = counted.select("matched_lei")
    without = matches.filter(~given)
    for role in ROLES:
        both = both.join(parents(matched_leis, edges, entities, role, config), "matched_lei", "left")
    if counted.filter(F.col("_matches") > config.cell_rows).isEmpty():
        found = matches.filter(given).join(both, "matched_lei")
    else:
        # The matches of a hot LEI meet its parents in many cells; the parents are counted and joined, so written.
        both = materialise(both, "parents")
        found = spread_join(matches.filter(given), both, "matched_lei", matches.columns, both.columns, config.cell_rows)
    return found.unionByName(without, allowMissingColumns=True).select(*HIERARCHY_COLUMNS)
