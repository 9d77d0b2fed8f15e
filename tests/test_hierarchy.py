from datetime import date

from namebridge.config import MatchConfig
from namebridge.operators.hierarchy import enrich_hierarchy
from tests.builders import EDGE, MATCH, ordered

DIRECT, ULTIMATE = "IS_DIRECTLY_CONSOLIDATED_BY", "IS_ULTIMATELY_CONSOLIDATED_BY"


def match(client, lei):
    return ("r", client, "n", lei, lei, "m", "GLEIF", "EXACT_LEI", 0.9, "AUTO_MATCH", "x")


def tables(spark):
    matches = spark.createDataFrame([match("C1", "L1"), match("C2", "L1"), match("C3", "L9"), match("C4", None)], MATCH)
    edges = spark.createDataFrame(
        [
            (" l1 ", "P1", f" {DIRECT.lower()} ", "ACTIVE", date(2018, 1, 1), None),
            ("L1", "P2", DIRECT, "active", date(2019, 1, 1), None),
            ("L1", "P3", DIRECT, "INACTIVE", date(2020, 1, 1), None),
            ("L1", "U1", ULTIMATE, "ACTIVE", None, None),
            ("L9", None, DIRECT, "ACTIVE", None, None),
            ("L8", "P1", DIRECT, "ACTIVE", None, None),
            ("L1", "P1", "IS_FUND_MANAGED_BY", "ACTIVE", None, None),
        ],
        EDGE,
    )
    entities = spark.createDataFrame([("P1", "Parent 1"), ("P2", "Parent 2"), ("U1", "Top")], "lei string, legal_name string")
    return matches, edges, entities


def test_every_parent_gives_a_row(spark, rows):
    got = rows(
        enrich_hierarchy(*tables(spark)), "client_entity_id", "direct_parent_lei", "direct_parent_name",
        "ultimate_parent_lei", "ultimate_parent_name",
    )
    per_client = [("P1", "Parent 1", "U1", "Top"), ("P2", "Parent 2", "U1", "Top"), ("P3", None, "U1", "Top")]
    expected = [(c, *p) for c in ("C1", "C2") for p in per_client]
    assert got == ordered(expected + [("C3", None, None, None, None), ("C4", None, None, None, None)])


def test_active_edges_only_keeps_the_latest(spark, rows):
    config = MatchConfig(active_edges_only=True)
    got = rows(
        enrich_hierarchy(*tables(spark), config), "client_entity_id", "direct_parent_lei", "direct_relationship_status",
        "direct_period_start",
    )
    latest = ("P2", "active", date(2019, 1, 1))
    assert got == [("C1", *latest), ("C2", *latest), ("C3", None, None, None), ("C4", None, None, None)]
