"""Small tables for the tests."""

import random

from namebridge.operators.normalise import clean_clients, clean_internal, clean_reference

CLIENT = "client_entity_id string, submitted_name string, country string, registration_number string, " \
    "lei string, address string"
ENTITY = "lei string, legal_name string, country string, registration_number string, address string"
INTERNAL = "internal_entity_id string, legal_name string, country string, address string, lei string, " \
    "registration_number string, internal_rating string, business_owner string"
EDGE = "child_lei string, parent_lei string, relationship_type string, relationship_status string, " \
    "period_start date, period_end date"
MATCH = "run_id string, client_entity_id string, submitted_name string, matched_reference_id string, " \
    "matched_lei string, matched_name string, matched_source string, candidate_method string, " \
    "match_score double, confidence_band string, match_reason string"


def ordered(rows):
    """Rows in ascending order, nulls last."""
    return sorted(rows, key=lambda row: [(v is None, 0 if v is None else v) for v in row])


def clients(spark, *rows):
    """Rows of (name, country, registration number, lei, address), shorter ones padded with nulls."""
    padded = [(f"C{i}", *r, *[None] * (5 - len(r))) for i, r in enumerate(rows)]
    return clean_clients(spark.createDataFrame(padded, CLIENT))


def reference(spark, *rows):
    """Rows of (lei, name, country, registration number, address)."""
    return clean_reference(spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], ENTITY))


def internal(spark, *rows):
    """Rows of (id, name, lei)."""
    full = [(i, name, None, None, lei, None, "Low", "x") for i, name, lei in rows]
    return clean_internal(spark.createDataFrame(full, INTERNAL))


def random_clients_and_reference(spark, seed=7, n_clients=60, n_entities=240):
    """Names from few words, so that blocks, copies, ties and equal keys all occur."""
    rng = random.Random(seed)
    words = ["the", "of", "a", "bank", "banking", "north", "star", "ab", "abc", "steel", "trust", "Ltd", "日本"]

    def pick(*options):
        return rng.choice(options)

    def name():
        return " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))

    def registration():
        return pick(None, None, "", "r1", "R2", f"r{rng.randint(3, 40)}")

    def address():
        return pick(None, "", "x 1", "x 2 y", "z")

    left = [
        (name(), pick(None, "", "gb", "FR"), registration(), pick(None, None, f"l{rng.randint(0, 300)}"), address())
        for _ in range(n_clients)
    ]
    right = [
        (f"L{i}", name(), pick(None, "GB", "FR", "DE"), registration(), address()) for i in range(n_entities)
    ]
    return clients(spark, *left), reference(spark, *right)
