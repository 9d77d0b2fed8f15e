"""Entity tables ready for matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.contracts import CLIENT_RAW, INTERNAL_RAW, REFERENCE_RAW, check
from namebridge.functions.text import normalise
from namebridge.sources.headers import fill_missing

#: Source tag of register rows. Internal entities never join this set: they have no parents.
REGISTER_SOURCE = "GLEIF"


def clean_clients(clients: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    return normalise(check(clients, CLIENT_RAW, "Clients"), "submitted_name", config.prefix_length)


def clean_internal(internal: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    rows = fill_missing(internal, ["registration_number"])
    check(rows, INTERNAL_RAW, "Internal entities")
    return normalise(rows.select(*INTERNAL_RAW.fieldNames()), "legal_name", config.prefix_length)


def clean_reference(entities: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    check(entities, REFERENCE_RAW, "Register entities")
    rows = entities.select(
        F.col("lei").alias("reference_id"), "legal_name", "country", "address", "lei", "registration_number",
        F.lit(REGISTER_SOURCE).alias("source"),
    )
    return normalise(rows, "legal_name", config.prefix_length)
