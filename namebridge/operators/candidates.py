"""Candidate pairs of clients and register entities: by LEI, by registration number, by name block."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.functions.text import is_given
from namebridge.operators.blocking import block_join, block_keys, spread_join

EXACT_LEI = "EXACT_LEI"
REGISTRATION_NUMBER = "REGISTRATION_NUMBER"
NAME_COUNTRY_BLOCK = "NAME_COUNTRY_BLOCK"
NAME_ONLY_BLOCK = "NAME_ONLY_BLOCK"

#: Candidate rows that a preview shows.
PREVIEW_ROWS = 100
#: Keys of clients that are sent to all tasks of the register; with more, which are counted, both sides are shuffled.
KEYS_TO_ALL = 200_000

#: Order in which methods win a tie on score.
METHODS = (EXACT_LEI, REGISTRATION_NUMBER, NAME_COUNTRY_BLOCK, NAME_ONLY_BLOCK)

CANDIDATE_KEY = ["client_entity_id", "reference_id", "candidate_method"]


def client_side(clients: DataFrame) -> DataFrame:
    return clients.select(
        "client_entity_id",
        "submitted_name",
        F.col("clean_name").alias("client_clean_name"),
        F.col("country_norm").alias("client_country"),
        F.col("registration_number_norm").alias("client_registration_number"),
        F.col("lei_norm").alias("client_lei"),
        F.col("address_norm").alias("client_address"),
    )


def reference_side(reference: DataFrame) -> DataFrame:
    return reference.select(
        "reference_id",
        F.col("legal_name").alias("candidate_name"),
        F.col("clean_name").alias("candidate_clean_name"),
        F.col("country_norm").alias("candidate_country"),
        F.col("registration_number_norm").alias("candidate_registration_number"),
        F.col("lei_norm").alias("candidate_lei"),
        F.col("address_norm").alias("candidate_address"),
        F.col("source").alias("candidate_source"),
    )


def same_given(client: Column, candidate: Column) -> Column:
    """Both given and equal; false, never null, otherwise."""
    return F.coalesce(is_given(client) & (client == candidate), F.lit(False))


def _keyed_sides(clients: DataFrame, reference: DataFrame, field: str) -> tuple[DataFrame, DataFrame]:
    left = client_side(clients).withColumn("_key", F.col(f"client_{field}"))
    right = reference_side(reference).withColumn("_key", F.col(f"candidate_{field}"))
    left, right = left.filter(is_given(F.col("_key"))), right.filter(is_given(F.col("_key")))
    keys = left.select("_key").distinct()
    if keys.limit(KEYS_TO_ALL + 1).count() > KEYS_TO_ALL:
        return left, right
    # The register is the larger side, and wide: rows without a client leave before it is shuffled.
    return left, right.join(F.broadcast(keys), "_key", "left_semi")


def pairs_by_lei(clients: DataFrame, reference: DataFrame) -> DataFrame:
    """Pairs with an equal LEI.

    The register has one row per LEI: a hot LEI is hot on the client side only, its pairs are as
    many as its clients, and adaptive execution splits such a partition.
    """
    left, right = _keyed_sides(clients, reference, "lei")
    return left.join(right, "_key").drop("_key")


def pairs_by_registration(clients: DataFrame, reference: DataFrame, config: MatchConfig) -> DataFrame:
    """Pairs with an equal registration number, which may be common on both sides."""
    left, right = _keyed_sides(clients, reference, "registration_number")
    return spread_join(left, right, "_key", ["client_entity_id"], ["reference_id"], config.cell_rows).drop("_key")


def pairs_by_name(clients: DataFrame, reference: DataFrame, config: MatchConfig) -> DataFrame:
    return block_join(
        client_side(clients), reference_side(reference), "client_clean_name", "candidate_clean_name",
        prefix_length=config.prefix_length, cell_rows=config.cell_rows, include_empty=config.include_empty_block,
    )


def in_same_country() -> Column:
    return same_given(F.col("client_country"), F.col("candidate_country"))


def lei_candidates(clients: DataFrame, reference: DataFrame) -> DataFrame:
    return pairs_by_lei(clients, reference).withColumn("candidate_method", F.lit(EXACT_LEI))


def registration_candidates(
    clients: DataFrame, reference: DataFrame, config: MatchConfig = MatchConfig()
) -> DataFrame:
    pairs = pairs_by_registration(clients, reference, config)
    return pairs.withColumn("candidate_method", F.lit(REGISTRATION_NUMBER))


def name_only_candidates(clients: DataFrame, reference: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    return pairs_by_name(clients, reference, config).withColumn("candidate_method", F.lit(NAME_ONLY_BLOCK))


def name_country_candidates(
    clients: DataFrame, reference: DataFrame, config: MatchConfig = MatchConfig()
) -> DataFrame:
    """The name block within one country; the country is part of the join key."""
    pairs = block_join(
        client_side(clients), reference_side(reference), "client_clean_name", "candidate_clean_name",
        left_extra="client_country", right_extra="candidate_country",
        prefix_length=config.prefix_length, cell_rows=config.cell_rows, include_empty=config.include_empty_block,
    )
    return pairs.withColumn("candidate_method", F.lit(NAME_COUNTRY_BLOCK))


def name_candidates(clients: DataFrame, reference: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Both name methods from one join: every pair, and once more if the country agrees."""
    methods = F.when(
        in_same_country(), F.array(F.lit(NAME_COUNTRY_BLOCK), F.lit(NAME_ONLY_BLOCK))
    ).otherwise(F.array(F.lit(NAME_ONLY_BLOCK)))
    return pairs_by_name(clients, reference, config).withColumn("candidate_method", F.explode(methods))


def generate_candidates(
    clients: DataFrame,
    reference: DataFrame,
    config: MatchConfig = MatchConfig(),
    *,
    ids_are_keys: bool = False,
) -> DataFrame:
    """All candidate rows, distinct by client, register entity and method.

    Each method emits a pair of rows once, so with unique ``client_entity_id`` and ``reference_id``
    (which ingest and the register build guarantee) no duplicate can arise. That is looked up, from the ids alone, and
    only if an id repeats is the pair table, the largest of the run, shuffled to be de-duplicated. ``ids_are_keys=True``
    states that none does.
    """
    parts = [
        lei_candidates(clients, reference),
        registration_candidates(clients, reference, config),
        name_candidates(clients, reference, config),
    ]
    candidates = reduce(DataFrame.unionByName, parts)
    if ids_are_keys or not (_repeats(clients, "client_entity_id") or _repeats(reference, "reference_id")):
        return candidates
    return candidates.dropDuplicates(CANDIDATE_KEY)


def _repeats(rows: DataFrame, row_id: str) -> bool:
    """Whether two rows have one id, or none."""
    return not rows.groupBy(row_id).agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty()


def clients_in_preview(
    clients: DataFrame, reference: DataFrame, config: MatchConfig = MatchConfig(), rows: int = PREVIEW_ROWS
) -> DataFrame:
    """The rows of ``clients`` of which ``candidate_preview`` can show candidates.

    Each client that shares a key with the register has a candidate row, and rows are shown by client id; so these are
    the first ``rows`` ids that share one. No pair is built to find them.
    """

    def with_block(side: DataFrame) -> DataFrame:
        name = F.col("clean_name")
        wanted = name.isNotNull() if config.include_empty_block else name != ""
        return side.filter(wanted).withColumn("_key", F.explode(block_keys(name, config.prefix_length)))

    sides = [_keyed_sides(clients, reference, field) for field in ("lei", "registration_number")]
    sides.append((with_block(clients), with_block(reference)))
    found = (left.join(right.select("_key").distinct(), "_key", "left_semi").select("client_entity_id") for left, right in sides)
    first = reduce(DataFrame.unionByName, found).distinct().orderBy("client_entity_id").limit(rows)
    first = F.broadcast(first.withColumnRenamed("client_entity_id", "_first"))
    return clients.join(first, F.col("client_entity_id").eqNullSafe(F.col("_first")), "left_semi")


def candidate_preview(candidates: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    return candidates.orderBy(*CANDIDATE_KEY).limit(rows)
