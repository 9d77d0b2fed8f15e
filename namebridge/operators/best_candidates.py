"""The leading candidates of each client without building the whole scored pair table.

Same rows as ``rank_candidates(score_candidates(generate_candidates(...)), depth)``, cheaper:

* Profiles, not rows, are paired: the distinct (cleaned name, country) of clients without an
  address and of the register, and (cleaned name, country, address) where the client gave one.
  Copies add nothing to that.
* The pairs are scored where the block join makes them, evenly spread by its cells, and cut to
  ``depth`` per client profile before anything is shuffled.
* What is left joins the clients, and per register profile the ``depth`` smallest reference ids:
  further copies tie on score and lose on id.

Pairs with an equal LEI or registration number are scored by other rules, so they are built row by
row from equi-joins on those keys. A profile pair may stand for such a pair as well; it then takes
a place that the real row, which never scores less (0.99, or 0.80 and more, against the cap of
0.98), takes too. So no other row is lost by it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from namebridge.config import MatchConfig
from namebridge.functions.name_cells import Scores, leading_pairs
from namebridge.functions.similarity import (
    ADDRESS_NOT_GIVEN,
    FIELD_MISSING,
    FIELD_NOT_GIVEN,
    address_score,
    field_match_score,
    jaccard,
    name_similarity,
    token_set,
)
from namebridge.functions.text import first_token, is_given, name_prefix
from namebridge.operators.blocking import block_join
from namebridge.operators.candidates import (
    EXACT_LEI,
    NAME_COUNTRY_BLOCK,
    NAME_ONLY_BLOCK,
    REGISTRATION_NUMBER,
    client_side,
    generate_candidates,
    in_same_country,
    pairs_by_lei,
    pairs_by_registration,
    reference_side,
    same_given,
)
from namebridge.operators.ranking import candidate_order, rank_candidates
from namebridge.operators.register_index import (
    PROFILE,
    RegisterIndex,
    in_lists,
    named_profiles,
    with_block_keys,
    with_profile,
)
from namebridge.operators.scoring import (
    ADDRESS_WEIGHT,
    COUNTRY_WEIGHT,
    NAME_WEIGHT,
    TOKEN_WEIGHT,
    confidence_band,
    same_lei,
    same_registration,
    score_by_name,
    score_candidates,
    score_rows,
    with_evidence,
)
from namebridge.sources.tables import materialise

#: Client names in a list, and the lists of a key beyond which it is joined apart, in a grid.
_CLIENT_LISTS, _LISTS_OF_A_KEY = 64, 16


def _keyed_rules_never_score_less(config: MatchConfig) -> bool:
    """True where the module's last argument holds: a keyed row scores at least as much as by its name alone.

    By LEI that is so if the LEI score reaches the cap. By registration number and with equal countries the score is
    0.90 + 0.10 ratio, by name at most the cap and at most 0.40 + 0.60 ratio + bonus. Up to ratio = 1 - 2 bonus the
    latter is no larger; from there on the former is at least 1 - 0.20 bonus, which the cap must not exceed. With other
    countries there is no bonus and the score by number is never less.
    """
    bonus = config.country_bonus
    return 0 <= bonus <= 0.5 and config.score_cap <= min(config.lei_score, 1 - 0.2 * bonus)


def _profile(side: str, with_address: bool) -> list[str]:
    return [f"{side}_clean_name", f"_{side}_country"] + ([f"_{side}_address"] if with_address else [])


def _profile_tokens(profiles: DataFrame, side: str, with_address: bool) -> DataFrame:
    tokens = {f"_{side}_tokens": token_set(F.col(f"{side}_clean_name"))}
    if with_address:
        tokens[f"_{side}_address_tokens"] = token_set(F.col(f"_{side}_address"))
    return profiles.withColumns(tokens)


def _evidence(with_address: bool) -> dict[str, Column]:
    countries = F.col("_client_country"), F.col("_candidate_country")
    address = (
        address_score(
            F.col("_client_address"), F.col("_client_address_tokens"), F.col("_candidate_address_tokens")
        )
        if with_address
        else F.lit(ADDRESS_NOT_GIVEN)
    )
    return {
        "token_score": jaccard(F.col("_client_tokens"), F.col("_candidate_tokens")),
        "country_score": field_match_score(*countries),
        "address_score": address,
        # The better of the methods that find the pair.
        "candidate_method": F.when(same_given(*countries), NAME_COUNTRY_BLOCK).otherwise(NAME_ONLY_BLOCK),
    }


def leading_profile_pairs(
    clients: DataFrame, reference: DataFrame, config: MatchConfig, depth: int, with_address: bool
) -> DataFrame:
    """The ``depth`` best register profiles per client profile, with their name similarity."""
    left_profile, right_profile = _profile("client", with_address), _profile("candidate", with_address)
    left = _profile_tokens(clients.select(*left_profile).distinct(), "client", with_address)
    right = _profile_tokens(
        reference.groupBy(*right_profile).agg(F.min("reference_id").alias("_first_id")), "candidate", with_address
    )
    pairs = block_join(
        left, right, "client_clean_name", "candidate_clean_name",
        prefix_length=config.prefix_length, cell_rows=config.cell_rows, include_empty=config.include_empty_block,
    )
    evidence = _evidence(with_address)
    names = F.col("client_clean_name"), F.col("candidate_clean_name")
    best_first = Window.partitionBy(*left_profile).orderBy(*candidate_order("_first_id"))
    return (
        pairs.withColumns(evidence)
        .select(*left_profile, *right_profile, "_first_id", *evidence)
        .withColumn("name_similarity", name_similarity(*names, config))
        .withColumn("match_score", score_by_name(config))
        .withColumn("_n", F.row_number().over(best_first))
        .filter(F.col("_n") <= depth)
        .select(*left_profile, *right_profile, "name_similarity")
    )


def _first_copies(reference: DataFrame, profile: list[str], depth: int) -> DataFrame:
    """The smallest reference ids of each register profile."""
    by_id = Window.partitionBy(*profile).orderBy("reference_id")
    return reference.withColumn("_n", F.row_number().over(by_id)).filter(F.col("_n") <= depth).drop("_n")


def _in_block(config: MatchConfig) -> Column:
    left, right = F.col("client_clean_name"), F.col("candidate_clean_name")
    shared = (first_token(left) == first_token(right)) | (
        name_prefix(left, config.prefix_length) == name_prefix(right, config.prefix_length)
    )
    return F.coalesce(shared, F.lit(False)) & (F.lit(config.include_empty_block) | is_given(left))


def _with_methods(pairs: DataFrame, found_by_name: Column, *others: Column) -> DataFrame:
    """One row per method that finds the pair."""
    methods = F.array(
        F.when(found_by_name & in_same_country(), NAME_COUNTRY_BLOCK),
        F.when(found_by_name, NAME_ONLY_BLOCK),
        *others,
    )
    return pairs.withColumn("candidate_method", F.explode(F.array_compact(methods)))


def _by_name(
    clients: DataFrame, reference: DataFrame, config: MatchConfig, depth: int, with_address: bool
) -> DataFrame:
    gave_address = is_given(F.col("client_address"))
    left = with_profile(client_side(clients), "client").filter(gave_address if with_address else ~gave_address)
    right = with_profile(reference_side(reference), "candidate")
    left_profile, right_profile = _profile("client", with_address), _profile("candidate", with_address)
    # Written, so that both joins shuffle both sides and adaptive execution can split a frequent profile.
    leading = materialise(leading_profile_pairs(left, right, config, depth, with_address), "leading_pairs")
    pairs = (
        leading.join(left, left_profile)
        .join(_first_copies(right, right_profile, depth), right_profile)
        .filter(~same_lei() & ~same_registration())
    )
    profile_columns = [f"_{side}_{field}" for side in ("client", "candidate") for field in ("country", "address")]
    return _with_methods(pairs.drop(*profile_columns), F.lit(True))


def _by_key(clients: DataFrame, reference: DataFrame, config: MatchConfig) -> DataFrame:
    by_lei = pairs_by_lei(clients, reference)
    return _scored_by_key(by_lei, pairs_by_registration(clients, reference, config), config)


def _scored_by_key(by_lei: DataFrame, by_registration: DataFrame, config: MatchConfig) -> DataFrame:
    by_registration = by_registration.filter(~same_lei())
    # An equal LEI settles the score: no need to compare the names.
    client_name = F.when(~same_lei(), F.col("client_clean_name"))
    similarity = name_similarity(client_name, F.col("candidate_clean_name"), config)
    pairs = by_lei.unionByName(by_registration).withColumn("name_similarity", similarity)
    by_lei_method = F.when(same_lei(), EXACT_LEI)
    by_registration_method = F.when(same_registration(), REGISTRATION_NUMBER)
    return _with_methods(pairs, _in_block(config), by_lei_method, by_registration_method)


def _cells_by_index(clients: DataFrame, index: RegisterIndex, config: MatchConfig) -> DataFrame:
    """(_key, _client_cell, _clients, _candidates): lists of client names with the lists of register names they meet."""
    left_profile = _profile("client", with_address=True)
    profiles = clients.select(*left_profile).distinct().withColumn(
        "_client_address_tokens", token_set(F.col("_client_address")))
    named = named_profiles(profiles, left_profile[0], [*left_profile[1:], "_client_address_tokens"])
    named = named.withColumnRenamed("_profiles", "_client_profiles").withColumnRenamed("_list", "_client_list")
    named = named.withColumn("_client_tokens", token_set(F.col(left_profile[0])))
    keyed = materialise(with_block_keys(named, left_profile[0], config), "client_keys")
    lists = materialise(in_lists(keyed, [left_profile[0], "_client_list"], _CLIENT_LISTS, "_client_cell", "_clients"),
                        "client_lists")
    return index.lists("_candidates").join(lists, ["_client_cell"], _LISTS_OF_A_KEY)


def _scores(config: MatchConfig) -> Scores:
    """How ``score_by_name`` weighs a pair."""
    return Scores(
        NAME_WEIGHT, TOKEN_WEIGHT, COUNTRY_WEIGHT, ADDRESS_WEIGHT, config.country_bonus, config.score_cap,
        FIELD_NOT_GIVEN, FIELD_MISSING, ADDRESS_NOT_GIVEN, config.similarity == "levenshtein",
        config.popularity_heuristic,
    )


def compared_by_index(
    clients: DataFrame, index: RegisterIndex, config: MatchConfig, depth: int, floor: float = -1.0
) -> DataFrame:
    """Pairs of client and register profiles with their evidence by name and the better of the methods that find them.

    All pairs of a block are compared in their cell. Those leave it that can be among the ``depth`` best of a client
    profile, and with depth 0 those whose score can reach the floor.
    """
    left_profile = _profile("client", with_address=True)
    cells = _cells_by_index(clients, index, config)
    members = [f for side in ("_clients", "_candidates") for f in cells.schema[side].dataType.elementType]
    schema = T.StructType([*members, T.StructField("name_similarity", T.DoubleType())])
    leading = leading_pairs(_scores(config), depth, floor, config.prefix_length, to_arrow_schema(schema))
    compared = cells.select("_key", "_client_cell", "_clients", "_candidates").mapInArrow(leading, schema)
    names = F.col(left_profile[0]), F.col(PROFILE[0])
    compared = compared.withColumn("token_score", jaccard(F.col("_client_tokens"), F.col("_candidate_tokens")))
    spread = (
        compared.select(*names, "name_similarity", "token_score", "_candidate_profiles", F.inline("_client_profiles"))
        .select(*left_profile, "_client_address_tokens", PROFILE[0], "name_similarity", "token_score",
                F.inline("_candidate_profiles"))
    )
    countries = F.col("_client_country"), F.col("_candidate_country")
    return spread.withColumns({
        "country_score": field_match_score(*countries),
        "address_score": address_score(
            F.col("_client_address"), F.col("_client_address_tokens"), F.col("_address_tokens")),
        # The better of the methods that find the pair.
        "candidate_method": F.when(same_given(*countries), NAME_COUNTRY_BLOCK).otherwise(NAME_ONLY_BLOCK),
    })


def _leading_by_index(clients: DataFrame, index: RegisterIndex, config: MatchConfig, depth: int) -> DataFrame:
    """The ``depth`` best register profiles per client profile, with their name similarity; names meet once."""
    left_profile = _profile("client", with_address=True)
    best_first = Window.partitionBy(*left_profile).orderBy(*candidate_order("_first_id"))
    return (
        compared_by_index(clients, index, config, depth)
        .withColumn("match_score", score_by_name(config))
        .select(*left_profile, *PROFILE, "_first_id", "candidate_method", "match_score", "name_similarity")
        .withColumn("_n", F.row_number().over(best_first))
        .filter(F.col("_n") <= depth)
        .select(*left_profile, *PROFILE, "name_similarity")
    )


def _rows_by_index(clients: DataFrame, index: RegisterIndex, config: MatchConfig, depth: int) -> DataFrame:
    """The same rows as ``_by_name`` and ``_by_key`` give; no register table is shuffled or counted."""
    left = with_profile(client_side(clients), "client")
    left_profile = _profile("client", with_address=True)
    leading = materialise(_leading_by_index(left, index, config, depth), "leading_pairs")
    pairs = leading.join(left, left_profile)
    copies = index.copies.filter(F.col("_n") <= depth).drop("_n")
    by_name = pairs.join(copies, PROFILE).filter(~same_lei() & ~same_registration())
    profile_columns = [f"_{side}_{field}" for side in ("client", "candidate") for field in ("country", "address")]
    by_name = _with_methods(by_name.drop(*profile_columns), F.lit(True))
    return by_name.unionByName(_scored_by_key(*_pairs_by_index(clients, index, config), config))


def _pairs_by_index(clients: DataFrame, index: RegisterIndex, config: MatchConfig) -> tuple[DataFrame, DataFrame]:
    """Pairs of rows with an equal LEI, and with an equal registration number."""
    plain = client_side(clients)

    def keyed(field: str) -> DataFrame:
        return plain.filter(is_given(F.col(field))).withColumn("_key", F.col(field))

    by_lei = index.leis.join(keyed("client_lei"), ["client_entity_id"], config.cell_rows).drop("_key")
    by_number = index.numbers.join(
        keyed("client_registration_number"), ["client_entity_id"], config.cell_rows).drop("_key")
    return by_lei, by_number


def _pairs_by_method(clients: DataFrame, reference: DataFrame, config: MatchConfig) -> DataFrame:
    """(candidate_method, n) of the two name blocks, from counts by block, prefix and country: no pair is built."""

    def counted(rows: DataFrame, side: str) -> DataFrame:
        name = F.col(f"{side}_clean_name")
        keyed = with_block_keys(rows, f"{side}_clean_name", config)
        return keyed.groupBy(
            "_key", name_prefix(name, config.prefix_length).alias(f"_{side}_prefix"),
            F.coalesce(f"{side}_country", F.lit("")).alias(f"_{side}_country"),
        ).agg(F.count("*").alias(f"_{side}_rows"))

    met = counted(client_side(clients), "client").join(counted(reference_side(reference), "candidate"), "_key").filter(
        F.startswith("_key", F.lit("p:")) | (F.col("_client_prefix") != F.col("_candidate_prefix")))
    n = F.col("_client_rows") * F.col("_candidate_rows")
    in_country = same_given(F.col("_client_country"), F.col("_candidate_country"))
    methods = F.array(
        F.struct(F.lit(NAME_ONLY_BLOCK).alias("candidate_method"), n.alias("n")),
        F.struct(F.lit(NAME_COUNTRY_BLOCK).alias("candidate_method"), F.when(in_country, n).otherwise(0).alias("n")),
    )
    return met.select(F.inline(methods)).groupBy("candidate_method").agg(F.sum("n").alias("n"))


def band_counts(clients: DataFrame, reference: DataFrame, config: MatchConfig, index: RegisterIndex) -> DataFrame:
    """Number of candidate rows per method and band, as counted over ``score_candidates``, without the pair table.

    Rows of the name blocks are counted by block. Of them only those that reach the review band are built, as pairs of
    profiles that stand for so many rows; the others are in the lowest band. Pairs with an equal key follow other
    rules: they are built from their keys, and taken off where they were counted by name.
    """
    profile = _profile("client", with_address=True)
    left, right = (with_profile(side, name) for side, name in (
        (client_side(clients), "client"), (reference_side(reference), "candidate")))
    floor = min(config.review_threshold, config.auto_threshold)
    band = confidence_band(F.col("match_score"), config).alias("confidence_band")
    low = confidence_band(F.lit(-1.0), config)

    def by_name(pairs: DataFrame) -> DataFrame:
        """The reached bands of the two name methods."""
        scored = _with_methods(pairs, F.lit(True)).withColumn("match_score", score_by_name(config))
        return scored.filter(F.col("match_score") >= floor)

    compared = compared_by_index(left, index, config, 0, floor).drop("candidate_method").withColumns({
        "client_country": F.col("_client_country"), "candidate_country": F.col("_candidate_country")})
    reached = (
        by_name(compared).select(*profile, *PROFILE, "candidate_method", band)
        .join(left.groupBy(*profile).agg(F.count("*").alias("_left_rows")), profile)
        .join(right.groupBy(*PROFILE).agg(F.count("*").alias("_right_rows")), PROFILE)
        .select("candidate_method", "confidence_band", (F.col("_left_rows") * F.col("_right_rows")).alias("n"))
    )
    by_lei, by_number = _pairs_by_index(clients, index, config)
    by_key = score_rows(_scored_by_key(by_lei, by_number, config), config)
    in_block = by_lei.unionByName(by_number.filter(~same_lei())).filter(_in_block(config)).withColumn(
        "name_similarity", name_similarity(F.col("client_clean_name"), F.col("candidate_clean_name"), config))
    twice = by_name(with_evidence(in_block)).select("candidate_method", band)
    name_rows = F.col("candidate_method").isin(NAME_ONLY_BLOCK, NAME_COUNTRY_BLOCK)

    def counts(rows: DataFrame, n: Column, *bands: Column) -> DataFrame:
        return rows.select("candidate_method", *(bands or ["confidence_band"]), n.cast("long").alias("n"))

    low_band = low.alias("confidence_band")
    parts = [
        counts(_pairs_by_method(clients, reference, config), F.col("n"), low_band),
        counts(reached, F.col("n")), counts(reached, -F.col("n"), low_band),
        counts(by_key, F.lit(1)),
        # A keyed row of a name method was counted by name: in the lowest band, or in the band that it reached.
        counts(by_key.filter(name_rows), F.lit(-1), low_band),
        counts(twice, F.lit(-1)), counts(twice, F.lit(1), low_band),
    ]
    total = reduce(DataFrame.unionByName, parts).groupBy("candidate_method", "confidence_band")
    return total.agg(F.sum("n").alias("n")).filter(F.col("n") > 0)


def best_candidates(
    clients: DataFrame, reference: DataFrame, config: MatchConfig = MatchConfig(), depth: int | None = None,
    index: RegisterIndex | None = None,
) -> DataFrame:
    """Ranked candidates down to ``depth`` (the review depth by default) per client.

    Both ids must be keys of their tables. An ``index`` of the same register saves its shuffles and counts; it is used
    where it was built for such blocks and this depth.
    """
    depth = config.review_depth if depth is None else depth
    if index is not None and index.fits(config, depth) and _keyed_rules_never_score_less(config):
        return rank_candidates(score_rows(_rows_by_index(clients, index, config, depth), config), depth)
    if not _keyed_rules_never_score_less(config):
        candidates = generate_candidates(clients, reference, config, ids_are_keys=True)
        return rank_candidates(score_candidates(candidates, config), depth)
    rows = (
        _by_name(clients, reference, config, depth, with_address=False)
        .unionByName(_by_name(clients, reference, config, depth, with_address=True))
        .unionByName(_by_key(clients, reference, config))
    )
    return rank_candidates(score_rows(rows, config), depth)
