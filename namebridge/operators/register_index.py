"""The register prepared for matching: written once per refresh, joined by every run without a shuffle.

Each table is bucketed by the key that a join uses:

* ``names``: block key to names of the register, each with its profiles (country, address, smallest id) in one list.
  Names are compared once per pair of names, whatever the number of their profiles;
* ``leis`` and ``numbers``: LEI and registration number to register rows;
* ``copies``: profile to its register rows of the smallest ids.

A key with more than ``cell_rows`` rows is dealt over cells, and the cell is part of the bucket key, so no bucket holds a
hot key alone. The few hot keys are a table of their own: only clients with such a key are repeated, once per cell. A
key that is hot among the clients is joined apart, in a grid of cells. Lists hold about ``_LIST`` profiles at most: a
name with more has several.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namebridge.config import MatchConfig
from namebridge.functions.similarity import token_set
from namebridge.functions.text import is_given
from namebridge.operators.blocking import block_keys, pair_partitions, spread_join
from namebridge.operators.candidates import reference_side
from namebridge.sources.tables import TableStore, materialise, scratch_dir

_LIST = 64
_SALTS = 64
#: Names of a block in one cell. Comparing names is the work, so cells are small enough to even out.
_CELL_NAMES = 1024
_BUCKET = ["_key", "_right_cell"]
PROFILE = ["candidate_clean_name", "_candidate_country", "_candidate_address"]


def crowded(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """(key, _shares) of the keys with more than limit rows; written, so that it is counted once."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > limit)
    return materialise(counts.select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_shares")), "crowded")


def with_shares(rows: DataFrame, shares: DataFrame, key: str, row_id: list[str]) -> DataFrame:
    """rows with the ``_shares`` of their key, 1 where it is not among the crowded ones.

    Rows of one key look that up in many tasks: they are dealt by a hash, and the crowded keys repeated.
    """
    if shares.isEmpty():
        return rows.withColumn("_shares", F.lit(1))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*row_id), F.lit(_SALTS)).cast("int"))
    repeated = shares.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return dealt.join(repeated, [key, "_salt"], "left").drop("_salt").withColumn(
        "_shares", F.coalesce("_shares", F.lit(1)))


def _share_of(row_id: list[str]):
    return F.pmod(F.xxhash64(F.lit("share"), *row_id), F.col("_shares")).cast("int")


@dataclass(frozen=True)
class KeyIndex:
    """Rows by ``_key`` and ``_right_cell``, and the number of cells of the keys that have several."""

    rows: DataFrame
    cells: DataFrame
    row_id: list[str]
    buckets: int

    @staticmethod
    def write(store: TableStore, name: str, rows: DataFrame, row_id: list[str], cell_rows: int) -> None:
        buckets = pair_partitions(rows.sparkSession)
        cells = crowded(rows, "_key", cell_rows)
        dealt = with_shares(rows, cells, "_key", row_id).withColumn("_right_cell", _share_of(row_id)).drop("_shares")
        store.write_bucketed(name, dealt, _BUCKET, buckets)
        store.write(f"{name}_cells", cells)

    @staticmethod
    def read(store: TableStore, name: str, row_id: list[str]) -> KeyIndex:
        # In a session with another number of partitions the joins shuffle once more, with the same result.
        return KeyIndex(store.read_bucketed(name), store.read(f"{name}_cells"), row_id, pair_partitions(store.spark))

    def join(self, left: DataFrame, left_id: list[str], cell_rows: int) -> DataFrame:
        """Inner join on ``_key``. ``left`` is read twice: pass a written table or a short plan."""
        left = left.filter(F.col("_key").isNotNull())
        hot = crowded(left, "_key", cell_rows)
        usual, apart = left, None
        if not hot.isEmpty():
            marked = with_shares(left, hot, "_key", left_id)
            usual = marked.filter("_shares = 1").drop("_shares")
            matching = self.rows.drop("_right_cell").join(hot.select("_key"), "_key", "left_semi")
            apart = spread_join(marked.filter("_shares > 1").drop("_shares"), matching, "_key", left_id, self.row_id,
                                cell_rows)
        dealt = with_shares(usual, self.cells, "_key", left_id).withColumn(
            "_right_cell", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1))).drop("_shares")
        # The pairs are the work: both sides stay in the buckets rather than one being broadcast.
        pairs = dealt.repartition(self.buckets, *_BUCKET).hint("merge").join(self.rows, _BUCKET).drop("_right_cell")
        return pairs if apart is None else pairs.unionByName(apart)


def with_profile(rows: DataFrame, side: str) -> DataFrame:
    """Profile columns that can be joined on: a missing value is the same evidence, null or empty."""
    return rows.withColumns({
        f"_{side}_country": F.coalesce(f"{side}_country", F.lit("")),
        f"_{side}_address": F.coalesce(f"{side}_address", F.lit("")),
    })


def named_profiles(profiles: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """(name, _list, _profiles): the profiles of each name as lists of bounded length."""
    profiles = materialise(profiles, "profiles")
    shares = crowded(profiles, name, _LIST)
    dealt = with_shares(profiles, shares, name, columns).withColumn("_list", _share_of(columns))
    return dealt.groupBy(name, "_list").agg(F.collect_list(F.struct(*columns)).alias("_profiles"))


def with_block_keys(names: DataFrame, name: str, config: MatchConfig) -> DataFrame:
    wanted = F.col(name).isNotNull() if config.include_empty_block else F.col(name) != ""
    return names.filter(wanted).withColumn("_key", F.explode(block_keys(F.col(name), config.prefix_length)))


def in_lists(keyed: DataFrame, row_id: list[str], rows: int, cell: str, name: str) -> DataFrame:
    """(_key, cell, name): the rows of each key in lists of about so many."""
    shares = crowded(keyed, "_key", rows)
    dealt = with_shares(keyed, shares, "_key", row_id).withColumn(cell, _share_of(row_id))
    return dealt.groupBy("_key", cell).agg(F.collect_list(F.struct(*_members(keyed))).alias(name))


def _members(keyed: DataFrame) -> list[str]:
    """The name, the profiles and the words of a side of the name blocks, in this order."""
    ends = ("_clean_name", "_profiles", "_tokens")
    return [next(c for c in keyed.columns if c.endswith(end)) for end in ends]


@dataclass(frozen=True)
class RegisterIndex:
    names: KeyIndex
    leis: KeyIndex
    numbers: KeyIndex
    copies: DataFrame
    depth: int
    prefix_length: int
    include_empty: bool

    @staticmethod
    def build(reference: DataFrame, store: TableStore, config: MatchConfig = MatchConfig()) -> RegisterIndex:
        """Write the index of a cleaned register into the store, for results down to the review depth."""
        rows = reference_side(reference)
        by_profile = with_profile(rows, "candidate")
        profiles = by_profile.groupBy(*PROFILE).agg(F.min("reference_id").alias("_first_id"))
        by_id = Window.partitionBy(*PROFILE).orderBy("reference_id")
        copies = by_profile.withColumn("_n", F.row_number().over(by_id)).filter(F.col("_n") <= config.review_depth)

        def keyed(field: str) -> DataFrame:
            return rows.filter(is_given(F.col(field))).withColumn("_key", F.col(field))

        def write_names() -> None:
            named = named_profiles(
                profiles.withColumn("_address_tokens", token_set(F.col("_candidate_address"))), PROFILE[0],
                [*PROFILE[1:], "_address_tokens", "_first_id"],
            ).withColumnsRenamed({"_profiles": "_candidate_profiles", "_list": "_candidate_list"})
            named = named.withColumn("_candidate_tokens", token_set(F.col(PROFILE[0])))
            blocks = materialise(with_block_keys(named, PROFILE[0], config), "blocks")
            KeyIndex.write(store, "index_names", blocks, [PROFILE[0], "_candidate_list"], _CELL_NAMES)

        steps = [
            write_names,
            lambda: KeyIndex.write(store, "index_leis", keyed("candidate_lei"), ["reference_id"], config.cell_rows),
            lambda: KeyIndex.write(
                store, "index_numbers", keyed("candidate_registration_number"), ["reference_id"], config.cell_rows),
            lambda: store.write_bucketed("index_copies", copies, PROFILE, pair_partitions(reference.sparkSession)),
        ]
        # The tables do not depend on each other; each is a few short jobs.
        with ThreadPoolExecutor(len(steps)) as pool:
            list(pool.map(lambda step: step(), steps))
        return RegisterIndex.open(store, config)

    @staticmethod
    def open(store: TableStore, config: MatchConfig = MatchConfig()) -> RegisterIndex:
        """The index that ``build`` wrote with the same blocking parameters and review depth."""
        return RegisterIndex(
            KeyIndex.read(store, "index_names", [PROFILE[0], "_candidate_list"]),
            KeyIndex.read(store, "index_leis", ["reference_id"]),
            KeyIndex.read(store, "index_numbers", ["reference_id"]),
            store.read_bucketed("index_copies"), config.review_depth, config.prefix_length, config.include_empty_block,
        )

    @staticmethod
    def scratch(reference: DataFrame, config: MatchConfig = MatchConfig()) -> RegisterIndex:
        """An index for one application, in the shared scratch folder."""
        spark = reference.sparkSession
        return RegisterIndex.build(reference, TableStore(spark, root=scratch_dir(spark, "register_index")), config)

    def lists(self, name: str) -> KeyIndex:
        """The names with one row per cell, which holds the list of its names; the buckets stay."""
        rows = self.names.rows
        lists = rows.groupBy(*_BUCKET).agg(F.collect_list(F.struct(*_members(rows))).alias(name))
        return KeyIndex(lists.withColumn("_cell", F.col(_BUCKET[1])), self.names.cells, ["_cell"], self.names.buckets)

    def fits(self, config: MatchConfig, depth: int) -> bool:
        return (depth <= self.depth and config.prefix_length == self.prefix_length
                and config.include_empty_block == self.include_empty)
