"""Equi-joins on name blocks, with hot blocks spread over many tasks.

Two names share a block when their first tokens or their prefixes are equal. As an ``OR`` that
plans as a nested loop, so every name is exploded to its block keys and joined on equality:

* ``p:<prefix>`` for every name,
* ``t:<token>`` only for tokens shorter than the prefix. Equal tokens of at least the prefix
  length imply equal prefixes, so no longer token can add a pair.

A pair met under ``t:`` is kept only if the prefixes differ. So each pair comes out exactly once
and no de-duplication shuffle follows.

A block may hold any share of the rows. Blocks are counted on both sides first (the counts combine
map-side) and a block with more than ``cell_rows`` rows on a side is cut into a grid of cells: a
row hashes to one line of cells on its own side and is repeated along the other. Every pair still
meets in exactly one cell; no pair is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namebridge.functions.text import first_token, is_given, name_prefix

_CELLS = ["_left_cell", "_right_cell"]


def block_keys(name: Column, prefix_length: int) -> Column:
    """Array of the block keys of a cleaned name."""
    prefix_key = F.concat(F.lit("p:"), name_prefix(name, prefix_length))
    token = first_token(name)
    return F.when(
        F.length(token) < prefix_length, F.array(prefix_key, F.concat(F.lit("t:"), token))
    ).otherwise(F.array(prefix_key))


def pair_partitions(spark: SparkSession) -> int:
    """Tasks for work whose cost per row is high: several for each core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def spread_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Hash the rows over all cores, several tasks to each.

    For steps whose cost per row is high (pairs, Python): adaptive execution would merge
    partitions by their bytes and leave cores idle, and with one task per core the slowest decides.
    """
    return df.repartition(pair_partitions(df.sparkSession), *columns)


def _cells_per_key(left: DataFrame, right: DataFrame, key: str, cell_rows: int) -> DataFrame:
    """Grid size of each key that is hot on a side; all other keys are absent."""
    left_rows = left.groupBy(key).agg(F.count("*").alias("_left_rows"))
    right_rows = right.groupBy(key).agg(F.count("*").alias("_right_rows"))
    return (
        left_rows.join(right_rows, key)
        .filter((F.col("_left_rows") > cell_rows) | (F.col("_right_rows") > cell_rows))
        .select(
            key,
            F.ceil(F.col("_left_rows") / cell_rows).cast("int").alias("_left_cells"),
            F.ceil(F.col("_right_rows") / cell_rows).cast("int").alias("_right_cells"),
        )
    )


def _spread(side: DataFrame, cells: DataFrame, key: str, own: str, other: str, row_id: list[str]) -> DataFrame:
    """The rows with their cells.

    Only hot keys are in ``cells``, a few for each ``cell_rows`` rows, and of them key and counts. So they go to the
    rows: rows need not be shuffled, and those of a hot key need not meet in one task, to learn that their key is hot.
    """
    own_cells = F.coalesce(F.col(f"_{own}_cells"), F.lit(1))
    other_cells = F.coalesce(F.col(f"_{other}_cells"), F.lit(1))
    return (
        side.join(F.broadcast(cells), key, "left")
        .withColumn(f"_{own}_cell", F.pmod(F.xxhash64(F.lit(own), *row_id), own_cells).cast("int"))
        .withColumn(f"_{other}_cell", F.explode(F.sequence(F.lit(0), other_cells - 1)))
        .drop("_left_cells", "_right_cells")
    )


def spread_join(
    left: DataFrame, right: DataFrame, key: str, left_id: list[str], right_id: list[str], cell_rows: int
) -> DataFrame:
    """Inner equi-join on ``key`` in which a hot key is shared out over a grid of cells.

    ``left_id`` and ``right_id`` name the columns whose hash picks a row's cell.
    """
    left, right = left.filter(F.col(key).isNotNull()), right.filter(F.col(key).isNotNull())
    cells = _cells_per_key(left, right, key, cell_rows)
    left = spread_rows(_spread(left, cells, key, "left", "right", left_id), key, *_CELLS)
    right = spread_rows(_spread(right, cells, key, "right", "left", right_id), key, *_CELLS)
    # The pairs are the work. Broadcasting a small side would leave them in as many tasks as the
    # other side has input splits, so both sides are always shuffled by cell.
    # The right side is streamed: a register row, the wider one, stands in a run of pairs, which files of pairs store once.
    pairs = right.hint("merge").join(left, [key, *_CELLS])
    return pairs.select(key, *(c for side in (left, right) for c in side.columns if c not in (key, *_CELLS)))


def block_join(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    *,
    left_extra: str | None = None,
    right_extra: str | None = None,
    prefix_length: int = 4,
    cell_rows: int = 2_000,
    include_empty: bool = False,
) -> DataFrame:
    """All pairs of rows whose names share a block, each pair once, with the columns of both.

    ``left_extra`` and ``right_extra`` name a further column that must be given and equal; it
    joins the block key, so blocks get smaller instead of pairs being filtered.
    """

    def keyed(side: DataFrame, name: str, extra: str | None) -> DataFrame:
        wanted = F.col(name).isNotNull() if include_empty else F.col(name) != ""
        key = F.explode(block_keys(F.col(name), prefix_length))
        keyed_side = side.filter(wanted).withColumn("_block", key)
        if extra is None:
            return keyed_side
        return keyed_side.filter(is_given(F.col(extra))).withColumn("_block", F.concat_ws("|", "_block", extra))

    pairs = spread_join(
        keyed(left, left_name, left_extra), keyed(right, right_name, right_extra), "_block",
        left.columns, right.columns, cell_rows,
    )
    met_by_prefix = F.startswith("_block", F.lit("p:"))
    prefixes_differ = name_prefix(F.col(left_name), prefix_length) != name_prefix(F.col(right_name), prefix_length)
    return pairs.filter(met_by_prefix | prefixes_differ).drop("_block")
