"""Operator 13: what each filter removes under every order of the filters, by Lehmer ranks and difference arrays.

A document is reduced to the set (bit mask) of the filters it fails. Documents are counted by part and mask, and
only these counts go on: at most 2^n numbers a part, whatever the size of the corpus. In the lexicographic list of all
orders, the orders that begin with the same filters are neighbours, and the Lehmer rank of the first one says where
they start. A mask is removed at step s in the orders whose first s - 1 filters it passes and whose s-th it fails: a
few intervals of ranks. Its count is added where an interval starts and taken off where it ends, and one prefix sum
over the ranks gives the removals of all orders at once.

``audit`` takes any counts by part and mask (and names of the filters); ``query`` applies it to five text filters.

A null text is empty; a null source is the empty part. A row is a document: repeated rows count as often as they
occur, and rows that share id and text are no copies of each other (only a smaller id makes a copy). A null id is
neither smaller nor larger than another. A document is good or toxic if any of its label rows says 1; null labels and
labels of other ids say nothing. An empty table gives no parts and an empty result. Further columns are ignored. Words
of a text are told apart by 64-bit hashes, equal texts by SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namebridge.llm import kernels as K
from namebridge.llm.stages import documents, small_batches, written

FILTERS = "ABCDE"
COUNTS = ("documents", "good", "toxic")
_COPY = 1 << FILTERS.index("E")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*|"]] = True
#: Parts that one step of the arithmetic takes together.
_PARTS = 64


def lehmer_rank(prefix: tuple[int, ...], n: int) -> int:
    """Lexicographic rank of the first order of n filters that begins with prefix."""
    rank = 0
    for i, f in enumerate(prefix):
        smaller_left = f - sum(p < f for p in prefix[:i])
        rank += smaller_left * factorial(n - 1 - i)
    return rank


@lru_cache(maxsize=None)
def removal_intervals(mask: int, step: int, n: int) -> tuple[tuple[int, int], ...]:
    """Rank intervals [start, end) of the orders that remove the mask at this step (from 1); neighbours are merged."""
    failed = [f for f in range(n) if mask >> f & 1]
    passed = [f for f in range(n) if not mask >> f & 1]
    width = factorial(n - step)
    starts = sorted(lehmer_rank((*head, f), n) for head in permutations(passed, step - 1) for f in failed)
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and out[-1][1] == s:
            out[-1] = (out[-1][0], s + width)
        else:
            out.append((s, s + width))
    return tuple(out)


def removals(counts: np.ndarray, n: int) -> np.ndarray:
    """counts[part, mask, column] to removed[part, order, step, column], orders by rank."""
    total = factorial(n)
    change = np.zeros((n, total + 1, len(counts), counts.shape[2]), np.int64)
    for mask in range(1, 1 << n):
        for step in range(1, n + 1):
            for start, end in removal_intervals(mask, step, n):
                change[step - 1, start] += counts[:, mask]
                change[step - 1, end] -= counts[:, mask]
    return change.cumsum(axis=1)[:, :total].transpose(2, 1, 0, 3)


_OUT = T.StructType([
    T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
    T.StructField("step", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]])


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from counts(part, mask, documents, good, toxic).

    Bit i of a mask says that the document fails filters[i]. There is one row of counts per part and mask, and a part's
    few masks are gathered in one row; parts are spread over tasks.
    """
    n = len(filters)
    orders = list(permutations(range(n)))
    at = np.array(orders)
    names = pa.array(["".join(filters[f] for f in o) for o in orders])
    by_part = counts.groupBy("part").agg(
        F.collect_list(F.struct("mask", *[F.col(c).cast("long").alias(c) for c in COUNTS])).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, _PARTS):
                part = batch.slice(begin, _PARTS)
                rows = part.column("rows")
                flat = rows.flatten()
                owner = np.repeat(np.arange(len(rows)), rows.value_lengths().to_numpy(zero_copy_only=False))
                c = np.zeros((len(rows), 1 << n, len(COUNTS)), np.int64)
                for k, name in enumerate(COUNTS):
                    c[owner, flat.field("mask").to_numpy(), k] = flat.field(name).to_numpy()
                gone = removals(c, n)  # part, order, step, column
                removed = gone[..., 0]
                fails = np.stack([c[:, [m for m in range(1 << n) if m >> f & 1], 0].sum(1) for f in range(n)], 1)
                alone = c[:, [1 << f for f in range(n)], 0]
                kept = c[:, :, 0].sum(1)[:, None, None] - removed.cumsum(axis=2)
                value = np.zeros((len(rows), n), np.int64)
                for f in range(n):
                    value[:, f] = (removed * (at == f)).sum((1, 2))
                size = len(orders) * n
                columns = [kept, removed, fails[:, at] - removed, alone[:, at], gone[..., 1], gone[..., 2], value[:, at]]
                yield pa.RecordBatch.from_arrays([
                    part.column("part").take(pa.array(np.repeat(np.arange(len(rows)), size))),
                    names.take(pa.array(np.tile(np.repeat(np.arange(len(orders)), n), len(rows)))),
                    pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(rows) * len(orders))),
                    *[pa.array(np.ascontiguousarray(x).reshape(-1)) for x in columns]], names=_OUT.names)

    return by_part.mapInArrow(run, _OUT)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def text_masks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The filters A to D that each text fails."""
    starts, ends, first = K.words(data, offsets)
    words = np.diff(first)
    hashes = K.span_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(words)), words)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[new], minlength=len(words))
    upper = _per_text((data >= 0x41) & (data <= 0x5A), offsets)
    points = _per_text((data & 0xC0) != 0x80, offsets)
    failed = [words < 200, 100 * distinct < 50 * words, 100 * upper > 2 * points, _per_text(_SYMBOL[data], offsets) > 0]
    return sum(f.astype(np.int32) << k for k, f in enumerate(failed))


def failures(docs: DataFrame) -> DataFrame:
    """(part, doc_id, mask, n) of documents with doc_id, text and source: rows that agree in all are counted."""
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce("source", F.lit("")).alias("part"), "doc_id",
                       F.unhex(F.sha2(text, 256)).alias("same"), text.alias("text"))
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("mask", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data, offsets in K.text_chunks(batch.column("text")):
                mask = text_masks(data, offsets)
                part = batch.slice(begin, len(mask))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(mask)], names=schema.names)

    # Repeated rows are added up before the shuffle, so a row that fills a third of the table is one row after it.
    facts = written(rows.mapInArrow(run, schema).groupBy("part", "doc_id", "same", "mask")
                    .agg(F.count("*").alias("n")), "facts")
    first = facts.where(F.col("doc_id").isNotNull()).groupBy("same").agg(F.min("doc_id").alias("doc_id"))
    # Both columns are keys: the copies of one text are spread by their ids.
    copies = facts.join(first.withColumn("is_first", F.lit(True)), ["same", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return copies.select("part", "doc_id", (F.col("mask") + F.when(copy, _COPY).otherwise(0)).alias("mask"), "n") \
        .groupBy("part", "doc_id", "mask").agg(F.sum("n").alias("n"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """counts(part, mask, documents, good, toxic) of the five filters."""
    def says(column: str):
        return F.max(F.coalesce(F.col(column) == 1, F.lit(False)).cast("int"))

    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id") \
        .agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    marked = failures(docs).join(known, "doc_id", "left")
    return marked.groupBy("part", "mask").agg(
        F.sum("n").alias("documents"),
        *[F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(mask_counts(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))


SQL = r"""
with recursive texts as (
  select coalesce(source, '') as part, doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
), masks as (
  select part, doc_id,
    (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
    + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t))::int
    + 8 * regexp_matches(t, '[#$%&*|]')::int
    + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as mask
  from texts
), known as (
  select doc_id, max(coalesce(quality = 1, false)::int) as good, max(coalesce(toxic = 1, false)::int) as toxic
  from labels where doc_id is not null group by doc_id
), counts as (
  select part, mask, count(*) as docs, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from masks left join known using (doc_id) group by part, mask
), orders as (
  select '' as o, 0 as used
  union all
  select o || l, used + bit from orders, (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, bit)
  where used & bit = 0
), steps as (
  select a.o, b.used as before, c.used - b.used as bit, length(c.o) as step
  from orders a join orders c on starts_with(a.o, c.o) and c.o <> ''
  join orders b on b.o = left(c.o, length(c.o) - 1)
  where length(a.o) = 5
), removed as (
  select part, o as filter_order, step, bit,
    sum(case when mask & (before | bit) = 0 then docs else 0 end) as kept,
    sum(case when mask & before = 0 and mask & bit <> 0 then docs else 0 end) as removed,
    sum(case when mask & before <> 0 and mask & bit <> 0 then docs else 0 end) as redundant,
    sum(case when mask = bit then docs else 0 end) as unique_fails,
    sum(case when mask & before = 0 and mask & bit <> 0 then good else 0 end) as good_lost,
    sum(case when mask & before = 0 and mask & bit <> 0 then toxic else 0 end) as toxic_lost
  from counts, steps group by part, o, step, bit
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
  redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
  toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, bit))::bigint as shapley
from removed
"""
