"""Operator 11: words that differ by one edit, found by comparing blocks of words letter by letter.

Two words are near if one inserted, deleted or replaced code point turns one into the other. In a pair of words padded
to rows of code points, the number of equal columns from the left (common prefix) and from the right (common suffix)
says so at once: their sum reaches the longer length less one, and the shorter word leaves at most one place over.
Blocks of words are compared densely, all shorter words of a block with all words of it.

Which words share a block follows from where the edit is. Of two near words the shorter has length S, and they have
p equal letters in front, 0 <= p <= S. If p is in a window [lo, hi), the words have the first lo and the last S - hi
letters in common. So a word goes to the blocks of both halves of [0, S], as a shorter word and as a longer one, and a
pair counts in the one window that holds its p: nothing is lost and nothing comes twice. A block of more than ``tile``
words is halved again, window by window, until it fits or one place is left; then only the letters at that place
differ. Blocks are counted before words are gathered, and the words of large ones are found by salted joins, so no
group is gathered that was not counted to be small.

A word's form is its near word with the most occurrences if it has ``ratio`` times its own; the root is the end of the
chain of forms, found by doubling. A form has at least ``ratio`` times the occurrences, so chains are short.

A null text has no words, a null id counts as an empty one. Repeated rows count as often as they occur. Ties between
near words go to the smallest word by code points. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namebridge.llm import kernels as K
from namebridge.llm.stages import documents, small_batches, written


@dataclass(frozen=True)
class SpellingConfig:
    least_length: int = 7
    least_count: int = 2
    #: How many times as frequent a word's form must be.
    ratio: int = 10
    #: Of so many occurrences one loses a letter, chosen by a checksum of id and word; None: words stay as they are.
    altered: int | None = 31
    #: Words of a block that are compared with each other; larger blocks are halved first.
    tile: int = 128
    #: Shares over which the words of a large block are dealt.
    salts: int = 32


_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF
#: Different words that a task counts before it passes the counts on.
_HELD = 1 << 17
#: Code points that one comparison takes at a time.
_CELLS = 1 << 21


def word_counts(docs: DataFrame, config: SpellingConfig | None = None) -> DataFrame:
    """(word, n) of the letter runs of docs(doc_id, text) that are long and frequent enough."""
    config = config or SpellingConfig()
    small_batches(docs.sparkSession)
    least, altered = config.least_length, config.altered
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")

    def flush(counts: dict[bytes, int]) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([
            pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"])
        counts.clear()
        return batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at, data, offsets in K.text_chunks(batch.column("text")):
                lead = data == _LEAD
                inside = _LETTER[data] | lead
                inside[1:] |= lead[:-1]
                starts, ends = K.spans(inside, offsets)
                leads = np.concatenate([[0], np.cumsum(lead)])
                long_enough = ends - starts - (leads[ends] - leads[starts]) >= least
                starts, ends = starts[long_enough], ends[long_enough]
                text = K.LOWER[data].tobytes()
                owner = (np.searchsorted(offsets, starts, "right") - 1).tolist()
                seeds = [crc32(f"{d}:".encode()) for d in ids[at : at + len(offsets) - 1]]
                for o, s, e in zip(owner, starts.tolist(), ends.tolist(), strict=True):
                    word = text[s:e]
                    if altered is not None:
                        h = crc32(word, seeds[o])
                        if h % altered == 0:
                            letters = word.decode()
                            k = h % len(letters)
                            if len(letters) <= least:
                                continue
                            word = (letters[:k] + letters[k + 1 :]).encode()
                    counts[word] = counts.get(word, 0) + 1
                if len(counts) >= _HELD:
                    yield flush(counts)
        if counts:
            yield flush(counts)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= config.least_count)


def near_in_blocks(words: list[str], block: np.ndarray, longer: np.ndarray, size: np.ndarray,
                   low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one block that are one edit apart, the first of them a shorter word.

    size, low and high hold the shorter length and the window of each row's block. Rows must be in order of block, and
    within it shorter words first.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = size + longer
    width = int(length.max())
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    column = np.arange(width)
    front = np.zeros((len(words), width), np.uint32)
    back = np.zeros_like(front)
    front[column < length[:, None]] = points
    back[column >= width - length[:, None]] = points
    back = np.ascontiguousarray(back[:, ::-1])
    end = np.searchsorted(block, block, "right")
    rows = np.flatnonzero(~longer)
    left, right = [], []
    step = 0
    slice_rows = max(1, _CELLS // width)
    while len(rows):
        step += 1
        rows = rows[rows + step < end[rows]]
        for begin in range(0, len(rows), slice_rows):
            a = rows[begin : begin + slice_rows]
            b = a + step
            prefix = _leading(front, a, b)
            suffix = _leading(back, a, b)
            near = (np.minimum(prefix + suffix, length[a]) >= length[b] - 1) & (prefix < length[b])
            near &= (low[a] <= prefix) & (prefix < high[a])
            left.append(a[near])
            right.append(b[near])
    return np.concatenate([*left, np.zeros(0, np.int64)]).astype(np.int64), \
        np.concatenate([*right, np.zeros(0, np.int64)]).astype(np.int64)


def _leading(matrix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal columns from the left of rows a and b."""
    other = matrix[a] != matrix[b]
    return np.where(other.any(1), other.argmax(1), matrix.shape[1])


def _compared(blocks: DataFrame) -> DataFrame:
    """(word, near, near_n), both ways, of blocks(size, lo, hi, rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("rows")
            flat = rows.flatten()
            lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
            block = np.repeat(np.arange(len(rows)), lengths)
            longer = flat.field("longer").to_numpy(zero_copy_only=False)
            order = np.lexsort((longer, block))
            words = flat.field("word").take(pa.array(order))
            count = flat.field("n").take(pa.array(order))
            own = [batch.column(c).to_numpy().astype(np.int64)[block[order]] for c in ("size", "lo", "hi")]
            a, b = near_in_blocks(words.to_pylist(), block[order], longer[order], *own)
            one, two = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
            yield pa.RecordBatch.from_arrays([words.take(one), words.take(two), count.take(two)],
                                             names=["word", "near", "near_n"])

    return blocks.mapInArrow(run, "word string, near string, near_n long")


def _halves(rows: DataFrame) -> DataFrame:
    """rows(word, n, longer, size, lo, hi), each in both halves of its window, with the key of the half's block."""
    halves = rows.select("word", "n", "longer", "size", F.expr(
        "explode(array(struct(lo, (lo + hi) div 2 as hi), struct((lo + hi) div 2 as lo, hi)))").alias("w"))
    part = halves.select("word", "n", "longer", "size", F.col("w.lo").cast("int").alias("lo"),
                         F.col("w.hi").cast("int").alias("hi")).where("lo < hi")
    return part.withColumn("key", F.expr(
        "xxhash64(size, lo, hi, substring(word, 1, lo), right(word, greatest(size - hi, 0)))"))


def near_words(words: DataFrame, config: SpellingConfig | None = None) -> DataFrame:
    """(word, near, near_n), both ways, of all pairs of words(word, n) that are one edit apart. Words are distinct."""
    config = config or SpellingConfig()
    small_batches(words.sparkSession)
    roles = words.select("word", "n", F.expr(
        "explode(array(struct(length(word) as size, false as longer), struct(length(word) - 1 as size, true as longer)))"
    ).alias("r")).select("word", "n", "r.longer", "r.size", F.lit(0).alias("lo"), (F.col("r.size") + 1).alias("hi"))
    open_rows = written(_halves(roles), "windows")
    found = []
    while True:
        sizes = open_rows.groupBy("key", "lo", "hi").agg(F.count("*").alias("rows"))
        large = written(sizes.where((F.col("rows") > config.tile) & (F.col("hi") - F.col("lo") > 1))
                        .select("key", F.lit(True).alias("large")), "large")
        dealt = open_rows.withColumn("salt", F.expr(f"pmod(xxhash64(word), {config.salts})"))
        shares = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(config.salts - 1)))) \
            .withColumn("salt", F.col("salt").cast("long"))
        marked = written(dealt.join(shares, ["key", "salt"], "left").drop("salt"), "marked")
        blocks = marked.where("large is null").groupBy("key", "size", "lo", "hi") \
            .agg(F.collect_list(F.struct("word", "n", "longer")).alias("rows"), F.min("longer").alias("none_shorter")) \
            .where("not none_shorter and size(rows) > 1")
        found.append(written(_compared(blocks.select("size", "lo", "hi", "rows")), "near"))
        if large.isEmpty():
            return reduce(DataFrame.unionByName, found)
        open_rows = written(_halves(marked.where("large")), "windows")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms(word, form): the end of each word's chain. Chains must not close."""
    steps = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        doubled = written(steps.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if doubled.where("moved").isEmpty():
            return doubled.select("word", "root")
        steps = doubled.select("word", "root")


def variants(words: DataFrame, config: SpellingConfig | None = None) -> DataFrame:
    """words(word, n) with n_near, form, form_n and root."""
    config = config or SpellingConfig()
    words = written(words.select("word", "n"), "words")
    best = near_words(words, config).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    frequent = -F.col("best.less") >= config.ratio * F.col("n")
    judged = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(documents(spark, sf_dir)))
