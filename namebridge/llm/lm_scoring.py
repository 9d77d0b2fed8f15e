"""Operator 2: scoring by a hashed maximum-entropy language model.

Counting. Texts are dealt into chunks by a hash; each chunk sends its distinct tokens, in blocks, to the
tasks that hold the corpus counts of a block of tokens, and gets the counts back in the same order. So what is
shuffled are the distinct tokens of chunks, not the tokens of texts, and no vocabulary passes through the driver.

Model. A token falls into one of ``side`` x ``side`` bins: the most frequent words have bins of their own, half of all
bins, the others share bins by their last bytes. log P(token | history) = log P(class | history) + log P(bin | class,
history) + log P(token | bin): a class-factored softmax with hashed features of the history (previous word, the word
before it as a skip feature, both as a bigram), where the bins of each class have weights of their own (the class is
part of the hash), and smoothed counts within the bin. The sides and the rows of the weight tables grow with
the bytes of text (``sizes``).

Training. Biases start from the counted bins, so a model without steps is the unigram model. Every task makes
gradient steps over its training texts from the current weights. The changes are then mixed row by row: the
mean over the tasks that used a row, weighted by uses, times at most the number of those tasks. The fewer uses a task had of a
row, the nearer that is to the sum of the changes, as if they were made one after the other. Rows are mixed in blocks on
the executors; the mixed tables, whose size the bytes of text fix, reach the driver once a round.

Tokens are compared by 64-bit hashes. A null text is empty: its one token is the end. Texts with a null id belong to the
training texts. Repeated rows count each time and score alike. Without any training text counts are 0 and all bins
are equally likely. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namebridge.llm import kernels as K
from namebridge.llm.stages import documents, held_out, small_batches, written

U64 = np.uint64
END = U64(0x5851F42D4C957F2D)
_START = U64(0x14057B7EF767814F)
_A, _B = U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F)
#: Features of a token's history.
KINDS = 3
#: Rows of a weight table that are mixed together.
_BLOCK = 4096


@dataclass(frozen=True)
class LanguageModelConfig:
    #: Bytes of text in a chunk.
    chunk_bytes: int = 12_000_000
    #: Classes, and bins of a class, at 100 MB of text; both grow with the eighth root of the bytes.
    side: int = 16
    #: Rows of a hashed weight table per bin, before rounding up to a power of two.
    rows_per_bin: int = 64
    batch: int = 4096
    rate: float = 0.25
    rounds: int = 1
    #: Uses of a row in a task from which on the tasks' changes are rather averaged than added.
    settled: float = 64.0


@dataclass(frozen=True)
class Sizes:
    """Classes and bins per class, and bits of the number of rows of a weight table."""

    side: int
    bits: int

    @property
    def bins(self) -> int:
        return self.side**2

    @property
    def top(self) -> int:
        """Bins of single words; the others hold the rest."""
        return self.bins // 2

    def rest(self, codes: np.ndarray) -> np.ndarray:
        """Bins of tokens without one of their own."""
        return self.top + codes.astype(np.int64) % (self.bins - self.top)


def sizes(total: int, config: LanguageModelConfig) -> Sizes:
    """Sizes for so many bytes of text: bins and rows grow with their fourth root."""
    side = max(4, round(config.side * (total / 1e8) ** 0.125))
    return Sizes(side, max(6, (config.rows_per_bin * side * side - 1).bit_length()))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens with an end after each text, codes of their last bytes, and each text's first token (one more)."""
    data = K.LOWER[data]
    starts, ends, first = K.words(data, offsets)
    words = K.span_hashes(data, starts, ends)
    if len(ends):
        last = (data[ends - 1].astype(np.int64) * 31 + data[np.maximum(ends - 2, starts)].astype(np.int64) * 7
                + data[np.maximum(ends - 3, starts)].astype(np.int64) * 1009 + np.minimum(ends - starts, 4))
    else:
        last = np.zeros(0, np.int64)
    n = len(offsets) - 1
    begin = first + np.arange(n + 1)
    out = np.full(len(words) + n, END)
    codes = np.zeros(len(words) + n, np.uint32)
    place = np.arange(len(words)) + np.repeat(np.arange(n), np.diff(first))
    out[place] = words
    codes[place] = last
    return out, codes, begin


def _features(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Hashes of every token's features: previous word, skip, bigram."""
    previous = np.concatenate([[_START], hashes[:-1]])
    before = np.concatenate([[_START, _START], hashes[:-2]])[: len(hashes)]
    first = begin[:-1]
    previous[first] = _START
    before[first] = _START
    second = first[np.diff(begin) > 1] + 1
    before[second] = _START
    a = K.mix(previous ^ U64(0x1234567))
    b = K.mix(before + U64(0x89ABCDE))
    return np.stack([a, b, K.mix(a + b * U64(3))])


def _softmax(x: np.ndarray) -> np.ndarray:
    """In place. Scores stay within 60 of zero, so no row's maximum is needed against overflow."""
    np.exp(np.clip(x, -60, 60, out=x), out=x)
    x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
    return x


class Weights:
    """Hashed weights of the classes and of the bins, a bias per class, and one per bin of each class."""

    def __init__(self, size: Sizes, counts: np.ndarray | None = None) -> None:
        """Biases from the number of tokens in each bin, if given."""
        self.size = size
        rows, side = 1 << size.bits, size.side
        known = np.full((side, side), 0.5) if counts is None else counts.reshape(side, side) + 0.5
        known /= known.sum()
        self.tables = [np.zeros((rows, side), np.float32), np.zeros((rows, side), np.float32),
                       np.log(known.sum(1)).astype(np.float32)[None],
                       np.log(known / known.sum(1, keepdims=True)).astype(np.float32)]

    def copy(self) -> Weights:
        out = Weights.__new__(Weights)
        out.size, out.tables = self.size, [t.copy() for t in self.tables]
        return out

    def rows(self, features: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the class table, and of the bin table, of the features."""
        shift = U64(64 - self.size.bits)
        own = (features + (classes.astype(U64) + U64(1)) * _A) * _B
        return (features >> shift).astype(np.int64), (own >> shift).astype(np.int64)

    def scores(self, rows: tuple[np.ndarray, np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the classes, and of the bins of the given classes."""
        x = np.repeat(self.tables[2], len(classes), 0)
        y = self.tables[3].take(classes, 0)
        for k in range(KINDS):
            x += self.tables[0].take(rows[0][k], 0)
            y += self.tables[1].take(rows[1][k], 0)
        return _softmax(x), _softmax(y)

    def log10(self, features: np.ndarray, bins: np.ndarray) -> np.ndarray:
        out = np.empty(len(bins))
        step = 1 << 13
        for s in range(0, len(bins), step):
            c, b = divmod(bins[s : s + step], self.size.side)
            p, q = self.scores(self.rows(features[:, s : s + step], c), c)
            at = np.arange(len(c))
            out[s : s + len(c)] = np.log10(np.maximum(p[at, c], 1e-30)) + np.log10(np.maximum(q[at, b], 1e-30))
        return out

    def step(self, features: np.ndarray, bins: np.ndarray, rate: float, squares: list, uses: list) -> None:
        """One gradient step (with a rate per row that falls as the row is used)."""
        c, b = divmod(bins, self.size.side)
        rows = self.rows(features, c)
        p, q = self.scores(rows, c)
        at = np.arange(len(bins))
        p[at, c] -= 1
        q[at, b] -= 1
        for table, g in enumerate((p, q)):
            for k in range(KINDS):
                row, total, n = _by_row(rows[table][k], g)
                seen = squares[table].take(row) + np.einsum("ij,ij->i", total, total) / np.float32(self.size.side)
                squares[table][row] = seen
                uses[table][row] += n
                total *= (-rate / np.sqrt(seen + 1))[:, None]
                total += self.tables[table].take(row, 0)
                self.tables[table][row] = total
        self.tables[2] -= rate * p.mean(0)
        uses[2] += len(c)
        row, total, n = _by_row(c, q)
        self.tables[3][row] -= rate * total / n[:, None]
        uses[3][row] += n


def _by_row(row: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, the sums of g and the numbers of entries of each."""
    bits = max(1, len(row).bit_length())
    key = np.sort((row << bits) | np.arange(len(row)))  # sorts rows and keeps the order within a row
    row, order = key >> bits, key & ((1 << bits) - 1)
    new = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    return row[new], np.add.reduceat(g.take(order, 0), new, axis=0), np.diff(np.append(new, len(row))).astype(np.float32)


def _chunked(docs: DataFrame, chunks: int) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), (~held_out(10, 0)).alias("learn"),
                       F.pmod(F.xxhash64("doc_id", text), F.lit(chunks)).cast("int").alias("chunk"))


_REQUEST = "block int, chunk int, hashes binary, counts binary, codes binary"


def _chunk_tokens(texts: pa.Array, learn: np.ndarray):
    """Distinct tokens of a chunk's texts: hashes in order, counts in training texts, codes of last bytes."""
    hashes, counts, codes = [], [], []
    for at, data, offsets in K.text_chunks(texts):
        h, code, begin = tokens(data, offsets)
        size = np.diff(begin)
        use = np.repeat(learn[at : at + len(size)], size)
        values, index, place = np.unique(h, return_index=True, return_inverse=True)
        hashes.append(values)
        counts.append(np.bincount(place, use, len(values)).astype(np.uint32))
        codes.append(code[index])
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    values, index, place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(values)).astype(np.uint32)
    return values, total, np.concatenate(codes)[index]


def _block_edges(hashes: np.ndarray, blocks: int) -> np.ndarray:
    step = (1 << 64) // blocks
    return np.concatenate([np.searchsorted(hashes, np.array([step * b for b in range(blocks)], U64)), [len(hashes)]])


def _requests(blocks: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        learn = table.column("learn").to_numpy(zero_copy_only=False).astype(float)
        hashes, counts, codes = _chunk_tokens(table.column("text"), learn)
        chunk = table.column("chunk")[0].as_py()
        edge = _block_edges(hashes, blocks)
        used = [b for b in range(blocks) if edge[b + 1] > edge[b]]
        cut = [slice(edge[b], edge[b + 1]) for b in used]
        return pa.table({
            "block": pa.array(used, pa.int32()), "chunk": pa.array([chunk] * len(used), pa.int32()),
            "hashes": pa.array([hashes[c].tobytes() for c in cut], pa.binary()),
            "counts": pa.array([counts[c].tobytes() for c in cut], pa.binary()),
            "codes": pa.array([codes[c].tobytes() for c in cut], pa.binary())})

    return run


def _count(size: Sizes):
    """For a block of tokens: counts back to every chunk (chunk >= 0), and sums and top words (chunk < 0)."""

    def run(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = [len(h) // 8 for h in rows["hashes"]]
        hashes = np.frombuffer(b"".join(rows["hashes"]), U64)
        counts = np.frombuffer(b"".join(rows["counts"]), np.uint32)
        codes = np.frombuffer(b"".join(rows["codes"]), np.uint32)
        values, index, place = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.bincount(place, counts, len(values)).astype(np.int64)
        edge = np.cumsum([0, *lengths])
        block = int(rows["block"].iloc[0])
        out = [(int(c), block, total[place[edge[k] : edge[k + 1]]].tobytes(), b"", b"")
               for k, c in enumerate(rows["chunk"])]
        rest = size.rest(codes[index])
        known = total > 0
        sums = np.stack([rest[known], total[known], np.ones(known.sum(), np.int64)], 1)
        top = np.argsort(-total, kind="stable")[: size.top]
        top = top[total[top] > 0]
        best = np.stack([values[top].view(np.int64), total[top], rest[top]], 1)
        out.append((-1, block, b"", _summed(sums).tobytes(), best.tobytes()))
        return pd.DataFrame(out, columns=["chunk", "block", "counts", "sums", "top"])

    return run


def _summed(rows: np.ndarray) -> np.ndarray:
    """Rows of (bin, tokens, kinds), one per bin that occurs."""
    bins, place = np.unique(rows[:, 0], return_inverse=True)
    return np.stack([bins, *(np.bincount(place, rows[:, k], len(bins)).astype(np.int64) for k in (1, 2))], 1)


def _best(rows: np.ndarray, size: Sizes) -> np.ndarray:
    """The most frequent of rows of (word, tokens, rest bin)."""
    return rows[np.lexsort((rows[:, 0], -rows[:, 1]))][: size.top]


@dataclass
class Bins:
    """Bins of the most frequent words, and sums (count, kinds) of every bin."""

    size: Sizes
    words: np.ndarray
    place: np.ndarray
    sums: np.ndarray

    def of(self, hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        rest = self.size.rest(codes)
        if not len(self.words):
            return rest
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.place[at], rest)

    def within(self, counts: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """log10 of a token's share of its bin: counts plus 0.1, with room for unseen tokens."""
        share = (counts + 0.1) / (self.sums[bins, 0] + 0.1 * (self.sums[bins, 1] + 1))
        return np.where(bins < self.size.top, 0.0, np.log10(share))


def _bins(stats: list, size: Sizes) -> tuple[Bins, int, int]:
    """From the block rows: bins, number of training tokens and of distinct ones."""
    sums = np.zeros((size.bins, 2), np.int64)
    best = [np.zeros((0, 3), np.int64)]
    for row in stats:
        own = np.frombuffer(row.sums, np.int64).reshape(-1, 3)
        sums[own[:, 0]] += own[:, 1:]
        best.append(np.frombuffer(row.top, np.int64).reshape(-1, 3))
    best = _best(np.concatenate(best), size)
    n, v = int(sums[:, 0].sum()), int(sums[:, 1].sum())
    for k, (_, count, rest) in enumerate(best):  # they leave the bins of the rest
        sums[rest] -= (count, 1)
        sums[k] = (count, 1)
    words = np.ascontiguousarray(best[:, 0]).view(U64)
    order = np.argsort(words)
    return Bins(size, words[order], order.astype(np.int64), sums), n, v


_CHANGE = "part int, row int, uses binary, tasks binary, squares binary, delta binary"


def _gain(uses: np.ndarray, tasks: np.ndarray, squares: np.ndarray, settled: float) -> np.ndarray:
    """What the mean change of a row is multiplied by, 1 to the number of tasks that used it.

    Changes are added as far as tasks had few uses of the row, at the rate that falls with all tasks' squares.
    """
    added = np.minimum(tasks, 1 + settled / np.maximum(uses / tasks, 1))
    return np.maximum(1, added * np.sqrt((squares / tasks + 1) / (squares + 1)))


def _train(docs: DataFrame, bins: Bins, config: LanguageModelConfig) -> Weights:
    context = docs.sparkSession.sparkContext
    weights = Weights(bins.size, bins.sums[:, 0])
    rows = docs.where(~held_out(10, 0)).select("text")
    for _ in range(config.rounds):
        shared = context.broadcast((weights, bins))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start, b = shared.value
            own = start.copy()
            squares = [np.zeros(len(t), np.float32) for t in own.tables]
            uses = [np.zeros(len(t), np.float32) for t in own.tables]
            for batch in batches:
                for _, data, offsets in K.text_chunks(batch.column("text")):
                    h, codes, begin = tokens(data, offsets)
                    kind = b.of(h, codes)
                    features = _features(h, begin)
                    for s in range(0, len(h), config.batch):
                        own.step(features[:, s : s + config.batch], kind[s : s + config.batch], config.rate, squares, uses)
            for part, (table, before, n, q) in enumerate(zip(own.tables, start.tables, uses, squares, strict=True)):
                for s in range(0, len(table), _BLOCK):
                    u = n[s : s + _BLOCK]
                    if u.any():
                        delta = (table[s : s + _BLOCK] - before[s : s + _BLOCK]) * u[:, None]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([part], pa.int32()), pa.array([s], pa.int32()),
                             *(pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in (u, u > 0, q[s : s + _BLOCK], delta))],
                            names=["part", "row", "uses", "tasks", "squares", "delta"])

        def add(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            out = rows[["part", "row"]].iloc[:1].reset_index(drop=True)
            for name in ("uses", "tasks", "squares", "delta"):
                total = np.zeros(len(rows[name].iloc[0]) // 4)
                for x in rows[name]:
                    total += np.frombuffer(x, np.float32)
                out[name] = [total.astype(np.float32).tobytes()]
            return out

        # Sums in two steps, so that no task adds up the changes of all others.
        changes = rows.mapInArrow(run, _CHANGE).withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(32)))
        sums = changes.groupBy("_g", "part", "row").applyInPandas(lambda k, r: add(k, r.drop(columns="_g")), _CHANGE) \
            .groupBy("part", "row").applyInPandas(add, _CHANGE)
        for r in sums.collect():
            uses, tasks, squares, delta = (np.frombuffer(x, np.float32) for x in (r.uses, r.tasks, r.squares, r.delta))
            mean = delta.reshape(len(uses), -1) / np.maximum(uses, 1)[:, None]
            if r.part < 2:
                mean *= _gain(uses, np.maximum(tasks, 1), squares, config.settled)[:, None]
            weights.tables[r.part][r.row : r.row + len(uses)] += mean
        shared.unpersist()
    return weights


def score(docs: DataFrame, config: LanguageModelConfig | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs."""
    config = config or LanguageModelConfig()
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // config.chunk_bytes))
    size = sizes(total, config)
    rows = _chunked(docs, chunks)
    counted = written(rows.groupBy("chunk").applyInArrow(_requests(chunks), _REQUEST).groupBy("block").applyInPandas(
        _count(size), "chunk int, block int, counts binary, sums binary, top binary"), "counts")
    bins, n, v = _bins(_merged(counted.where("chunk < 0").select("sums", "top"), size), size)
    weights = _train(docs, bins, config)
    shared = docs.sparkSession.sparkContext.broadcast((weights, bins))
    denominator = n + 0.1 * (v + 1)

    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        model, b = shared.value
        texts = texts.combine_chunks()
        blobs = sorted(zip(counts.column("block").to_pylist(), counts.column("counts").to_pylist(), strict=True))
        known = np.frombuffer(b"".join(x for _, x in blobs), np.int64)
        column = texts.column("text")
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        parts = [(at, *tokens(data, offsets)) for at, data, offsets in K.text_chunks(column)]
        order = np.unique(np.concatenate([np.unique(p[1]) for p in parts])) if parts else np.zeros(0, U64)
        n_tokens, n_known, base, full = [], [], [], []
        for _, h, codes, begin in parts:
            c = known[np.searchsorted(order, h)]
            kind = b.of(h, codes)
            low = np.log10((c + 0.1) / denominator)
            high = model.log10(_features(h, begin), kind) + b.within(c, kind)
            n_tokens.append(np.diff(begin))
            n_known.append(np.add.reduceat((c > 0).astype(np.int64), begin[:-1]))
            base.append(np.add.reduceat(low, begin[:-1]))
            full.append(np.add.reduceat(high, begin[:-1]))
        whole = [np.concatenate(x) for x in (n_tokens, n_known, base, full)]
        return pa.table({"doc_id": texts.column("doc_id"), "learn": texts.column("learn"), "n_tokens": whole[0],
                         "n_known": whole[1], "base_score": whole[2], "score": whole[3]})

    answers = counted.where("chunk >= 0").select("chunk", "block", "counts")
    out = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        run, "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
                      F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _merged(stats: DataFrame, size: Sizes) -> list:
    """The block rows, combined on the executors to at most 64."""

    def run(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sums = np.concatenate([np.frombuffer(s, np.int64).reshape(-1, 3) for s in rows["sums"]])
        best = np.concatenate([np.frombuffer(t, np.int64).reshape(-1, 3) for t in rows["top"]])
        return pd.DataFrame({"sums": [_summed(sums).tobytes()], "top": [_best(best, size).tobytes()]})

    return stats.withColumn("_g", F.pmod(F.xxhash64("top"), F.lit(64))).groupBy("_g").applyInPandas(
        lambda k, r: run(k, r.drop(columns="_g")), "sums binary, top binary").collect()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
