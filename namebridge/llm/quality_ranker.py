"""Operator 12: a quality classifier that learns from pairs which of two documents is the better one.

Every label 1 is preferred to every label 0. The Bradley-Terry model gives each document a worth, here a linear
function of its features, and says that i beats j with probability sigma(worth_i - worth_j); the logistic loss on the
differences of features is minimised over sampled pairs. A text's features are rates over its whole length (words,
letters, signs, repeats, lines) and hashed counts of words and of their shapes.

A worth has no zero of its own: the cut is a quantile of the worths of labelled rows that the fit has not seen. Its
level is given, or the one that parts the two labels best. The score is sigma(slope * (worth - cut) + logit(0.7)), so
0.7 is the cut everywhere. ``top_share`` takes the cut as a quantile of a whole scored table instead.

A null or empty text has the features of a text without words. Labels that are null, or of documents that do not
exist, are ignored; of several labels of a document the smaller counts. Of rows that share an id, training uses one
(that of the smallest hash of its text); scoring gives each its own score, equal for equal texts. Without a document
of each label every score is 0. Nulls in other columns and further columns do not matter; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namebridge.llm import kernels as K
from namebridge.llm.stages import documents, held_out, small_batches

CUT = 0.7
_LOGIT = float(np.log(CUT / (1 - CUT)))


@dataclass(frozen=True)
class RankerConfig:
    #: Labelled documents of each class that training reads at most: a bound, whatever the table's size.
    rows_per_class: int = 2500
    #: Hashed features of words and shapes.
    bins: int = 2048
    #: Pairs that each epoch draws for every training document of the larger class.
    pairs: int = 4
    epochs: int = 12
    batch: int = 64
    rate: float = 0.05
    #: Pull of the hashed weights towards zero.
    decay: float = 1e-4
    #: Every so many training rows are kept from the fit and used for the cut.
    holdout: int = 4
    #: Quantile of the worths at which the cut is set; None: the level that parts the labels best.
    level: float | None = None
    seed: int = 11


_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:'\"()-"]] = True
_CALL = np.zeros(256, bool)
_CALL[[ord(c) for c in "!?"]] = True
_SIGN = ~(_LETTER | _DIGIT | _STOP | _CALL | K.SPACE)
_KINDS = (_UPPER, _LETTER, _DIGIT, _STOP, _CALL, _SIGN)
#: Byte classes of which a word's shape is made: runs of one class count once.
_CLASS = np.zeros(256, np.uint8)
for _k, _kind in enumerate((_LETTER, _UPPER, _DIGIT, _STOP, _CALL, _SIGN), 1):
    _CLASS[_kind] = _k
DENSE = len(_KINDS) + 10


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of distinct hashes of each text."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=len(first) - 1)


def features(data: np.ndarray, offsets: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Dense rates and hashed counts of each text: arrays of DENSE and of ``bins`` columns."""
    n = len(offsets) - 1
    starts, ends, first = K.words(data, offsets)
    words = np.diff(first)
    some = np.maximum(words, 1)
    size = np.maximum(np.diff(offsets), 1)
    low = K.LOWER[data]
    hashes = K.span_hashes(low, starts, ends)
    grams, gram_first = K.shingles(hashes, first, 3)
    line_starts, line_ends = K.spans(data != 0x0A, offsets)
    line_first = np.searchsorted(line_starts, offsets)
    lines = np.maximum(np.diff(line_first), 1)
    length = ends - starts
    long_words = _per_text(length > 12, first)
    last = _CLASS[data[ends - 1]] if len(ends) else np.zeros(0, np.uint8)
    columns = [_per_text(kind[data], offsets) / size for kind in _KINDS]
    columns += [
        np.log1p(words), np.minimum(words, 50) / 50, _per_text(length, first) / some / 8,
        _distinct(hashes, first) / some, _distinct(grams, gram_first) / np.maximum(np.diff(gram_first), 1),
        _distinct(K.span_hashes(data, line_starts, line_ends), line_first) / lines,
        np.log1p(size / lines), long_words / some, _per_text(last >= 5, first) / some, _per_text(last == 4, first) / some,
    ]
    dense = np.stack(columns, 1).astype(np.float32)

    shape = _CLASS[data]
    kept = np.ones(len(shape), bool)
    kept[1:] = shape[1:] != shape[:-1]
    # A word begins a run (the blank before it is of another class), except at the start of a text.
    kept[starts] = True
    at = np.concatenate([[0], np.cumsum(kept)])
    shapes = K.span_hashes(shape[kept], at[starts], at[ends])
    owner = np.repeat(np.arange(n), words)
    half = bins // 2
    out = np.zeros((n, bins), np.float32)
    for codes, begin in ((hashes, 0), (shapes, half)):
        cell = owner * half + (codes >> np.uint64(40)).astype(np.int64) % half
        count = np.bincount(cell, minlength=n * half).reshape(n, half)
        weight = np.sqrt(count, dtype=np.float32)
        out[:, begin : begin + half] = weight / np.maximum(np.sqrt((weight**2).sum(1, keepdims=True)), 1e-9)
    return dense, out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the dense columns, then of the bins
    cut: float = 0.0
    slope: float = 1.0
    level: float = 0.0

    def worth(self, dense: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        z = np.clip((dense - self.mean) / self.scale, -5, 5)
        # Sums along rows, not a matrix product: a text's worth does not depend on its neighbours in the batch.
        return ((z * self.weights[:DENSE]).sum(1) + (hashed * self.weights[DENSE:]).sum(1)).astype(np.float64)

    def score(self, worth: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (worth - self.cut) + _LOGIT, -30, 30)))


def pair_loss(weights: np.ndarray, better: np.ndarray, worse: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean of log(1 + exp(-(worth of better - worth of worse))) over the pairs, and its gradient."""
    difference = better - worse
    margin = difference @ weights
    wrong = 1 / (1 + np.exp(np.clip(margin, -30, 30)))
    return float(np.logaddexp(0, -margin).mean()), -(difference * wrong[:, None]).mean(0)


def quantile_cut(worth: np.ndarray, labels: np.ndarray, level: float | None) -> tuple[float, float]:
    """(level, cut): the quantile of the worths at this level, or at the one with the largest sum of the two recalls.

    The cut lies halfway between the two worths next to the level.
    """
    order = np.argsort(worth, kind="stable")
    w, y = worth[order], labels[order]
    if level is None:
        below = np.concatenate([[0], np.cumsum(y == 0)]) / max(1, (y == 0).sum())
        lost = np.concatenate([[0], np.cumsum(y == 1)]) / max(1, (y == 1).sum())
        k = int((below - lost).argmax())
    else:
        k = round(level * len(w))
    k = min(max(k, 1), len(w) - 1) if len(w) > 1 else 0
    cut = (w[k - 1] + w[k]) / 2 if len(w) > 1 else (float(w[0]) if len(w) else 0.0)
    return k / max(1, len(w)), float(cut)


def fit(dense: np.ndarray, hashed: np.ndarray, labels: np.ndarray, config: RankerConfig) -> Model | None:
    """The model of rows with labels 0 and 1; None without both."""
    if len(labels) == 0 or labels.min() == labels.max():
        return None
    random = np.random.default_rng(config.seed)
    order = random.permutation(len(labels))
    test, train = order[:: config.holdout], np.delete(order, np.s_[:: config.holdout])
    if len(np.unique(labels[train])) < 2 or len(np.unique(labels[test])) < 2:
        test = train = order
    mean, scale = dense[train].mean(0), dense[train].std(0) + 1e-3
    z = np.concatenate([np.clip((dense - mean) / scale, -5, 5), hashed], 1).astype(np.float32)
    good, bad = train[labels[train] == 1], train[labels[train] == 0]
    weights = np.zeros(z.shape[1])
    seen = np.full_like(weights, 1e-3)
    pull = np.full_like(weights, config.decay)
    count = config.pairs * max(len(good), len(bad))
    for _ in range(config.epochs):
        better, worse = random.choice(good, count), random.choice(bad, count)
        for begin in range(0, count, config.batch):
            _, gradient = pair_loss(weights, z[better[begin : begin + config.batch]], z[worse[begin : begin + config.batch]])
            gradient += pull * weights
            seen += gradient**2
            weights -= config.rate * gradient / np.sqrt(seen)
    model = Model(mean, scale, weights.astype(np.float32))
    worth = model.worth(dense[test], hashed[test])
    model.level, model.cut = quantile_cut(worth, labels[test], config.level)
    model.slope = float(2 / max(1e-6, np.abs(worth - model.cut).mean()))
    return model


def training_rows(docs: DataFrame, labels: DataFrame, config: RankerConfig) -> list[tuple]:
    """(doc_id, label, features) of at most rows_per_class documents of each label, the same at every run.

    What reaches the driver is bounded: two numbers for each chosen id, then one row of at most 6 * bins bytes of
    features for each id, whatever the number of rows that share it.
    """
    spark = docs.sparkSession
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(4, 2))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = []
    for c in (0, 1):
        part = usable.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(config.rows_per_class)
        chosen += [(r.doc_id, int(r.quality)) for r in part.collect()]
    # At most 2 * rows_per_class rows of two numbers: safe to send to every task.
    ids = F.broadcast(spark.createDataFrame(chosen, "doc_id long, quality int"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id") \
        .select("doc_id", "quality", F.xxhash64("text").alias("h"), "text")
    bins = config.bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in K.text_chunks(batch.column("text"), 1 << 18):
                dense, hashed = features(data, offsets, bins)
                part = batch.slice(at, len(dense))
                places = [np.flatnonzero(row).astype(np.uint16) for row in hashed]
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:3], pa.array([row.tobytes() for row in dense], pa.binary()),
                    pa.array([p.tobytes() for p in places], pa.binary()),
                    pa.array([row[p].tobytes() for row, p in zip(hashed, places, strict=True)], pa.binary()),
                ], names=["doc_id", "quality", "h", "dense", "places", "vals"])

    found = rows.mapInArrow(run, "doc_id long, quality int, h long, dense binary, places binary, vals binary")
    one = found.groupBy("doc_id").agg(F.min(F.struct("h", "quality", "dense", "places", "vals")).alias("r"))
    return sorted((r.doc_id, r.r.quality, bytes(r.r.dense), bytes(r.r.places), bytes(r.r.vals)) for r in one.collect())


def train(docs: DataFrame, labels: DataFrame, config: RankerConfig | None = None) -> Model | None:
    config = config or RankerConfig()
    small_batches(docs.sparkSession)
    rows = training_rows(docs, labels, config)
    dense = np.array([np.frombuffer(r[2], np.float32) for r in rows]).reshape(-1, DENSE)
    hashed = np.zeros((len(rows), config.bins), np.float32)
    for i, r in enumerate(rows):
        hashed[i, np.frombuffer(r[3], np.uint16)] = np.frombuffer(r[4], np.float32)
    return fit(dense, hashed, np.array([r[1] for r in rows], np.int64), config)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with score and predicted."""
    small_batches(docs.sparkSession)
    kept = docs.drop("score", "predicted")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at, data, offsets in K.text_chunks(batch.column("text"), 1 << 18):
                if m is None:
                    p = np.zeros(len(offsets) - 1)
                else:
                    p = m.score(m.worth(*features(data, offsets, len(m.weights) - DENSE)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, len(p)).columns, pa.array(p), pa.array((p >= CUT).astype(np.int32))],
                    names=schema.names)

    return kept.mapInArrow(run, schema)


def top_share(scored: DataFrame, share: float, accuracy: int = 10000) -> DataFrame:
    """The rows of a scored table whose score reaches its (1 - share) quantile, ties included.

    The quantile is found by sketches that tasks merge; accuracy is that of percentile_approx.
    """
    cut = scored.agg(F.percentile_approx("score", 1 - share, accuracy)).first()[0]
    return scored.where(F.lit(False)) if cut is None else scored.where(F.col("score") >= cut)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")
