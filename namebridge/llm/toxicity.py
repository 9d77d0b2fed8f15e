"""Operator 4: a convolutional text classifier in numpy, with thresholds calibrated by language.

Words are looked up in two hashed embedding tables (their sum tells apart words that share a row of one),
filters of several widths run over the sequence, each keeps its largest response over the whole text, and a
logistic layer reads these maxima. The first embedding dimension starts as the word's log-odds; everything is
then trained by gradient descent through the winning positions, on all labelled rows: tasks train side by side, and after
each epoch their changes are averaged.

Thresholds are set per language on training rows kept from the fit. The language group of a text comes from
its letters alone (its lang column is never read), and the logit is shifted by the group's threshold, so that
0.5 is the calibrated cut everywhere.

A null or empty text gets the score of a text without words. Labels that are null, or of documents that do not
exist, are ignored; of several labels of a document the larger counts. Without any positive and any negative
label every score is 0. Repeated rows get equal scores; nulls in other columns and further columns do not matter;
an empty table gives an empty result.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namebridge.llm import kernels as K
from namebridge.llm.stages import documents, held_out, small_batches, written

ROWS = 1 << 16
#: Labelled documents up to which they are sent to every task.
_BROADCAST_ROWS = 200_000
#: Letters that mark a language group: second bytes after 0xC3. Fixed values.
GROUPS = {"de": (0xA4, 0xB6, 0xBC, 0x9F), "es": (0xB1, 0xB3, 0xAD, 0xA1), "fr": (0xA7, 0xA8, 0xAA, 0xA0)}
NAMES = ("other", *GROUPS)

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


@dataclass(frozen=True)
class ToxicityConfig:
    #: Labelled rows, and bytes of their words, that one task trains on; more rows make more tasks.
    rows_per_task: int = 6000
    bytes_per_task: int = 1 << 24
    dimensions: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 16
    epochs: int = 6
    batch: int = 32
    rate: float = 0.02
    #: Positive calibration rows that a language group needs for a threshold of its own.
    least_positives: int = 15
    seed: int = 7


@dataclass
class Model:
    tables: list[np.ndarray]
    filters: list[np.ndarray]  # one of (width, dimensions, filters) for each width
    bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    constant: float | None = None

    def threshold(self, group: int) -> float:
        return self.thresholds.get(NAMES[group], self.thresholds.get("", 0.0))


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 16-bit rows of each word in one number, and each text's first word (one entry more)."""
    data = K.LOWER[data]
    starts, ends = K.spans(_WORD[data], offsets)
    codes = (K.span_hashes(data, starts, ends) >> np.uint64(32)).astype(np.uint32)
    return codes, np.searchsorted(starts, offsets)


def language_groups(data: np.ndarray, offsets: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """The group of each text: whose letters make up at least one for twenty words, most of all groups."""
    at = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.zeros(0, np.int64)
    letter = data[at].copy()
    letter[(letter >= 0x80) & (letter < 0x9F)] += 0x20
    text = np.searchsorted(offsets, at, "right") - 1
    n = len(offsets) - 1
    counts = np.stack([np.bincount(text[np.isin(letter, c)], minlength=n) for c in GROUPS.values()])
    best = counts.argmax(0)
    return np.where(counts[best, np.arange(n)] * 20 > n_words, best + 1, 0)


def _pool(model: Model, codes: np.ndarray, first: np.ndarray, where: bool = False):
    """Largest responses of every filter per text, from 0 up; with ``where`` also the winning positions."""
    n = len(first) - 1
    count = np.diff(first)
    x = model.tables[0][codes >> 16] + model.tables[1][codes & 0xFFFF]
    pooled, winners = [], []
    for k, w in enumerate(model.filters):
        width = len(w)
        f = model.bias[k]
        response = np.full((len(codes), w.shape[2]), f, np.float32)
        for j in range(width):
            part = x[j:] @ w[j]
            response[: len(part)] += part
        last = np.repeat(first[1:], count)
        beyond = np.arange(len(codes)) + width > last
        response[beyond] = -1e9
        full = count > 0
        top = np.full((n, w.shape[2]), -1e9, np.float32)
        if full.any():
            top[full] = np.maximum.reduceat(response, first[:-1][full])
        if where:
            position = np.full((n, w.shape[2]), -1)
            hit_row, hit_col = np.nonzero(response == np.repeat(top, count, axis=0))
            position[np.repeat(np.arange(n), count)[hit_row][::-1], hit_col[::-1]] = hit_row[::-1]
            winners.append(position)
        pooled.append(np.maximum(top, 0))
    return np.concatenate(pooled, 1), x, winners


def logits(model: Model, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    return _pool(model, codes, first)[0] @ model.out + model.shift


def first_model(odds: list[np.ndarray], config: ToxicityConfig) -> Model:
    """The model before training: the first embedding dimension is the log-odds of a row."""
    random = np.random.default_rng(config.seed)
    d, f = config.dimensions, config.filters
    tables = []
    for half in range(2):
        table = random.normal(0, 0.05, (ROWS, d)).astype(np.float32)
        table[:, 0] = np.clip(odds[half], -3, 3) / 4
        tables.append(table)
    filters = [random.normal(0, 0.2, (w, d, f)).astype(np.float32) for w in config.widths]
    for w in filters:
        w[:, 0, : f // 2] = np.abs(w[:, 0, : f // 2]) + 0.5
    return Model(tables, filters, np.zeros((len(filters), f), np.float32),
                 random.normal(0, 0.1, len(filters) * f).astype(np.float32))


def fit(model: Model, texts: list[np.ndarray], labels: np.ndarray, config: ToxicityConfig, epochs: int,
        seed: int) -> None:
    """Trains the model in place on the rows of one task."""
    random, f, d = np.random.default_rng(seed), config.filters, config.dimensions
    train = random.permutation(len(labels))
    seen: dict[int, np.ndarray] = {}

    def step(name: int, value: np.ndarray, gradient: np.ndarray) -> None:
        seen[name] = seen.get(name, np.full_like(value, 1e-3)) + gradient**2
        value -= (config.rate * gradient / np.sqrt(seen[name])).astype(np.float32)

    sums = [np.full((ROWS, 1), 1e-2, np.float32) for _ in range(2)]
    for _ in range(epochs):
        random.shuffle(train)
        for begin in range(0, len(train), config.batch):
            rows = train[begin : begin + config.batch]
            codes = np.concatenate([texts[i] for i in rows])
            first = np.concatenate([[0], np.cumsum([len(texts[i]) for i in rows])])
            pooled, x, winners = _pool(model, codes, first, where=True)
            p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.shift, -30, 30)))
            error = ((p - labels[rows]) / len(rows)).astype(np.float32)
            back = np.outer(error, model.out) * (pooled > 0)
            step(0, model.out, pooled.T @ error)
            model.shift -= config.rate * float(error.sum())
            gx: dict[int, list] = {"at": [], "g": []}
            for k, w in enumerate(model.filters):
                g = back[:, k * f : (k + 1) * f]
                doc, col = np.nonzero((g != 0) & (winners[k] >= 0))
                at, value = winners[k][doc, col], g[doc, col]
                grad = np.zeros_like(w)
                for j in range(len(w)):
                    np.add.at(grad[j].T, col, x[at + j] * value[:, None])
                    gx["at"].append(at + j)
                    gx["g"].append(w[j].T[col] * value[:, None])
                step(10 + k, w, grad)
                bias = np.zeros(f, np.float32)
                np.add.at(bias, col, value)
                step(20 + k, model.bias[k], bias)
            at, g = np.concatenate(gx["at"]), np.concatenate(gx["g"])
            for half in range(2):
                row, place = np.unique(codes[at] >> 16 if half == 0 else codes[at] & 0xFFFF, return_inverse=True)
                total = np.zeros((len(row), d), np.float32)
                np.add.at(total, place, g)
                sums[half][row] += (total**2).mean(1, keepdims=True)
                model.tables[half][row] -= config.rate * total / np.sqrt(sums[half][row])


def best_threshold(z: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> float:
    """The cut with the largest recall less twice the false alarm rate, midway between two of the distinct values z."""
    order = np.argsort(-z, kind="stable")
    z, positive, negative = z[order], positive[order], negative[order]
    found = np.cumsum(positive) / max(1, positive.sum())
    wrong = np.cumsum(negative) / max(1, negative.sum())
    k = int((found - 2 * wrong).argmax())
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k]) - 0.5


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, grp, codes, test) of every labelled document; a fifth of them, by their id, is kept from the fit."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(5, 0))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    usable = usable.where(F.col("toxic").isin(0, 1))
    # Few labels go to the texts rather than the texts through a shuffle.
    if usable.count() <= _BROADCAST_ROWS:
        usable = F.broadcast(usable)
    rows = texts.join(usable, "doc_id").select("doc_id", "toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in K.text_chunks(batch.column("text")):
                codes, first = word_codes(data, offsets)
                group = language_groups(data, offsets, np.diff(first))
                part = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic"), pa.array(group.astype(np.int32)),
                     pa.array([codes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                    names=["doc_id", "toxic", "grp", "codes"])

    got = rows.mapInArrow(K.tidy(run), "doc_id long, toxic int, grp int, codes binary")
    return got.withColumn("test", F.pmod(F.xxhash64(F.lit("test"), "doc_id"), F.lit(5)) == 0)


def log_odds(rows: DataFrame, of_class: list[int]) -> list[np.ndarray]:
    """Log-odds of both tables' rows, from the documents of each class that hold them; every document counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros((2, 2, ROWS), np.int64)
        for batch in batches:
            for label, raw in zip(batch.column("toxic").to_pylist(), batch.column("codes").to_pylist(), strict=True):
                codes = np.frombuffer(raw, np.uint32)
                for half, at in enumerate((codes >> 16, codes & 0xFFFF)):
                    hits[half, label, np.unique(at)] += 1
        half, label, row = np.nonzero(hits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(half.astype(np.int32)), pa.array(label.astype(np.int32)), pa.array(row.astype(np.int32)),
             pa.array(hits[half, label, row])], names=["half", "label", "row", "n"])

    counts = rows.select("toxic", "codes").mapInArrow(K.tidy(run), "half int, label int, row int, n long")
    hits = np.ones((2, 2, ROWS))
    # At most four numbers for each of the 65,536 rows of a table, as columns: so many row objects fill the driver.
    got = counts.groupBy("half", "label", "row").agg(F.sum("n").alias("n")).toArrow()
    half, label, row, n = (got.column(c).to_numpy() for c in ("half", "label", "row", "n"))
    hits[half, label, row] += n
    total = np.array(of_class) + 2
    return [np.log(h[1] / total[1]) - np.log(h[0] / total[0]) for h in hits]


def _dense(model: Model) -> np.ndarray:
    """Everything but the tables, in one vector."""
    return np.concatenate([*(w.ravel() for w in model.filters), model.bias.ravel(), model.out, [model.shift]])


def _set_dense(model: Model, vector: np.ndarray) -> None:
    for part in (*model.filters, model.bias, model.out):
        part[...] = vector[: part.size].reshape(part.shape)
        vector = vector[part.size :]
    model.shift = float(vector[0])


def mixed(rows: DataFrame, model: Model, config: ToxicityConfig, epochs: int, turn: int) -> None:
    """Every task trains on its rows from the same model; what a number changed by is averaged over the tasks that used it."""
    d = config.dimensions
    shared = rows.sparkSession.sparkContext.broadcast(model)  # tables of fixed size
    values = [f"v{i}" for i in range(d)]

    def run(table: pa.Table) -> pa.Table:
        ordered = sorted(zip(*(table.column(c).to_pylist() for c in ("doc_id", "toxic", "codes")), strict=True))
        own = copy.deepcopy(shared.value)
        before = _dense(own)
        fit(own, [np.frombuffer(r[2], np.uint32) for r in ordered], np.array([r[1] for r in ordered], np.int64),
            config, epochs, config.seed + turn)
        part, row, change = [], [], []
        for half in range(2):
            delta = own.tables[half].astype(np.float64) - shared.value.tables[half]
            used = np.flatnonzero(delta.any(1))
            part.append(np.full(len(used), half))
            row.append(used)
            change.append(delta[used])
        dense = _dense(own) - before
        dense = np.pad(dense, (0, -len(dense) % d)).reshape(-1, d)
        part.append(np.full(len(dense), 2))
        row.append(np.arange(len(dense)))
        change.append(dense)
        # Whole numbers, so that their sum does not depend on the order of the tasks.
        whole = np.rint(np.concatenate(change) * 2.0**32).astype(np.int64)
        return pa.table([pa.array(np.concatenate(part).astype(np.int32)), pa.array(np.concatenate(row).astype(np.int32)),
                         *(pa.array(whole[:, i].copy()) for i in range(d))], names=["part", "row", *values])

    schema = ", ".join(["part int", "row int", *(f"{v} long" for v in values)])
    changes = rows.groupBy("task").applyInArrow(run, schema)
    # As many rows as the model has; written, so that the shuffles of each epoch are freed.
    sums = changes.groupBy("part", "row").agg(F.count("*").alias("n"), *(F.sum(v).alias(v) for v in values))
    means = [(F.col(v) / F.lit(2.0**32) / F.col("n")).alias(v) for v in values]
    mean = written(sums, "toxicity-changes").select("part", "row", *means)
    shared.destroy()  # else the driver holds the models of all epochs
    for half in range(2):
        # A table at a time, in the numbers that it holds.
        got = mean.where(F.col("part") == half).select("row", *(F.col(v).cast("float").alias(v) for v in values)).toArrow()
        row = got.column("row").to_numpy()
        for i, v in enumerate(values):
            model.tables[half][row, i] += got.column(v).to_numpy()
    got = mean.where(F.col("part") == 2).toArrow()
    order = np.argsort(got.column("row").to_numpy())
    dense = _dense(model)
    change = np.stack([got.column(v).to_numpy() for v in values], 1)[order].ravel()
    _set_dense(model, dense + change[: len(dense)])
    del got
    K.release()


def calibrate(model: Model, rows: DataFrame, config: ToxicityConfig) -> None:
    """Thresholds from all rows kept from the fit, counted by logits in steps of 1/1024."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(raw, np.uint32) for raw in batch.column("codes").to_pylist()]
            for at in range(0, len(texts), 256):
                some = texts[at : at + 256]
                first = np.concatenate([[0], np.cumsum([len(t) for t in some])])
                z = np.clip(logits(shared.value, np.concatenate(some), first), -30, 30)
                part = batch.slice(at, len(some))
                yield pa.RecordBatch.from_arrays(
                    [part.column("grp"), part.column("toxic"), pa.array(np.floor(z * 1024).astype(np.int32))],
                    names=["grp", "toxic", "step"])

    steps = rows.select("grp", "toxic", "codes").mapInArrow(K.tidy(run), "grp int, toxic int, step int")
    counts = steps.groupBy("grp", "step").agg(
        F.sum("toxic").alias("positive"), F.sum(1 - F.col("toxic")).alias("negative")).collect()
    shared.destroy()
    if not counts:
        return
    grp, step, positive, negative = np.array([tuple(r) for r in counts], np.int64).T
    if not positive.sum() or not negative.sum():
        return

    def threshold(own: np.ndarray) -> float:
        value, place = np.unique(step[own], return_inverse=True)
        return best_threshold((value + 0.5) / 1024, np.bincount(place, positive[own]), np.bincount(place, negative[own]))

    model.thresholds[""] = threshold(grp >= 0)
    for g, name in enumerate(NAMES):
        own = grp == g
        if positive[own].sum() >= config.least_positives and negative[own].any():
            model.thresholds[name] = threshold(own)


def train(docs: DataFrame, labels: DataFrame, config: ToxicityConfig | None = None) -> Model:
    """A model of all labelled rows. Tasks of bounded size train side by side, an epoch at a time, from the mixed model."""
    config = config or ToxicityConfig()
    small_batches(docs.sparkSession)
    rows = written(training_rows(docs, labels), "toxicity-rows")
    kinds = rows.groupBy("test", "toxic").agg(F.count("*").alias("n"), F.sum(F.length("codes")).alias("size")).collect()
    if len({r.toxic for r in kinds}) < 2:
        return Model([], [], np.zeros(0), np.zeros(0), constant=0.0)
    fitted = [r for r in kinds if not r.test]
    part = rows.where(~F.col("test"))
    if len(fitted) < 2:
        fitted, part = kinds, rows
    of_class = [sum(r.n for r in fitted if r.toxic == c) for c in (0, 1)]
    tasks = max(-(-sum(of_class) // config.rows_per_task), -(-sum(r.size for r in fitted) // config.bytes_per_task), 1)
    model = first_model(log_odds(part, of_class), config)
    dealt = part.withColumn("task", F.pmod(F.xxhash64(F.lit("task"), "doc_id"), F.lit(tasks)))
    turns = 1 if tasks == 1 else config.epochs
    for turn in range(turns):
        mixed(dealt, model, config, config.epochs // turns, turn)
    calibrate(model, rows.where("test"), config)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score and predicted."""
    small_batches(docs.sparkSession)
    kept = docs.drop("score", "predicted")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at, data, offsets in K.text_chunks(batch.column("text"), 1 << 18):
                codes, first = word_codes(data, offsets)
                if m.constant is not None:
                    p = np.full(len(offsets) - 1, m.constant)
                else:
                    group = language_groups(data, offsets, np.diff(first))
                    z = logits(m, codes, first).astype(np.float64) - np.array([m.threshold(g) for g in group])
                    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, len(p)).columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=schema.names)

    return kept.mapInArrow(K.tidy(run), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")
