"""Operator 1: language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a run of letters in both directions, trained in numpy by backpropagation
through time, and gives every position a distribution over the languages; a document's probabilities are the
mean over all its positions. Runs end at white space, digits and ASCII punctuation, and after 32 bytes; the state
starts anew in each. So a run's labels depend on its bytes alone, and each distinct run of a chunk is
computed once: whole texts are labelled, at the cost of their vocabulary.

A null text, or one without a letter, is ``und`` with score 0. Training rows need a text and a language;
without any, every text is ``und``. Equal texts get equal results; nulls in other columns and further columns do
not matter; an empty table gives an empty result. Ties go to the first language in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from namebridge.llm import kernels as K
from namebridge.llm.stages import documents, held_out, small_batches

RUN = 32
UNKNOWN = "und"
#: Distinct runs that a worker remembers before it starts anew: a memory bound without effect on results.
MEMO = 250_000

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True


@dataclass(frozen=True)
class LanguageConfig:
    #: Bound on the training sample: documents per language, and runs drawn from them per language.
    documents_per_language: int = 200
    runs_per_language: int = 8000
    hidden: int = 16
    epochs: int = 6
    batch: int = 128
    rate: float = 0.01
    seed: int = 5


def lower_case(data: np.ndarray) -> np.ndarray:
    """Lower-case forms of A-Z and of the letters U+00C0 to U+00DE."""
    data = K.LOWER[data]
    at = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.zeros(0, np.int64)
    at = at[(data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97)]
    data[at] += 0x20
    return data


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters in lower-case bytes, none longer than RUN."""
    starts, ends = K.spans(_LETTER[data], offsets)
    size = ends - starts
    if len(size) and size.max() > RUN:
        pieces = -(-size // RUN)
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + k * RUN
        ends = np.minimum(starts + RUN, np.repeat(ends, pieces))
    return starts, ends


def padded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs as rows of bytes, forwards and backwards, and their sizes."""
    size = ends - starts
    t = np.arange(int(size.max()) if len(size) else 0)
    inside = t < size[:, None]
    if not len(data):
        return np.zeros((0, 0), np.uint8), np.zeros((0, 0), np.uint8), size
    ahead = np.where(inside, data[np.minimum(starts[:, None] + t, len(data) - 1)], 0)
    back = np.where(inside, data[np.maximum(ends[:, None] - 1 - t, 0)], 0)
    return ahead, back, size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -15, 15)))


class Direction:
    """One gated recurrent layer. Gates: update, reset, candidate."""

    def __init__(self, hidden: int, random: np.random.Generator) -> None:
        self.h = hidden
        self.x = random.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.w = random.normal(0, 1 / np.sqrt(hidden), (hidden, 2 * hidden)).astype(np.float32)
        self.u = random.normal(0, 1 / np.sqrt(hidden), (hidden, hidden)).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.x, self.w, self.u]

    def forward(self, bytes_: np.ndarray, keep: bool = False):
        """States after each byte; with ``keep`` also what the backward pass needs."""
        n, steps = bytes_.shape
        h, h2 = self.h, 2 * self.h
        state = np.zeros((n, h), np.float32)
        out = np.empty((steps, n, h), np.float32)
        saved = []
        for t in range(steps):
            x = self.x[bytes_[:, t]]
            gates = _sigmoid(x[:, :h2] + state @ self.w)
            z, r = gates[:, :h], gates[:, h:]
            candidate = np.tanh(x[:, h2:] + (r * state) @ self.u)
            if keep:
                saved.append((state, z, r, candidate))
            state = state + z * (candidate - state)
            out[t] = state
        return out, saved

    def backward(self, bytes_: np.ndarray, saved: list, gradient: np.ndarray) -> list[np.ndarray]:
        """Gradients through time of the parameters, from those of the states."""
        h = self.h
        gx, gw, gu = np.zeros_like(self.x), np.zeros_like(self.w), np.zeros_like(self.u)
        carry = np.zeros_like(gradient[0])
        for t in range(len(saved) - 1, -1, -1):
            state, z, r, candidate = saved[t]
            g = gradient[t] + carry
            dc = g * z * (1 - candidate**2)
            dz = g * (candidate - state) * z * (1 - z)
            rs = dc @ self.u.T
            dr = rs * state * r * (1 - r)
            gates = np.concatenate([dz, dr], 1)
            carry = g * (1 - z) + rs * r + gates @ self.w.T
            gu += (r * state).T @ dc
            gw += state.T @ gates
            np.add.at(gx, bytes_[:, t], np.concatenate([gates, dc], 1))
        return [gx, gw, gu]


class Network:
    def __init__(self, languages: list[str], hidden: int, seed: int) -> None:
        random = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Direction(hidden, random), Direction(hidden, random)
        self.out = random.normal(0, 0.2, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.ahead.parameters(), *self.back.parameters(), self.out, self.bias]

    def positions(self, ahead: np.ndarray, back: np.ndarray, size: np.ndarray, keep: bool = False):
        """Distributions at every position (rows of all runs, one after the other)."""
        f, fs = self.ahead.forward(ahead, keep)
        b, bs = self.back.forward(back, keep)
        row = np.repeat(np.arange(len(size)), size)
        t = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        both = np.concatenate([f[t, row], b[size[row] - 1 - t, row]], 1)
        x = both @ self.out + self.bias
        x -= x.max(1, keepdims=True)
        p = np.exp(x)
        p /= p.sum(1, keepdims=True)
        return p, (row, t, both, fs, bs)

    def run_sums(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Per run, the sum over its positions of their distributions."""
        out = np.zeros((len(starts), len(self.languages)), np.float32)
        order = np.argsort(ends - starts, kind="stable")
        for begin in range(0, len(order), 4096):  # of like size, so little padding
            rows = order[begin : begin + 4096]
            ahead, back, size = padded(data, starts[rows], ends[rows])
            p, _ = self.positions(ahead, back, size)
            out[rows] = np.add.reduceat(p, np.cumsum(size) - size, axis=0)
        return out

    def train(self, runs: list[bytes], labels: np.ndarray, config: LanguageConfig) -> None:
        random = np.random.default_rng(config.seed)
        data = np.frombuffer(b"".join(runs), np.uint8)
        size_ = np.array([len(r) for r in runs])
        ends = np.cumsum(size_)
        starts = ends - size_
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        step = 0
        for epoch in range(config.epochs):
            rate = config.rate / (1 + epoch)
            order = np.argsort(size_ + random.random(len(size_)) * 2, kind="stable")
            batches = np.array_split(order, max(1, len(order) // config.batch))
            for k in random.permutation(len(batches)):
                rows = batches[k]
                ahead, back, size = padded(data, starts[rows], ends[rows])
                p, (row, t, both, fs, bs) = self.positions(ahead, back, size, keep=True)
                p[np.arange(len(row)), labels[rows][row]] -= 1
                p /= len(row)
                d = p @ self.out.T
                h = self.ahead.h
                gf = np.zeros((ahead.shape[1], len(rows), h), np.float32)
                gb = np.zeros_like(gf)
                gf[t, row] = d[:, :h]
                gb[size[row] - 1 - t, row] = d[:, h:]
                grads = [*self.ahead.backward(ahead, fs, gf), *self.back.backward(back, bs, gb), both.T @ p, p.sum(0)]
                step += 1
                for value, g, (m, v) in zip(self.parameters(), grads, moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)


def training_runs(docs: DataFrame, config: LanguageConfig) -> dict[str, list[bytes]]:
    """Runs of a bounded sample per language, drawn over whole documents; the same at every call."""
    spark = docs.sparkSession
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(~held_out(4, 2))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = rows.select("doc_id", "lang").withColumn("_r", F.row_number().over(by_hash)) \
        .where(F.col("_r") <= config.documents_per_language).select("doc_id", "lang")
    ids = spark.createDataFrame(ids.collect(), "doc_id long, lang string")  # bounded per language
    per_document = max(1, config.runs_per_language // max(1, config.documents_per_language) * 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in K.text_chunks(batch.column("text")):
                data = lower_case(data)
                starts, ends = letter_runs(data, offsets)
                first = np.searchsorted(starts, offsets)
                part = batch.slice(at, len(offsets) - 1)
                out = []
                for a, b, key in zip(first[:-1], first[1:], part.column("doc_id").to_pylist(), strict=True):
                    pick = np.arange(a, b)
                    if len(pick) > per_document:
                        pick = np.sort(np.random.default_rng(key & 0x7FFFFFFF).choice(pick, per_document, replace=False))
                    out.append([data[starts[i] : ends[i]].tobytes() for i in pick])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("lang"), pa.array(out, pa.list_(pa.binary()))],
                    names=["doc_id", "lang", "runs"])

    got = rows.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id").select("doc_id", "lang", "text") \
        .mapInArrow(run, "doc_id long, lang string, runs array<binary>").collect()
    out: dict[str, list[bytes]] = {}
    for r in sorted(got, key=lambda r: (r.lang, r.doc_id, r.runs)):
        out.setdefault(r.lang, []).extend(bytes(x) for x in r.runs)
    return {lang: runs[: config.runs_per_language] for lang, runs in sorted(out.items()) if runs}


def train(docs: DataFrame, config: LanguageConfig | None = None) -> Network | None:
    """The network, or None without training rows."""
    config = config or LanguageConfig()
    small_batches(docs.sparkSession)
    runs = training_runs(docs, config)
    if not runs:
        return None
    network = Network(list(runs), config.hidden, config.seed)
    labels = np.repeat(np.arange(len(runs)), [len(r) for r in runs.values()])
    network.train([x for r in runs.values() for x in r], labels, config)
    return network


class _Memo:
    """Sums of the runs seen by a worker, by hash."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.sums = np.zeros((0, len(self.network.languages)), np.float32)

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Sums of the distinct runs with the (sorted) hashes."""
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = self.known[at] != hashes if len(self.known) else np.ones(len(hashes), bool)
        out = np.empty((len(hashes), self.sums.shape[1]), np.float32)
        out[~new] = self.sums[at[~new]]
        if new.any():
            out[new] = self.network.run_sums(data, starts[new], ends[new])
            if len(self.known) + new.sum() > MEMO:
                self._clear()
            place = np.searchsorted(self.known, hashes[new])
            self.known = np.insert(self.known, place, hashes[new])
            self.sums = np.insert(self.sums, place, out[new], axis=0)
        return out


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    plain = np.concatenate([[0], np.cumsum((data >= 0x61) & (data < 0x7B))])
    wide = np.concatenate([[0], np.cumsum(data >= 0x80)])
    found = plain[offsets[1:]] > plain[offsets[:-1]]
    for i in np.flatnonzero(~found & (wide[offsets[1:]] > wide[offsets[:-1]])):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(c.isalpha() for c in text)
    return found


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """docs with lang_pred and score (the pooled probability)."""
    small_batches(docs.sparkSession)
    kept = docs.drop("lang_pred", "score")
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Memo(shared.value) if shared.value else None
        for batch in batches:
            for at, data, offsets in K.text_chunks(batch.column("text"), 1 << 21):
                n = len(offsets) - 1
                names, scores = [UNKNOWN] * n, np.zeros(n)
                data = lower_case(data)
                starts, ends = letter_runs(data, offsets)
                if memo and len(starts):
                    hashes, index, place = np.unique(
                        K.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
                    sums = memo.lookup(data, starts[index], ends[index], hashes)
                    first = np.searchsorted(starts, offsets)
                    full = np.diff(first) > 0
                    begin = first[:-1][full]
                    pooled = np.add.reduceat(sums[place], begin, axis=0)
                    pooled /= np.add.reduceat(ends - starts, begin)[:, None]
                    best = pooled.argmax(1)
                    letter = _has_letter(data, offsets)
                    for i, k, p in zip(np.flatnonzero(full), best, pooled.max(1), strict=True):
                        if letter[i]:
                            names[i], scores[i] = memo.network.languages[k], min(1.0, float(p))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, n).columns, pa.array(names, pa.string()), pa.array(scores)], names=schema.names)

    return kept.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    network = train(docs.select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), network).select(
        "doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
