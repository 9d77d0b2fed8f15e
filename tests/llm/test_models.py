import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from namebridge.llm import language_id, lm_scoring, toxicity
from tests.llm.helpers import CASES, LOWER, WORDS, clashing, table

PARTS = {"aa": ["der", "ung", "sch", "eit"], "bb": ["que", "oir", "eau", "ment"], "cc": ["the", "ing", "ou", "ly"]}


def sample(count=120):
    pick = random.Random(1)
    rows = []
    for i in range(count):
        lang = pick.choice(list(PARTS))
        words = ["".join(pick.choice(PARTS[lang]) for _ in range(pick.randint(1, 3))) for _ in range(pick.randint(4, 40))]
        toxic = int(pick.random() < 0.4)
        if toxic:
            for _ in range(3):
                words.insert(pick.randrange(len(words)), pick.choice(["vileword", "badword"]))
        rows.append((i, " ".join(words), lang, "s", toxic))
    return rows


def test_gradients_of_the_recurrent_network():
    net = language_id.Network(["a", "b", "c"], 4, 1)
    runs = [b"abc", b"de", b"fghij"]
    data, ends = np.frombuffer(b"".join(runs), np.uint8), np.cumsum([3, 2, 5])
    starts, labels = ends - [3, 2, 5], np.array([0, 1, 2])
    ahead, back, size = language_id.padded(data, starts, ends)

    def loss():
        p, (row, *_) = net.positions(ahead, back, size)
        return -np.log(p[np.arange(len(row)), labels[row]]).mean()

    p, (row, t, both, fs, bs) = net.positions(ahead, back, size, keep=True)
    p[np.arange(len(row)), labels[row]] -= 1
    d = p / len(row) @ net.out.T
    gf = np.zeros((5, 3, 4), np.float32)
    gb = np.zeros_like(gf)
    gf[t, row], gb[size[row] - 1 - t, row] = d[:, :4], d[:, 4:]
    grads = [*net.ahead.backward(ahead, fs, gf), *net.back.backward(back, bs, gb)]
    for value, grad in zip(net.parameters(), grads, strict=False):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old = value[at]
        value[at] = old + 1e-2
        up = loss()
        value[at] = old - 1e-2
        down = loss()
        value[at] = old
        assert (up - down) / 2e-2 == pytest.approx(grad[at], abs=2e-3)


def test_language_of_held_out_texts(spark):
    docs = table(spark, [(*r[:4], 0) for r in sample()])
    net = language_id.train(docs, language_id.LanguageConfig(epochs=4))
    got = language_id.predict(docs, net).withColumn("held_out", language_id.held_out(4, 2)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert held and all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in held)


def test_language_edge_cases(spark):
    docs = clashing(table(spark, [*CASES, (20, "12 34 !!", "en", "s", 1), (21, "🙂", "en", "s", 1)]))
    net = language_id.train(docs, language_id.LanguageConfig(epochs=1))
    got = {(r.doc_id, r.text): r for r in language_id.predict(docs, net).collect()}
    for key in ((3, None), (4, ""), (5, " \t\n "), (20, "12 34 !!"), (21, "🙂")):
        assert (got[key].lang_pred, got[key].score) == ("und", 0.0)
    assert got[6, CASES[8][1]].lang_pred in ("de", "en")
    assert language_id.predict(docs, None).where("lang_pred <> 'und'").count() == 0
    assert language_id.train(table(spark, [])) is None and language_id.predict(table(spark, []), net).collect() == []


def test_toxicity_of_held_out_texts(spark):
    rows = sample(400)
    docs = table(spark, [(*r[:4], 0) for r in rows])
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows] + [(None, 1), (1, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    truth = {r[0]: r[4] for r in rows}
    got = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out(5, 0)).collect()
    held = [r for r in got if r.held_out]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right >= 0.95 * len(held) and all(r.predicted == int(r.score >= 0.5) for r in got)


def test_toxicity_edge_cases(spark):
    docs = clashing(table(spark))
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (7, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == len(CASES) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.text or "").strip()}) == 1
    none = toxicity.train(docs, labels.where("toxic = 0"))
    assert {(r.score, r.predicted) for r in toxicity.score(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.score(table(spark, []), none).collect() == []


def plain_counts(rows):
    tokens = [[*WORDS.findall((t or "").translate(LOWER)), "<end>"] for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return [(d, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
            for (d, _), t, h in zip(rows, tokens, held, strict=True)]


@pytest.mark.parametrize("chunk", [12_000_000, 2_000])
def test_base_scores_equal_plain_counts(spark, chunk):
    rows = [(r[0], r[1]) for r in sample()] + [(c[0], c[1]) for c in CASES]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(map(tuple, lm_scoring.score(df, lm_scoring.LanguageModelConfig(chunk_bytes=chunk)).collect()), key=str)
    for a, b in zip(got, sorted(plain_counts(rows), key=str), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] < 0


def endings(count):
    """Most words are rare and their endings tell what follows."""
    pick = random.Random(2)
    for i in range(count):
        parts = PARTS[pick.choice(list(PARTS))]
        yield i, " ".join("".join(pick.choice(parts) for _ in range(pick.randint(2, 5))) for _ in range(30))


@pytest.mark.parametrize("tasks", [1, 32])
def test_model_beats_the_base_whatever_the_number_of_tasks(spark, tasks):
    df = spark.createDataFrame(list(endings(2000)), "doc_id long, text string").repartition(tasks, "doc_id")
    held = [r for r in lm_scoring.score(df).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_grows_with_the_input():
    config = lm_scoring.LanguageModelConfig()
    small, large = lm_scoring.sizes(10**8, config), lm_scoring.sizes(3 * 10**10, config)
    assert (small.side, small.bits) == (16, 14) and large.side == 33 and large.top > 4 * small.top and large.bits == 17


def test_class_and_bin_probabilities_sum_to_one():
    size = lm_scoring.Sizes(5, 6)
    w = lm_scoring.Weights(size)
    pick = np.random.default_rng(0)
    for t in w.tables:
        t[:] = pick.normal(size=t.shape)
    features = pick.integers(0, 1 << 63, (lm_scoring.KINDS, 1)).astype(np.uint64)
    total = sum(10 ** w.log10(features, np.array([b]))[0] for b in range(size.bins))
    assert total == pytest.approx(1, abs=1e-5)


def test_weights_without_steps_are_the_counted_bins():
    size = lm_scoring.Sizes(4, 6)
    counts = np.arange(16) * 1000
    w = lm_scoring.Weights(size, counts)
    got = w.log10(np.zeros((lm_scoring.KINDS, 16), np.uint64), np.arange(16))
    assert got[1:] == pytest.approx(np.log10(counts[1:] / counts.sum()), abs=1e-3)


def test_gradients_of_the_language_model():
    size = lm_scoring.Sizes(3, 6)
    w = lm_scoring.Weights(size)
    pick = np.random.default_rng(1)
    for t in w.tables:
        t[:] = pick.normal(size=t.shape)
    features = pick.integers(0, 1 << 63, (lm_scoring.KINDS, 5)).astype(np.uint64)
    bins = np.array([0, 4, 8, 4, 2])
    before, old = -w.log10(features, bins).mean(), w.copy()
    squares = [np.zeros(len(t), np.float32) for t in w.tables]
    w.step(features, bins, 1e-3, squares, [np.zeros(len(t), np.float32) for t in w.tables])
    assert -w.log10(features, bins).mean() < before
    for k, row in ((0, w.rows(features, bins // 3)[0][0, 0]), (1, w.rows(features, bins // 3)[1][0, 0])):
        grad = (old.tables[k][row] - w.tables[k][row]) / 1e-3 * np.sqrt(squares[k][row] + 1)
        near = old.copy()
        at = np.abs(grad).argmax()
        near.tables[k][row, at] += 1e-2
        up = -near.log10(features, bins).sum() * math.log(10)
        near.tables[k][row, at] -= 2e-2
        assert (up + near.log10(features, bins).sum() * math.log(10)) / 2e-2 == pytest.approx(grad[at], abs=2e-2)


def test_language_model_of_an_empty_table(spark):
    assert lm_scoring.score(table(spark, [])).collect() == []


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word that only some rows of one class hold is learned, and gets its weight, however many rows there are."""
    docs = spark.createDataFrame([(i, f"plain text {'vileword' if i % 4 == 0 else 'word'} w{i}") for i in range(400)],
                                 "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 4 = 0 as int) as toxic")
    rows = toxicity.training_rows(docs, labels)
    assert rows.count() == labels.where(~toxicity.held_out(5, 0)).count()
    config = toxicity.ToxicityConfig(rows_per_task=30)
    model = toxicity.train(docs, labels, config)
    got = toxicity.score(docs, model).collect()
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in got) >= 0.95 * len(got)
    again = toxicity.train(docs.repartition(3), labels, config)
    assert all(np.array_equal(a, b) for a, b in zip(model.tables, again.tables, strict=True))
    assert again.thresholds == pytest.approx(model.thresholds, abs=0.01)


def test_toxicity_leaves_no_model_of_its_epochs_on_the_driver(spark, monkeypatch):
    """All models that training sends out are dropped again, on the driver too."""
    context, sent = spark.sparkContext, []
    monkeypatch.setattr(context, "broadcast", lambda value, send=context.broadcast: sent.append(send(value)) or sent[-1])
    docs = spark.createDataFrame([(i, f"plain {'vileword' if i % 4 == 0 else 'word'} w{i}") for i in range(200)],
                                 "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 4 = 0 as int) as toxic")
    toxicity.train(docs, labels, toxicity.ToxicityConfig(rows_per_task=60, epochs=2))
    assert len(sent) == 3 and not any(os.path.exists(b._path) for b in sent)
