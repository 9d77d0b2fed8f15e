import random

import numpy as np
import pytest

from namebridge.llm import quality_ranker as qr
from tests.llm.helpers import CASES, WORDS, clashing, table

LABELS = "doc_id long, quality int"


def sample(count=400):
    pick = random.Random(4)
    stems = ["river", "stone", "lamp", "garden", "yellow", "quiet", "letter", "winter", "paper", "travel"]
    rows, labels = [], []
    for i in range(count):
        words = [pick.choice(stems) + pick.choice(["", "s", "ing", "."]) for _ in range(pick.randint(20, 120))]
        good = pick.random() < 0.7
        if not good:
            words = pick.choice([[w.upper() + "!!" for w in words], words[:4] * 20, [w + "##" for w in words]])
        rows.append((i, " ".join(words), None, None, None))
        labels.append((i, int(good)))
    return rows, labels


def arrays(texts, bins=64):
    data = [(t or "").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    return qr.features(np.frombuffer(b"".join(data), np.uint8), offsets, bins)


def test_gradient_of_the_pair_loss():
    random = np.random.default_rng(0)
    better, worse, weights = random.normal(size=(9, 5)), random.normal(size=(9, 5)), random.normal(size=5)
    _, gradient = qr.pair_loss(weights, better, worse)
    for k in range(5):
        step = np.zeros(5)
        step[k] = 1e-5
        slope = (qr.pair_loss(weights + step, better, worse)[0] - qr.pair_loss(weights - step, better, worse)[0]) / 2e-5
        assert gradient[k] == pytest.approx(slope, abs=1e-6)


def test_features_equal_plain_counts():
    texts = ["The river, the river!\n\nthe river?\nA1 b## Über", "", " \n", None, "x", "one line\none line\none line"]
    dense, hashed = arrays(texts)
    for row, bins, text in zip(dense, hashed, texts, strict=True):
        text = text or ""
        words, size = WORDS.findall(text), max(1, len(text.encode()))
        low = [w.lower() if w.isascii() else w for w in words]
        grams = [tuple(low[k : k + 3]) for k in range(max(1, len(low) - 2))] if low else []
        lines = [x for x in text.split("\n") if x]
        assert row[0] == pytest.approx(sum("A" <= c <= "Z" for c in text) / size)
        assert row[2] == pytest.approx(sum(c.isdigit() for c in text) / size)
        assert row[6] == pytest.approx(np.log1p(len(words)))
        assert row[9] == pytest.approx(len(set(low)) / max(1, len(words)))
        assert row[10] == pytest.approx(len(set(grams)) / max(1, len(grams)))
        assert row[11] == pytest.approx(len(set(lines)) / max(1, len(lines)))
        assert row[14] == pytest.approx(sum(w[-1] in "!?#" for w in words) / max(1, len(words)))
        assert (bins > 0).any() == bool(words) and (bins**2).sum() == pytest.approx(2 if words else 0, abs=1e-5)


def test_features_do_not_depend_on_neighbours():
    texts = [r[1] for r in sample(30)[0]] + ["", "x"]
    dense, hashed = arrays(texts)
    model = qr.Model(dense.mean(0), dense.std(0) + 1e-3, np.linspace(-1, 1, dense.shape[1] + 64, dtype=np.float32))
    worth = model.worth(dense, hashed)
    assert [model.worth(*arrays([t]))[0] for t in texts] == worth.tolist()


def test_cut_is_a_quantile():
    worth, labels = np.array([5.0, 1, 2, 4, 3]), np.array([1, 0, 0, 1, 1])
    assert qr.quantile_cut(worth, labels, None) == (0.4, 2.5)
    assert qr.quantile_cut(worth, labels, 0.8) == (0.8, 4.5)
    assert qr.quantile_cut(np.array([2.0]), np.array([1]), None)[1] == 2.0


def test_quality_of_held_out_texts(spark):
    rows, labels = sample()
    marks = spark.createDataFrame([*labels, (None, 1), (1, None), (9999, 0)], LABELS)
    docs = table(spark, rows)
    model = qr.train(docs, marks)
    got = qr.score(docs, model).withColumn("held_out", qr.held_out(4, 2)).collect()
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    good = [r.score for r in held if truth[r.doc_id]]
    bad = [r.score for r in held if not truth[r.doc_id]]
    assert sum(g > b for g in good for b in bad) >= 0.99 * len(good) * len(bad)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    best = qr.top_share(qr.score(docs, model), 0.25).count()
    assert 100 <= best <= 104


def test_learning_ignores_held_out_labels_and_repeats(spark):
    rows, labels = sample(200)
    held = {r.doc_id for r in table(spark, rows).where(qr.held_out(4, 2)).select("doc_id").collect()}
    turned = [(i, 1 - q if i in held else q) for i, q in labels]
    docs = table(spark, rows)
    one = qr.train(docs, spark.createDataFrame(labels, LABELS))
    two = qr.train(docs.unionByName(docs).repartition(3), spark.createDataFrame(turned, LABELS))
    assert (one.weights == two.weights).all() and one.cut == two.cut


def test_edge_cases(spark):
    docs = clashing(table(spark))
    marks = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (7, 1), (8, 1), (9, 1)], LABELS)
    got = qr.score(docs, qr.train(docs, marks)).collect()
    assert len(got) == len(CASES) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    assert qr.train(docs, marks.where("quality = 1")) is None
    assert {(r.score, r.predicted) for r in qr.score(docs, None).collect()} == {(0.0, 0)}
    assert qr.score(table(spark, []), None).collect() == [] and qr.top_share(qr.score(table(spark, []), None), 0.5).isEmpty()
