import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from namebridge.llm import jaccard_join as J
from tests.llm.helpers import CASES, clashing, groups, table


def varied(seed):
    pick = random.Random(seed)
    base = [[f"w{pick.randint(0, 40)}" for _ in range(pick.randint(1, 30))] for _ in range(30)]
    texts = []
    for _ in range(250):
        words = list(pick.choice(base))
        for _ in range(pick.choice([0, 0, 1, 1, 2])):
            kind = pick.random()
            if kind < 0.4 and words:
                words[pick.randrange(len(words))] = f"x{pick.randint(0, 9)}"
            elif kind < 0.7:
                words.append(f"y{pick.randint(0, 9)}")
            elif words:
                words.pop()
        texts.append(" ".join(words))
    return texts


def expected(ids, texts):
    roots, sets = groups(texts)
    least = {}
    for i, r in enumerate(roots):
        if ids[i] is not None:
            least[r] = min(least.get(r, ids[i]), ids[i])
    return sorted(((ids[i], len(sets[i]), least.get(r)) for i, r in enumerate(roots)), key=str)


@pytest.mark.parametrize("config", [
    J.JoinConfig(), J.JoinConfig(region_cells=60, flush=60, leaf=2, pivots=2, frequent_share=0.2)])
def test_join_equals_brute_force(spark, config):
    texts = varied(3)
    ids = list(range(len(texts)))
    got = J.link(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3), config)
    assert sorted(map(tuple, got.collect()), key=str) == expected(ids, texts)


def test_edge_cases(spark):
    ids, texts = [c[0] for c in CASES], [c[1] for c in CASES]
    got = sorted(map(tuple, J.link(clashing(table(spark))).collect()), key=str)
    assert got == expected(ids, texts)


def test_one_row_of_each_group_stays(spark):
    kept = J.keep_one(clashing(table(spark)))
    assert "k1" in kept.columns and set(kept.select("k1").distinct().toPandas()["k1"]) == {"own"}
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 3, 4, 5, 6, 7, None, None], key=str)


def test_empty_table(spark):
    assert J.link(table(spark, [])).collect() == [] and J.keep_one(table(spark, [])).collect() == []


def test_prefix_and_half_bounds():
    for n in range(1, 60):
        for m in range(1, n + 1):
            for common in range(1, m + 1):
                if 100 * common >= 75 * (n + m - common):
                    for x in (n, m):
                        assert x - common < J.prefix_length(x)
                    shared = common - max(n // 2 if J.prefix_length(n) <= -(-n // 2) else n - J.prefix_length(n),
                                          m // 2 if J.prefix_length(m) <= -(-m // 2) else m - J.prefix_length(m))
                    assert shared >= max(J.least_shared(n), J.least_shared(m))


def test_the_row_that_stays_does_not_depend_on_partitions(spark):
    text = "one two three four five six seven"
    rows = [(1, text, lang, src, n) for lang in ("a", "b") for src in (None, "s") for n in (1, 2)]
    rows += [(2, text + " ", "a", "s", 0), (3, text.upper(), "a", "s", 0)]
    kept = {tuple(map(tuple, J.keep_one(table(spark, rows).repartition(n, "n_chars")).collect())) for n in (1, 2, 3, 5)}
    assert len(kept) == 1 and len(next(iter(kept))) == 1 and next(iter(kept))[0][0] == 1


def test_a_task_holds_the_sets_of_its_regions_once(monkeypatch):
    released = []
    monkeypatch.setattr(J.K, "release", lambda: released.append(True))
    half, n = 200, 2000
    sets = [np.arange(i // 2 * half, (i // 2 + 1) * half + i % 2, dtype=np.uint64).tobytes() for i in range(n)]
    batches = [pa.record_batch({
        "region": pa.array([i // 2 for i in part]), "cell": [""] * len(part), "k1": pa.array(part), "k2": pa.array(part),
        "active": [True] * len(part), "shingles": pa.array([sets[i] for i in part], pa.binary())})
        for part in np.array_split(np.arange(n).tolist(), 4)]
    total = sum(map(len, sets))
    del sets
    tracemalloc.start()
    try:
        got = pa.Table.from_batches(J._region_links(J.JoinConfig())(iter(batches))).to_pydict()
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert sorted(sorted(p) for p in zip(got["a1"], got["b1"], strict=True)) == [[i, i + 1] for i in range(0, n, 2)]
    assert most < total, (most, total)  # before: each set once more, as an object
    assert released


def test_a_document_is_only_in_regions_of_its_own_shingles(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    texts = [one, "other words that nobody else has", f"{one} {two}", two]  # two tasks: the third is the pivot of the fourth there
    rows = spark.createDataFrame(spark.sparkContext.parallelize([(t,) for t in texts], 2), "text string")
    late = spark.sparkContext.broadcast(np.zeros(0, np.uint64))
    found = {}
    for r in J._members(rows, late, 500, J.JoinConfig()).collect():
        found.setdefault(r.k1, set()).add(r.region)

    def regions(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return found[int(J._keys(J._sets(data, np.array([0, len(data)]), 5))[1][0])]

    assert regions(texts[2]) & regions(one) and regions(texts[2]) & regions(two)
    assert not regions(one) & regions(two)  # before: all regions of the third were taken over by the fourth
