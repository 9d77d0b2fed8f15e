import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from namebridge.llm import filter_audit as fa
from tests.llm.helpers import CASES, WORDS, clashing, table


def plain_mask(text):
    text = text or ""
    words = WORDS.findall(text)
    return ((len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words))
            + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text)) + 8 * any(c in "#$%&*|" for c in text))


def plain_rows(rows, labels):
    """The contract, document by document and order by order."""
    least = {}
    for d, text, *_ in rows:
        if d is not None:
            least[text or ""] = min(least.get(text or "", d), d)
    known = [(q, t) for d, q, t in labels]
    facts = []
    for d, text, _, source, _ in rows:
        mask = plain_mask(text) + 16 * (d is not None and d > least[text or ""])
        own = [k for k, (i, _, _) in zip(known, labels, strict=True) if d is not None and i == d]
        facts.append((source or "", mask, any(q == 1 for q, _ in own), any(t == 1 for _, t in own)))
    out = []
    for part in {f[0] for f in facts}:
        docs = [f[1:] for f in facts if f[0] == part]
        totals = Counter()
        cells = []
        for order in permutations(range(5)):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[0] >> f & 1]
                left = [x for x in left if not x[0] >> f & 1]
                totals[f] += len(gone)
                cells.append((part, "".join("ABCDE"[g] for g in order), step, len(left), len(gone),
                              sum(x[0] >> f & 1 for x in docs) - len(gone), sum(x[0] == 1 << f for x in docs),
                              sum(x[1] for x in gone), sum(x[2] for x in gone), f))
        out += [(*c[:-1], totals[c[-1]]) for c in cells]
    return sorted(out)


def test_ranks_follow_the_sorted_orders():
    for rank, order in enumerate(permutations(range(4))):
        assert fa.lehmer_rank(order, 4) == rank
        for k in range(4):
            first = next(i for i, o in enumerate(permutations(range(4))) if o[:k] == order[:k])
            assert fa.lehmer_rank(order[:k], 4) == first


def test_intervals_cover_the_orders_that_remove_the_mask():
    orders = list(permutations(range(4)))
    for mask in range(1, 16):
        for step in range(1, 5):
            ranks = {r for s, e in fa.removal_intervals(mask, step, 4) for r in range(s, e)}
            assert ranks == {r for r, o in enumerate(orders)
                             if mask >> o[step - 1] & 1 and not any(mask >> f & 1 for f in o[: step - 1])}


def test_removals_of_many_parts():
    counts = np.random.default_rng(1).integers(0, 9, (70, 8, 1))
    got = fa.removals(counts, 3)
    assert got.shape == (70, 6, 3, 1)
    assert (got.sum((2, 3)) == counts[:, 1:, 0].sum(1)[:, None]).all()


def test_audit_equals_walking_through_every_order(spark):
    pick = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "d#", "e", "ünï"]
    rows = [*CASES]
    for i in range(60):
        text = " ".join(pick.choice(words) if pick.random() < 0.5 else f"w{pick.randrange(999)}"
                        for _ in range(pick.choice([3, 150, 230])))
        rows += [(100 + i, text, "en", pick.choice(["s", "", None, "t"]), 1)] * pick.choice([1, 1, 2])
        if pick.random() < 0.4:
            rows.append((pick.randrange(90, 300), text, "en", pick.choice(["s", "t"]), 1))
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(90, 160)]
    labels += [(None, 1, 1), (101, 1, 0), (101, 0, 1), (9999, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = clashing(table(spark, rows)).repartition(3)
    got = sorted(map(tuple, fa.audit(fa.mask_counts(docs, marks)).collect()))
    assert got == plain_rows(rows, labels)


def test_other_filters_and_empty_tables(spark):
    counts = spark.createDataFrame([("p", 3, 5, 1, 0), ("p", 0, 2, 0, 0)], "part string, mask int, " + ", ".join(
        f"{c} long" for c in fa.COUNTS))
    got = {(r.filter_order, r.step): r for r in fa.audit(counts, "XY").collect()}
    assert (got["XY", 1].removed, got["XY", 2].redundant, got["YX", 1].shapley) == (5, 5, 5)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(fa.mask_counts(table(spark, []), labels)).collect() == []


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a b a b a"])
def test_masks_of_short_texts(text):
    data = np.frombuffer((text or "").encode(), np.uint8)
    assert fa.text_masks(data, np.array([0, len(data)]))[0] == plain_mask(text)
