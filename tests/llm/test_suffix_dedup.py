import hashlib
import random

import numpy as np
import pytest

from namebridge.llm import suffix_dedup as S
from tests.llm.helpers import CASES, clashing, table, uncovered


@pytest.mark.parametrize("seed", range(6))
def test_two_stage_order(seed):
    pick = random.Random(seed)
    for _ in range(30):
        letters = pick.choice(["a", "ab", "abc", "abcdefghij"])
        text = "".join(pick.choice(letters) for _ in range(pick.randint(1, 300))).encode()
        wanted = np.array([pick.random() < pick.choice([0.3, 1]) for _ in text])
        order = S.two_stage_order(np.frombuffer(text, np.uint8), wanted, 128)
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        keys = [text[p : p + 128] for p in order]
        assert keys == sorted(keys)


def corpus():
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcdeé") for _ in range(pick.randint(1, 9)))
    passage = [" ".join(word() for _ in range(60)) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = [" ".join(word() for _ in range(pick.randint(0, 60))) for _ in range(3)]
        at = pick.randint(0, 20)
        parts.insert(1, pick.choice(passage)[at : pick.randint(at + 150, at + 330)])
        texts.append(" ".join(parts))
    return [*texts, texts[0], texts[0], "!" * 450, "ab" * 300, "xyz" * 66, None, "", "short"]


def expected(ids, texts):
    rows = []
    for i, text, keep in zip(ids, texts, uncovered(texts), strict=True):
        data = (text or "").encode()
        spans = sum(not k and (p == 0 or keep[p - 1]) for p, k in enumerate(keep))
        rest = bytes(b for b, k in zip(data, keep, strict=True) if k)
        rows.append((i, len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(rows, key=str)


@pytest.mark.parametrize("config", [S.DedupConfig(), S.DedupConfig(hot=2, task_bytes=5000, piece=700)])
def test_equals_brute_force(spark, config):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, S.dedup(df, config, keep_text=False).collect()), key=str)
    assert got == expected(range(len(texts)), texts)


def test_edge_cases_and_kept_bytes(spark):
    rows = [c for c in CASES if c[0] not in (7, 8)]
    got = S.dedup(clashing(table(spark, rows))).collect()
    assert {r.h for r in got} == {"own"} and len(got) == len(rows)
    assert all(r.n_removed == 0 and (r.kept or b"") == (r.text or "").encode() for r in got)


def test_whole_characters(spark):
    text = "é" * 150 + "z"
    rows = [(1, text), (2, "é" * 149 + "y")]
    got = S.dedup(spark.createDataFrame(rows, "doc_id long, text string"), whole_characters=True).collect()
    assert sorted(r.text for r in got) == ["y", "z"]


def test_empty_table(spark):
    assert S.dedup(table(spark, [])).collect() == []


def test_repeated_rows_share_one_list_of_spans(spark):
    text = " ".join(f"w{i * 7919 % 10007}" for i in range(300))
    one = suffix_spans(spark, [(1, text)] * 2)
    many = suffix_spans(spark, [(1, text)] * 300)
    assert many == one and len(many) == 1


def suffix_spans(spark, rows):
    from namebridge.llm import suffix_dedup

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return [sorted(map(tuple, r.spans)) for r in suffix_dedup.repeated(df).collect()]
