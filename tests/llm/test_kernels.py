import weakref

import numpy as np
import pyarrow as pa
import pytest

from namebridge.llm import kernels as K
from tests.llm.helpers import LOWER, WORDS

TEXTS = ["a bb  a\tccc", None, "", " ", "x", "A bb", "é ü\x0bz"]


def test_words_stay_within_texts_and_equal_words_hash_alike():
    seen = {}
    for _, data, offsets in K.text_chunks(pa.array(TEXTS)):
        starts, ends, first = K.words(data, offsets)
        hashes = K.span_hashes(K.LOWER[data], starts, ends)
        for i, text in enumerate(TEXTS):
            words = WORDS.findall((text or "").translate(LOWER))
            assert len(words) == first[i + 1] - first[i]
            for w, h in zip(words, hashes[first[i] : first[i + 1]], strict=True):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("limit", [1, 5, 1000])
def test_chunks_hold_every_row_once(limit):
    rows = []
    for first, data, offsets in K.text_chunks(pa.array(TEXTS).slice(1), limit):
        assert first == len(rows)
        rows += [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert rows == [t or "" for t in TEXTS[1:]]


def test_long_spans_hash_by_content(monkeypatch):
    data = np.frombuffer(b"q" * 5000 + b" " + b"q" * 5000 + b" " + b"q" * 4999 + b"r", np.uint8)
    offsets = np.array([0, len(data)])
    starts, ends, _ = K.words(data, offsets)
    whole = K.span_hashes(data, starts, ends)
    assert whole[0] == whole[1] != whole[2]
    monkeypatch.setattr(K, "_PIECE", 1000)
    cut = K.span_hashes(data, starts, ends)
    assert cut[0] == cut[1] != cut[2]


def test_short_texts_have_one_shingle():
    for text, count in (("", 0), ("a", 1), ("a b c d", 1), ("a b c d e", 1), ("a b c d e f", 2)):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, first = K.words(data, np.array([0, len(data)]))
        values, begin = K.shingles(K.span_hashes(data, starts, ends), first)
        assert len(values) == count == begin[-1]


def test_views_share_the_memory_of_their_column():
    column = pa.array([np.arange(k, dtype=np.uint64).tobytes() for k in range(5)], pa.binary())
    whole = np.frombuffer(column.buffers()[2], np.uint8)
    views = K.binary_views(column.slice(2), np.uint64)
    assert [v.tolist() for v in views] == [list(range(k)) for k in range(2, 5)]
    assert all(np.shares_memory(v, whole) for v in views)
    assert K.binary_views(column[:0], np.uint64) == []


def test_a_group_is_given_up_before_memory_is_released(monkeypatch):
    frames, gone = [], []
    monkeypatch.setattr(K, "release", lambda: gone.append(frames[-1]() is None))

    def run(rows):
        frames.append(weakref.ref(rows))
        return rows.assign(x=rows["x"] + 1)

    schema = pa.schema([("x", pa.int32())])
    group = K.tidy_groups(run, schema)
    for _ in range(2):
        out = pa.Table.from_batches(group(iter([pa.record_batch({"x": [1, 2]}), pa.record_batch({"x": [3]})])), schema)
        assert out["x"].to_pylist() == [2, 3, 4]
    assert gone == [True, True]
