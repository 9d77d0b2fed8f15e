import os

import pytest
from pyspark.sql import functions as F

from namebridge.llm import sentencepiece_codec as S
from namebridge.llm import sharding
from tests.llm.helpers import CASES, LONG, clashing, table

TEXTS = ["", " ", "  a  b ", "Hello, wörld! 日本語 🙂\n\tx", "x" * 3000, "<s> a </s> <0x41>", "a\x00b", LONG[:20000], " end "]
needs_model = pytest.mark.skipif(not os.path.exists(S.MODEL), reason="no model file")


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def test_unigram_model_with_byte_fallback():
    import struct

    def field(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + varint(3 << 3) + varint(kind))

    pieces = [("<unk>", 0, 2)] + [(f"<0x{b:02X}>", 0, 6) for b in range(256)] + [("▁ab", -1, 1), ("▁", -2, 1), ("a", -2, 1), ("b", -2, 1)]
    data = b"".join(piece(*p) for p in pieces)
    data += field(2, varint(3 << 3) + varint(1) + varint(35 << 3) + varint(1)) + field(3, varint(4 << 3) + varint(0))
    codec = S.Codec(data)
    ids, whole = codec.encode(["ab aé"])[0]
    names = [pieces[i][0] for i in ids]
    assert names == ["▁ab", "▁", "a", "<0xC3>", "<0xA9>"] and whole and codec.decode([ids]) == ["ab aé"]


@needs_model
def test_parity_with_the_reference_library():
    assert S.parity(TEXTS) == []
    codec = S.Codec(S.model_bytes())
    assert codec.cut
    assert [codec.decode([ids.tolist()])[0] for ids, _ in codec.encode(TEXTS)] == TEXTS


@needs_model
def test_memo_keeps_recent_parts(monkeypatch):
    """A full memo keeps what the last texts held; ids and round trips do not depend on its size."""
    monkeypatch.setattr(S, "MEMO", 4)
    codec, learnt = S.Codec(S.model_bytes()), []
    learn = codec._learn
    monkeypatch.setattr(codec, "_learn", lambda parts: (learnt.extend(parts), learn(parts)))
    texts = ["one two é\U0001F600", "one three", "one four five", "\U0001F600 <0x41> one", "two"]
    got = [(ids.tolist(), whole) for ids, whole in (codec.encode([t])[0] for t in texts)]
    assert learnt.count("▁one") == 1
    monkeypatch.undo()
    assert got == [(ids.tolist(), whole) for ids, whole in S.Codec(S.model_bytes()).encode(texts)]
    assert all(whole for _, whole in got) and [codec.decode([ids])[0] for ids, _ in got] == texts


@needs_model
def test_encode_and_decode_tables(spark):
    encoded = S.encode(clashing(table(spark)))
    rows = encoded.collect()
    assert len(rows) == len(CASES) and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)
    assert {r.n_tokens for r in rows if not r.text} == {0}
    assert all(r.decoded_text == (r.text or "") for r in S.decode(encoded).collect())
    assert S.encode(table(spark, [])).collect() == []


def test_shards(spark, tmp_path):
    rows = [*CASES, *[(100 + i, "text " * (i % 17), "en", "s", 1) for i in range(400)]]
    placed, layout = sharding.assign(clashing(table(spark, rows)), shards=4, slots=64)
    got = placed.collect()
    assert len(got) == len(rows) and len(layout.versions) == 2
    assert layout.versions[0] == tuple(s % 4 for s in range(64))
    for shard in range(4):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert all(layout.current[r.vslot] == r.shard for r in got)
    assert sharding.assign(table(spark, []))[0].collect() == []
    path = str(tmp_path / "out")
    written = sharding.write_shards(table(spark, rows), path, shards=4, slots=64)
    assert written.current == layout.current
    back = spark.read.parquet(f"{path}/data")
    assert back.count() == len(rows) and spark.read.parquet(f"{path}/map").count() == 128


def test_rebalancing_is_near_equal_and_moves_little():
    weights = {s: 1000 + s * 37 % 101 for s in range(400)}
    layout = sharding.first_map(8, 400).rebalanced(weights)
    sums = [sum(w for s, w in weights.items() if layout.current[s] == k) for k in range(8)]
    assert max(sums) - min(sums) <= 10
    assert sum(a != b for a, b in zip(*layout.versions, strict=True)) < 100


def test_a_row_repeated_very_often_is_spread(spark):
    rows = [(1, "the same text again", None, None, None)] * 3000 + [(i, "other " * 3, None, None, None) for i in range(2, 1002)]
    placed, _ = sharding.assign(table(spark, rows).repartition(3).withColumn("slot", F.lit("own")), shards=8)
    sums = [r.b for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sums) == 8 and max(sums) - min(sums) <= 20 and placed.count() == 4000
    slots = placed.groupBy("shard").agg(F.max("slot").alias("m"), F.countDistinct("slot").alias("n")).collect()
    assert all(r.m == r.n - 1 for r in slots)


def test_a_stored_map_is_edited(spark, tmp_path):
    rows = [(i, "x" * (i % 50), None, None, None) for i in range(500)]
    docs = table(spark, rows)
    first = sharding.write_shards(docs, str(tmp_path / "a"), shards=4, slots=64)
    assert sharding.load_map(spark, str(tmp_path / "a")) == first
    grown = docs.unionByName(table(spark, [(1000, "y" * 5000, None, None, None)])).withColumn(
        "vslot", sharding.record_slot(["doc_id", "text"], 64)).withColumn("size", F.octet_length("text") + 1)
    edited = sharding.rebalance(grown, str(tmp_path / "a"), str(tmp_path / "b"))
    assert edited.versions[:-1] == first.versions and sharding.load_map(spark, str(tmp_path / "b")) == edited
    held = sharding.slot_bytes(grown)
    sums = [sum(b for s, b in held.items() if edited.current[s] == k) for k in range(4)]
    assert max(sums) - min(sums) < 1000
