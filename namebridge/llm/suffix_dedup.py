"""Operator 7: repeated byte strings found by two-stage suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts elsewhere (in any text, its own included)
is removed. Steps:

1. A string of ``length`` bytes is keyed by the smallest hash of its 32-byte grams, which depends on the
   string alone. Neighbouring strings of one key form a stretch. Stretches whose key occurs once repeat
   nowhere; stretches whose whole content occurs twice are repeated throughout. This is exact (up to
   128-bit hashes) and leaves only the edges of repeated passages, one copy of each.
2. These stretches are dealt by key and suffix-sorted: suffixes smaller than their successors are sorted
   directly, all others are induced from them by scanning the buckets of first bytes, and common prefixes of
   neighbours in the order say which strings repeat. A key with more stretches than ``hot`` is dealt by
   the strings themselves instead, so no task receives an unbounded key; that path is exact as well.
3. Stretches and repeated strings become byte spans of each text.

Null and empty texts have no bytes; texts shorter than ``length`` lose nothing. Equal texts and repeated rows
are all removed alike (each copy starts elsewhere). Nulls in other columns do not matter, an empty table gives an
empty result, further columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namebridge.llm import kernels as K
from namebridge.llm.stages import documents, small_batches, written

U64 = np.uint64
GRAM = 32
_A = U64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class DedupConfig:
    #: Bytes of a repeated string; 128 to 208.
    length: int = 200
    #: Bytes of stretches in one sorting task.
    task_bytes: int = 1_000_000
    #: Stretches of one key above which the key is split by content.
    hot: int = 4_000
    #: Longer texts are keyed in pieces of so many bytes, which bounds memory.
    piece: int = 1 << 21

    def __post_init__(self) -> None:
        if not 128 <= self.length <= 208:
            raise ValueError("length must be 128 to 208")


def _double(x: np.ndarray, step: int) -> np.ndarray:
    """Hashes of twice the width from those of ``step`` bytes; the last ``step`` entries are without use."""
    out = x * _A
    out[:-step] += x[step:]
    out ^= out >> U64(29)
    return out


def gram_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 32-byte and the 128-byte grams from each byte on."""
    h = K.BYTE_CODES[data]
    for step in (1, 2, 4, 8, 16):
        h = _double(h, step) if len(h) > step else h
    wide = h
    for step in (32, 64):
        wide = _double(wide, step) if len(wide) > step else wide
    return K.mix(h), wide


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` entries; one value per run."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, start, bytes, key, content hash, twice) of the stretches of all texts.

    twice: the key's gram occurs more than once in the stretch, so that its strings may repeat in it.
    """
    width = length - GRAM + 1
    n = len(data)
    if n < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 2 + (np.zeros(0, bool),)
    grams, wide = gram_hashes(data)
    low = _sliding_min(grams[: n - GRAM + 1], width)  # one per string of ``length`` bytes
    count = np.maximum(np.diff(offsets) - length + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    first = np.repeat(offsets[:-1], count) + (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count))
    low = low[first]
    new = np.ones(len(first), bool)
    new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(first)))
    if len(runs) and runs.max() > width:  # one gram again and again
        place = np.arange(len(first)) - np.repeat(at, runs)
        at = np.flatnonzero(place % width == 0)
        runs = np.diff(np.append(at, len(first)))
    start = first[at]
    size = runs + length - 1
    end = start + size - 128
    content = K.mix(wide[start] + K.mix(wide[(start + end) // 2] + K.mix(wide[end] + size.astype(U64))))
    held = size - GRAM + 1
    begin = np.cumsum(held) - held
    same = grams[np.repeat(start - begin, held) + np.arange(held.sum())] == np.repeat(low[at], held)
    twice = np.add.reduceat(same, begin, dtype=np.int64) > 1 if len(begin) else np.zeros(0, bool)
    return text[at], start - offsets[text[at]], size, low[at], content, twice


def _long_text(data: np.ndarray, config: DedupConfig) -> tuple[np.ndarray, ...]:
    """Stretches of one text, piece by piece; strings start in one piece only."""
    parts = []
    for s in range(0, len(data), config.piece):
        view = data[s : s + config.piece + config.length - 1]
        _, start, *rest = stretches(view, np.array([0, len(view)]), config.length)
        parts.append((start + s, *rest))
    joined = [np.concatenate(x) for x in zip(*parts, strict=True)]
    return np.zeros(len(joined[0]), np.int64), *joined


def _keyed(rows: DataFrame, config: DedupConfig) -> DataFrame:
    struct = pa.struct([("s", pa.int32()), ("l", pa.int32()), ("key", pa.int64()), ("content", pa.int64()),
                        ("twice", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in K.text_chunks(batch.column("text"), 1 << 17):
                n = len(offsets) - 1
                if n == 1 and len(data) > config.piece:
                    text, start, size, key, content, twice = _long_text(data, config)
                else:
                    text, start, size, key, content, twice = stretches(data, offsets, config.length)
                if not len(text):
                    continue
                part = batch.slice(at, n)
                per = np.bincount(text, minlength=n)
                items = pa.StructArray.from_arrays(
                    [pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(key.view(np.int64)),
                     pa.array(content.view(np.int64)), pa.array(twice)], fields=list(struct))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)), items)
                out = pa.RecordBatch.from_arrays([part.column("h"), part.column("c"), lists], names=["h", "c", "parts"])
                yield out.filter(pa.array(per > 0))

    return rows.mapInArrow(
        K.tidy(run), "h long, c long, parts array<struct<s: int, l: int, key: long, content: long, twice: boolean>>")


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is not."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int16) - text[:-1])
    change = np.flatnonzero(step)
    out = np.zeros(n, bool)
    if len(change):
        after = np.searchsorted(change, np.arange(n))
        inside = after < len(change)
        out[inside] = step[change[after[inside]]] > 0
    return out


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros follow the end."""
    w = np.concatenate([text, np.zeros(8, np.uint8)]).astype(U64)
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        w[:-step] = (w[:-step] << U64(bits)) | w[step:]
    return w[: len(text)]


def _direct(words: np.ndarray, whole: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` in the order of their first ``depth`` bytes; whole: hashes of those bytes, for equal ones."""
    n = len(words)
    order = at[np.argsort(words[at], kind="stable")]
    values = words[order]
    active = np.arange(len(order))
    group = np.cumsum(np.concatenate([[False], values[1:] != values[:-1]])) if len(order) else active
    for off in range(8, depth, 8):
        if not len(active):
            break
        new = np.concatenate([[True], group[1:] != group[:-1]])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(group)))
        open_ = size > 1
        h = whole[order[active]]
        open_ &= np.minimum.reduceat(h, begin) != np.maximum.reduceat(h, begin)
        keep = np.repeat(open_, size)
        active, group = active[keep], group[keep]
        if not len(active):
            break
        place = order[active]
        further = place + off
        value = np.where(further < n, words[np.minimum(further, n - 1)], U64(0))
        inner = np.lexsort((value, group))
        order[active] = place[inner]
        value = value[inner]
        group = np.cumsum(np.concatenate([[False], (group[1:] != group[:-1]) | (value[1:] != value[:-1])]))
    return order


def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Positions where ``wanted`` is true, in the order of the first ``depth`` bytes of their suffixes.

    Only suffixes smaller than their successors are sorted directly. Any other follows from its successor:
    buckets of first bytes are scanned upwards, and the suffix before each entry goes to the next free place
    of its own bucket. Suffixes that lead from a wanted one to its next smaller one take part.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_next(text)
    ends = np.flatnonzero(small)
    take = wanted.copy()
    need = np.flatnonzero(wanted & ~small)
    nxt = np.searchsorted(ends, need)
    upto = np.where(nxt < len(ends), ends[np.minimum(nxt, max(len(ends) - 1, 0))] if len(ends) else n - 1, n - 1)
    jump = np.zeros(n + 1, np.int64)
    np.add.at(jump, need, 1)
    np.add.at(jump, np.minimum(upto, n - 1) + 1, -1)
    take |= np.cumsum(jump[:n]) > 0
    words = _words(text)
    whole = gram_hashes(np.concatenate([text, np.zeros(depth, np.uint8)]))[1]
    whole = K.mix(whole[:n] + K.mix(whole[depth - 128 : depth - 128 + n]))
    direct = _direct(words, whole, np.flatnonzero(take & small), depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if take[n - 1]:
        waiting[text[n - 1]].append(np.array([n - 1]))  # the last suffix is followed by the empty one
    out = []

    def induce(entries: np.ndarray, c: int) -> np.ndarray:
        """Hands the suffixes before the entries to their buckets; those of bucket c are returned."""
        before = entries[entries > 0] - 1
        before = before[take[before] & ~small[before]]
        first = text[before]
        same = before[first == c]
        before, first = before[first > c], first[first > c]
        if len(before):
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cut = np.flatnonzero(first[1:] != first[:-1]) + 1
            for part in np.split(before, cut):
                waiting[text[part[0]]].append(part)
        return same

    for c in range(256):
        entries = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waiting[c] = []
        while len(entries):  # induced ones come before those sorted directly
            out.append(entries)
            entries = induce(entries, c)
        own = direct[bounds[c] : bounds[c + 1]]
        if len(own):
            out.append(own)
            induce(own, c)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def neighbours_alike(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Which positions share their first ``depth`` bytes with a neighbour in the order."""
    words = _words(text)
    pair = np.arange(len(order) - 1) if len(order) else np.zeros(0, np.int64)
    steps = [*range(0, depth - 7, 8), depth - 8]
    for off in dict.fromkeys(steps):  # common prefixes grow by eight bytes while they agree
        if not len(pair):
            break
        pair = pair[words[order[pair] + off] == words[order[pair + 1] + off]]
    alike = np.zeros(len(order), bool)
    alike[pair] = True
    alike[pair + 1] = True
    return order[alike]


_FOUND = "key long, content long, runs array<struct<o: int, n: int>>"


def _runs(begin: np.ndarray, marked: np.ndarray) -> list[list[dict]]:
    """For each stretch, runs (offset, strings) of marked positions."""
    out = []
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        at = np.flatnonzero(marked[a:b])
        if not len(at):
            out.append([])
            continue
        cut = np.flatnonzero(np.diff(at) > 1) + 1
        out.append([{"o": int(x[0]), "n": len(x)} for x in np.split(at, cut)])
    return out


def _sort_bucket(config: DedupConfig):
    def run(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["key", "content"])
        parts = rows["bytes"].tolist()
        text = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts])
        begin = np.concatenate([[0], np.cumsum(size)])
        wanted = np.arange(len(text)) + config.length <= np.repeat(begin[1:], size)
        order = two_stage_order(text, wanted, config.length)
        marked = np.zeros(len(text), bool)
        marked[neighbours_alike(text, order, config.length)] = True
        runs = _runs(begin, marked)
        out = pd.DataFrame({"key": rows["key"].to_numpy(), "content": rows["content"].to_numpy(), "runs": runs})
        del text, wanted, order, marked, parts
        K.release()
        return out[[bool(r) for r in runs]]

    return run


def _hot_strings(rows: DataFrame, config: DedupConfig) -> DataFrame:
    """(key, content, runs) for stretches of keys that are too frequent for one task: counted by string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in K.text_chunks(batch.column("bytes"), 1 << 17):
                whole = gram_hashes(data)[1]
                count = np.diff(offsets) - config.length + 1
                o = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                first = np.repeat(offsets[:-1], count) + o
                x = whole[first]
                y = whole[first + config.length - 128]
                part = batch.slice(at, len(count))
                key = np.repeat(part.column("key").to_numpy(), count)
                content = np.repeat(part.column("content").to_numpy(), count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(content), pa.array(o.astype(np.int32)), pa.array(x.view(np.int64)),
                     pa.array(y.view(np.int64))], names=["key", "content", "o", "x", "y"])

    strings = rows.dropDuplicates(["key", "content"]).mapInArrow(
        K.tidy(run), "key long, content long, o int, x long, y long")
    strings = written(strings, "strings")
    often = strings.groupBy("x", "y").agg(F.count("*").alias("n")).where("n > 1").select("x", "y")
    return strings.join(often, ["x", "y"]).groupBy("key", "content").agg(
        F.collect_list(F.struct("o", F.lit(1).alias("n"))).alias("runs"))


def repeated(docs: DataFrame, config: DedupConfig | None = None) -> DataFrame:
    """(h, c, spans): for texts that lose bytes, their spans (start, end); h and c as made by ``_handle``."""
    config = config or DedupConfig()
    small_batches(docs.sparkSession)
    rows = _handle(docs).select("h", "c", "text")
    keyed = written(_keyed(rows, config), "stretches")
    items = keyed.select("h", "c", F.inline("parts"))
    counts = items.groupBy("key", "content").agg(F.count("*").alias("m"), F.max("twice").alias("twice"))
    keys = counts.groupBy("key").agg(
        F.sum("m").alias("total"), F.count("*").alias("kinds"), F.max("twice").alias("twice"))
    status = counts.select("key", "content", "m").join(keys.where("total > 1 or twice"), "key").select(
        "key", "content", F.col("m") > 1, "kinds", (F.col("kinds") > 1) | F.col("twice")) \
        .toDF("key", "content", "whole", "kinds", "mixed")
    hits = written(items.drop("twice").join(status, ["key", "content"]), "hits")
    single = hits.where("mixed").groupBy("key", "content").agg(
        F.min(F.struct("h", "c", "s", "l")).alias("at"), F.first("kinds").alias("kinds"))
    wanted = single.groupBy(F.col("at.h").alias("h"), F.col("at.c").alias("c")).agg(F.collect_list(F.struct(
        F.col("at.s").alias("s"), F.col("at.l").alias("l"), "key", "content", "kinds")).alias("parts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            out: dict[str, list] = {"key": [], "content": [], "kinds": [], "bytes": []}
            for text, parts in zip(texts, batch.column("parts").to_pylist(), strict=True):
                for p in parts:
                    for name in ("key", "content", "kinds"):
                        out[name].append(p[name])
                    out["bytes"].append(text[p["s"] : p["s"] + p["l"]])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("key", pa.int64()), ("content", pa.int64()), ("kinds", pa.int64()), ("bytes", pa.binary())]))

    cuts = written(rows.join(wanted, ["h", "c"]).select("text", "parts").mapInArrow(
        K.tidy(cut), "key long, content long, kinds long, bytes binary"), "cuts")
    normal = cuts.where(F.col("kinds") <= config.hot)
    total = normal.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    tasks = -(-total // config.task_bytes)
    found = normal.withColumn("_task", F.pmod(F.xxhash64("key"), F.lit(max(1, tasks)))).groupBy("_task") \
        .applyInPandas(_sort_bucket(config), _FOUND)
    found = found.unionByName(_hot_strings(cuts.where(F.col("kinds") > config.hot), config))
    found = written(found, "found")
    length = config.length
    parts = hits.where("not whole").join(found, ["key", "content"]).select("h", "c", "s", F.inline("runs")).select(
        "h", "c", (F.col("s") + F.col("o")).alias("start"),
        (F.col("s") + F.col("o") + F.col("n") + length - 1).alias("end"))
    spans = hits.where("whole").select(
        "h", "c", F.col("s").alias("start"), (F.col("s") + F.col("l")).alias("end")).unionByName(parts)
    # A set: repeated rows find the same spans, which count once.
    return spans.groupBy("h", "c").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _handle(docs: DataFrame) -> DataFrame:
    """text with h and c, which tell texts (with their ids) apart."""
    h, c = _parts("doc_id", F.coalesce("text", F.lit("")))
    return docs.select("text", h.alias("h"), c.alias("c"))


def _parts(doc_id, text) -> tuple:
    """A 64-bit hash, and length with checksum."""
    return F.xxhash64(doc_id, text), F.octet_length(text).cast("long") * (1 << 32) + F.crc32(text)


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def dedup(docs: DataFrame, config: DedupConfig | None = None, whole_characters: bool = False,
          keep_text: bool = True) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, kept_sha256 and the remaining bytes (``kept``) or text.

    ``whole_characters`` keeps characters that a span covers in part, so that the rest is a valid text: the
    text column is then replaced. Otherwise ``kept`` holds the bytes if ``keep_text`` says so.
    """
    config = config or DedupConfig()
    spans = repeated(docs, config)
    base = [f for f in docs.schema.fields if f.name not in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")]
    extra = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
             T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    if keep_text and not whole_characters:
        extra.append(T.StructField("kept", T.BinaryType()))
    if not keep_text and not whole_characters:
        base = [f for f in base if f.name != "text"]
    schema = T.StructType([*base, *extra])
    names = [f.name for f in base]
    text = F.coalesce("text", F.lit(""))
    h, c = _parts("doc_id", text)
    joined = docs.select("text", *[n for n in names if n != "text"], h.alias("_llm_h"), c.alias("_llm_c")) \
        .join(spans.toDF("_llm_h", "_llm_c", "_llm_spans"), ["_llm_h", "_llm_c"], "left").drop("_llm_h", "_llm_c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            n_bytes, n_removed, n_spans, digest, rest = [], [], [], [], []
            for text, found in zip(texts, batch.column("_llm_spans").to_pylist(), strict=True):
                data = text or b""
                cuts = merged(found)
                if whole_characters:
                    cuts = [(a, b) for a, b in (_inner(data, a, b) for a, b in cuts) if a < b]
                left, at = [], 0
                for a, b in cuts:
                    left.append(data[at:a])
                    at = b
                kept = b"".join([*left, data[at:]]) if cuts else data
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(kept))
                n_spans.append(len(cuts))
                digest.append(hashlib.sha256(kept).hexdigest())
                rest.append(None if text is None else kept)
            columns = [batch.column(n) if n != "text" or not whole_characters else
                       pa.array([None if k is None else k.decode() for k in rest], pa.string()) for n in names]
            columns += [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                        pa.array(digest, pa.string())]
            if keep_text and not whole_characters:
                columns.append(pa.array(rest, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(K.tidy(run), schema)


def _inner(data: bytes, a: int, b: int) -> tuple[int, int]:
    """The span without characters that it covers in part."""
    while a < b and data[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)


#: The same rows in DuckDB: every 200-byte string of every text, counted.
SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
s as (select doc_id, x, length(x) // 2 as n from d),
w as (select doc_id, p, md5(substr(x, 2 * p + 1, 400)) as k
      from (select doc_id, x, unnest(range(0, greatest(n - 199, 0))) as p from s)),
r as (select doc_id, p from w where k in (select k from w group by k having count(*) > 1)),
g as (select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= 200 then 0 else 1 end as f from r),
i as (select doc_id, p, sum(f) over (partition by doc_id order by p) as run from g),
c as (select doc_id, run, min(p) as a, max(p) + 200 as b from i group by doc_id, run),
e as (select doc_id, run, a, b, lag(b, 1, 0) over (partition by doc_id order by run) as before from c),
t as (select e.doc_id, sum(b - a) as removed, count(*) as spans,
             string_agg(substr(x, (2 * before + 1)::bigint, (2 * (a - before))::bigint), '' order by run) as head, max(b) as tail
      from e join s using (doc_id) group by e.doc_id)
select s.doc_id, n as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, (2 * coalesce(tail, 0) + 1)::bigint))) as kept_sha256
from s left join t using (doc_id)
"""
