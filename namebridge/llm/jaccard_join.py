"""Operator 10: exact n-gram Jaccard join as a join in a metric space.

The Jaccard distance d = 1 - J is a metric, and two documents link when d <= r. Steps:

1. Each text becomes the set of its distinct word 5-grams, as 64-bit hashes. Equal sets are one class.
2. Documents that can link are brought together without loss: of two linked sets, the first quarter of
   either, in one fixed order, holds a common member, and a quarter of all members is shared and lies in the
   first half of both; documents that share less have no link. The order is by hash, with shingles that
   occur in many documents last. Which shingles count as frequent changes cost only, never the result.
   Each shared member has a pivot, the first document that holds it; a region is all documents of a pivot.
   A document leaves the regions where it has so few members that no link can depend on them. Tasks combine before the shuffle: each sends one entry per shingle, however many documents hold it.
3. Regions join exactly. Members that share too little with the rest of the region go first. Then pivots
   create Voronoi regions; a document is copied into each region j with d(o, p_j) <= d(o, nearest) + 2r
   (by the triangle inequality no link is lost); regions join recursively. A region that is too large
   for one task is split between tasks in the same way. Within one component no pair is compared.
4. Links between classes become components.

Sets are compared by 64-bit hashes of words and shingles; classes by 128 bits.

Null and empty texts have no shingles and link with nothing. A text of fewer than five words has one shingle,
all its words. Equal texts and repeated rows form one class. Null ids are allowed; a group of null ids alone
has a null component_id. An empty table gives an empty result. Further columns are ignored by ``link`` and
kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from namebridge.llm import kernels as K
from namebridge.llm.components import components
from namebridge.llm.stages import documents, small_batches, written

U64 = np.uint64
#: Shingles that a task counts at a time while it looks for frequent ones.
_PENDING = 500_000
_C1, _C2 = U64(0xD1B54A32D192ED03), U64(0x8CB92BA72F3D8DD7)


@dataclass(frozen=True)
class JoinConfig:
    width: int = 5
    #: Links need percent * union <= 100 * intersection.
    percent: int = 75
    #: Shingles in more than this share of the documents come last in the order. At most
    #: (mean shingles per document / share) shingles can be so frequent, whatever the number of documents.
    frequent_share: float = 0.002
    #: Prefix entries combined by a task before they are sent.
    flush: int = 1_500_000
    #: Shingles of all members above which a region is split between tasks.
    region_cells: int = 3_000_000
    #: Members above which a region is split within a task.
    leaf: int = 256
    pivots: int = 16


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    data = K.LOWER[data]
    starts, ends, first = K.words(data, offsets)
    values, begin = K.shingles(K.span_hashes(data, starts, ends), first, width)
    out = []
    for d in range(len(begin) - 1):
        s = np.sort(values[begin[d] : begin[d + 1]])
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s)
    return out


def _keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes and the two halves of each set's 128-bit key."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, U64)
    begin = np.concatenate([[0], np.cumsum(n)])

    def sums(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, U64), np.cumsum(x, dtype=U64)])
        return total[begin[1:]] - total[begin[:-1]]

    a, b = K.mix(sums(K.mix(flat ^ _C1)) + n.astype(U64)), K.mix(sums(K.mix(flat + _C2)) ^ n.astype(U64))
    return n, a.view(np.int64), b.view(np.int64)


def prefix_length(n: int, percent: int = 75) -> int:
    """Of sets of n and m members that link, the first so many of each have one in common."""
    return n - -(-percent * n // 100) + 1


def _merge_counts(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    values = np.concatenate([a[0], b[0]])
    counts = np.concatenate([a[1], b[1]])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return values[first], (np.add.reduceat(counts, first) if len(first) else counts)


def _profiles(rows: DataFrame, config: JoinConfig) -> DataFrame:
    """kind 0: a row per document with its class; kind 1: a shingle that is frequent in a task, its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = (np.zeros(0, U64), np.zeros(0, np.int64))
        waiting: list[np.ndarray] = []
        size = n_docs = 0
        for batch in batches:
            for at, data, offsets in K.text_chunks(batch.column("text")):
                sets = _sets(data, offsets, config.width)
                n, a, b = _keys(sets)
                part = batch.slice(at, len(sets))
                zero = np.zeros(len(sets), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(zero.astype(np.int32)), part.column("doc_id"), part.column("handle"), pa.array(n),
                     pa.array(a), pa.array(b)], names=["kind", "doc_id", "handle", "n", "k1", "k2"])
                n_docs += len(sets)
                half = np.concatenate(sets) if sets else np.zeros(0, U64)
                half = half[half < U64(1 << 63)]
                waiting.append(half)
                size += len(half)
                if size > _PENDING:
                    known, waiting, size = _add(known, waiting), [], 0
        known = _add(known, waiting)
        hot = known[1] >= max(4, config.frequent_share / 2 * n_docs)
        values, counts = known[0][hot].view(np.int64), known[1][hot]
        none = pa.nulls(len(values), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(values), np.int32)), none, none, pa.array(counts), pa.array(values), none],
            names=["kind", "doc_id", "handle", "n", "k1", "k2"])

    def _add(known: tuple, waiting: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate([np.zeros(0, U64), *waiting])
        merged = _merge_counts(known, np.unique(flat, return_counts=True))
        if len(merged[0]) > _PENDING:  # rare ones cannot be frequent; losing some only changes the order
            keep = merged[1] > 1
            merged = merged[0][keep], merged[1][keep]
        return merged

    return rows.mapInArrow(K.tidy(run), "kind int, doc_id long, handle long, n long, k1 long, k2 long")


def least_shared(n: int, percent: int = 75) -> int:
    """Linked sets share so many members that lie in the first half of either.

    Sets of n and m <= n members that link share at least percent * n / 100, of which at most n / 2 lie
    outside the first half of the larger, and no more outside that of the smaller.
    """
    return max(1, -(-n * (percent - 50) // 100))


_DEALT = "kind int, bucket long, flush long, x binary, y binary, z binary"
_DEALT_NAMES = ["kind", "bucket", "flush", "x", "y", "z"]
_DEALT_ARROW = pa.schema(list(zip(_DEALT_NAMES, [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3], strict=True)))
_REGIONS_ARROW = pa.schema([("k1", pa.int64()), ("region", pa.int64())])
#: Flag beside a document's number within its flush: its task has counted the entry as shared.
_KNOWN = 1


def _prefixes(rows: DataFrame, frequent, buckets: int, config: JoinConfig) -> DataFrame:
    """Per flush: entries by bucket (kind 0), the holders of entries that several documents hold (1), and documents (2).

    A document is named by its flush and its number there. Entries cover the first half of each set in the
    order. A flush sends one entry per shingle. Those of several documents are numbered in order; a bucket's
    entries come with the number of the first of them.
    """
    bits = (buckets - 1).bit_length()

    def emit(flush: int, parts: list[np.ndarray], facts: list[tuple]) -> pa.RecordBatch:
        v = np.concatenate(parts)
        size = np.array([len(x) for x in parts])
        doc = np.repeat(np.arange(len(parts), dtype=np.uint32), size)
        order = np.lexsort((doc, v))
        v, doc = v[order], doc[order]
        at = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        count = np.diff(np.append(at, len(v)))
        several = count > 1
        holders = doc[np.repeat(several, count)]
        number = np.concatenate([[0], np.cumsum(several)])
        v = v[at]
        ref = (doc[at] << 1) | several.astype(np.uint32)
        where = (v >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(v), np.int64)
        edge = np.searchsorted(where, np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(edge))
        # 40 bits behind the bucket's: taking two shingles for one adds a candidate and nothing else
        short = ((v << U64(bits)) >> U64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        facts_ = [np.array([f[k] for f in facts], t) for k, t in ((0, np.int64), (1, np.uint32))]
        rows_ = [(0, int(b), flush, short[edge[b] : edge[b + 1]].tobytes(), ref[edge[b] : edge[b + 1]].tobytes(),
                  number[edge[b]].tobytes()) for b in used]
        rows_.append((1, -1 - flush % buckets, flush, holders.tobytes(), count[several].astype(np.uint32).tobytes(), None))
        rows_.append((2, -1 - flush % buckets, flush, facts_[0].tobytes(), facts_[1].tobytes(), None))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows_, strict=True), kinds, strict=True)], names=_DEALT_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = frequent.value
        flush = TaskContext.get().partitionId() << 16
        parts: list[np.ndarray] = []
        facts: list[tuple] = []
        seen: set[int] = set()
        size = 0
        for batch in batches:
            for _, data, offsets in K.text_chunks(batch.column("text")):
                sets = _sets(data, offsets, config.width)
                _, a, _ = _keys(sets)
                for s, key in zip(sets, a.tolist(), strict=True):
                    if not len(s) or key in seen:
                        continue
                    seen.add(key)
                    half = max(prefix_length(len(s), config.percent), -(-len(s) // 2))
                    if len(late):
                        place = np.minimum(np.searchsorted(late, s), len(late) - 1)
                        hot = late[place] == s
                        if hot.any():
                            s = np.concatenate([s[~hot], s[hot]])
                    parts.append(s[:half])
                    facts.append((key, least_shared(len(s), config.percent)))
                    size += half
                if size >= config.flush or len(parts) >= 1 << 20:
                    yield emit(flush, parts, facts)
                    flush, parts, facts, size, seen = flush + 1, [], [], 0, set()
        if size:
            yield emit(flush, parts, facts)

    return rows.mapInArrow(K.tidy(run), _DEALT)


def _counted(a: np.ndarray, b: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Distinct pairs and how often each comes."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, int)
    return (a[new], b[new]), np.diff(np.append(new, len(a))).astype(np.uint32)


def _node(flush: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return (flush.astype(np.int64) << 21) | doc.astype(np.int64)


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """For one bucket, of entries that flushes share: how many each document has (kind 3), and their pivots.

    Entries of one document of their flush are counted by document and pivot (4); those of several documents
    keep their number (5), as each of these has its own part of them.
    """
    if rows["bucket"].iloc[0] < 0:
        return rows
    raw = np.frombuffer(b"".join(rows["x"]), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    v = wide.view("<u8").ravel()
    ref = np.frombuffer(b"".join(rows["y"]), np.uint32)
    size = np.array([len(y) // 4 for y in rows["y"]])
    node = _node(np.repeat(rows["flush"].to_numpy(), size), ref >> 1)
    known = (ref & _KNOWN) == 1
    before = np.cumsum(known) - known
    number = before + np.repeat(np.frombuffer(b"".join(rows["z"]), np.int64) - before[np.cumsum(size) - size], size)
    order = np.lexsort((node, v))
    v, node, known, number = v[order], node[order], known[order], number[order].astype(np.uint32)
    at = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    count = np.diff(np.append(at, len(v)))
    shared = np.repeat(count > 1, count)
    new = shared & ~known
    nodes, times = np.unique(node[new], return_counts=True)
    lead = np.repeat(node[at], count)
    pairs, weights = _counted(node[new], lead[new])
    other = np.flatnonzero(shared & known & (lead != node))
    other = other[np.argsort(node[other] >> 21, kind="stable")]
    out = []
    for kind, of, *columns in ((3, nodes, nodes, times.astype(np.uint32)), (4, pairs[0], *pairs, weights),
                               (5, node[other], number[other], lead[other])):
        home = of >> 21
        for part in np.split(np.arange(len(of)), np.flatnonzero(home[1:] != home[:-1]) + 1) if len(of) else []:
            packed = [x[part].tobytes() for x in columns]
            out.append((kind, 0, int(home[part[0]]), *packed, *[None] * (3 - len(packed))))
    return pd.DataFrame(out, columns=_DEALT_NAMES)


def _summed(doc: np.ndarray, region: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((region, doc))
    doc, region, times = doc[order], region[order], times[order].astype(np.int64)
    if not len(doc):
        return doc, region, times
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (region[1:] != region[:-1])]))
    return doc[new], region[new], np.add.reduceat(times, new)


def _regions(rows: pd.DataFrame) -> pd.DataFrame:
    """For one flush: the documents that share enough of their first half to have a link, with their regions."""
    facts = rows[rows["kind"] == 2]
    flush = np.int64(facts["flush"].iloc[0])
    k1, need = (np.frombuffer(facts[c].iloc[0], t) for c, t in (("x", np.int64), ("y", np.uint32)))
    low = (1 << 21) - 1

    def packed(kind: int, *types) -> list[np.ndarray]:
        part = rows[rows["kind"] == kind]
        return [np.frombuffer(b"".join(part[c]), t).astype(np.int64) for c, t in zip("xyz", types, strict=False)]

    # An entry of several documents lies with the first of them, or with the pivot that its bucket found.
    holders, size = packed(1, np.uint32, np.uint32)
    pivot = _node(flush, holders[np.cumsum(size) - size])
    number, lead = packed(5, np.uint32, np.int64)
    pivot[number] = lead
    have = np.bincount(holders, minlength=len(need))
    alone, times = packed(3, np.int64, np.uint32)
    np.add.at(have, alone & low, times)
    passing = have >= need
    node, top, weight = packed(4, np.int64, np.int64, np.uint32)
    doc, region = np.concatenate([node & low, holders]), np.concatenate([top, np.repeat(pivot, size)])
    times = np.concatenate([weight, np.ones(len(holders), np.int64)])
    stay = passing[doc]
    doc, region, times = _summed(doc[stay], region[stay], times[stay])
    # Linked documents share at least ``need`` entries, so they still meet if each leaves the regions in
    # which it has the fewest, as long as these hold less than half of that number.
    order = np.lexsort((region, times, doc))
    doc, region, times = doc[order], region[order], times[order]
    total = np.cumsum(times)
    first = np.searchsorted(doc, doc)
    below = total - np.where(first > 0, total[np.maximum(first - 1, 0)], 0)
    stay = 2 * below >= need[doc]
    return pd.DataFrame({"k1": k1[doc[stay]], "region": region[stay]})


def _members(rows: DataFrame, late, cells: int, config: JoinConfig) -> DataFrame:
    """(k1, region): classes that may have links, in regions such that linked classes share one."""
    buckets = 1
    while buckets * 800_000 < cells / 2:
        buckets *= 2
    dealt = written(_prefixes(rows.select("text"), late, buckets, config).groupBy("bucket").applyInArrow(
        K.tidy_groups(_meet, _DEALT_ARROW), _DEALT), "dealt")
    members = dealt.groupBy("flush").applyInArrow(K.tidy_groups(_regions, _REGIONS_ARROW), "k1 long, region long")
    return written(members.distinct(), "members")


def _with_partner(members: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """members without those whose region holds no other class of like size; linked sets differ by percent."""
    step = -float(np.log(percent / 100))
    sized = members.join(sizes, "k1").withColumn("band", F.floor(F.log("n") / step + 1e-9))
    bands = sized.groupBy("region", "band").agg(F.count("*").alias("here"))
    near = bands.select("region", "here", F.explode(F.array(
        F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")) \
        .groupBy("region", "band").agg(F.sum("here").alias("near")).where("near > 1")
    return sized.join(near, ["region", "band"]).select("k1", "region", "n")


class _Union:
    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[others], self.root[a]))
        if len(roots) > 1:
            self.root[np.isin(self.root, roots[1:])] = roots[0]


def _links(sets: list[np.ndarray], active: np.ndarray, config: JoinConfig) -> list[tuple[int, int]]:
    """Links that connect what links connect, between one active and any other member, exactly."""
    links: list[tuple[int, int]] = []
    alive = np.arange(len(sets))
    while True:  # a member with too many shingles of its own has no partner
        if len(alive) < 2:
            return links
        flat = np.concatenate([sets[i] for i in alive])
        size = np.array([len(sets[i]) for i in alive])
        values, ids, counts = np.unique(flat, return_inverse=True, return_counts=True)
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        shared = np.add.reduceat((counts[ids] > 1).astype(np.int64), begin)
        fits = 100 * shared >= config.percent * size
        if fits.all():
            break
        alive = alive[fits]
    union = _Union(len(alive))
    mark = np.zeros(len(values), bool)

    def common(p: int, members: np.ndarray) -> np.ndarray:
        own = ids[begin[p] : begin[p] + size[p]]
        mark[own] = True
        if len(members) == len(alive):
            out = np.add.reduceat(mark[ids].astype(np.int32), begin)
        else:
            out = np.array([mark[ids[begin[i] : begin[i] + size[i]]].sum() for i in members], np.int64)
        mark[own] = False
        return out

    def test(p: int, members: np.ndarray) -> np.ndarray:
        """Links p with members; the distances."""
        inter = common(p, members)
        whole = size[p] + size[members] - inter
        near = 100 * inter >= config.percent * whole
        near &= members != p
        other = members[near]
        fresh = other[union.root[other] != union.root[p]]
        if len(fresh):
            _, one = np.unique(union.root[fresh], return_index=True)
            links.extend((int(alive[p]), int(alive[q])) for q in fresh[one])
            union.join(p, other)
        return 1 - inter / whole

    radius = 1 - config.percent / 100

    def join(members: np.ndarray, depth: int) -> None:
        if len(np.unique(union.root[members])) < 2 or not active[alive[members]].any():
            return
        if len(members) > config.leaf and depth < 12:
            step = max(1, len(members) // 8)
            pivots = members[::step][:8]
            dist = np.stack([test(p, members) for p in pivots])
            home = dist.argmin(0)
            reach = dist <= dist.min(0) + 2 * radius + 1e-9
            parts = [members[reach[j]] for j in range(len(pivots)) if (home == j).any()]
            if max(map(len, parts)) <= 0.8 * len(members):
                for part in parts:
                    join(part, depth + 1)
                return
        tried: set[int] = set()
        while True:  # any pair of two components has a member outside the largest one
            roots, place, counts = np.unique(union.root[members], return_inverse=True, return_counts=True)
            if len(roots) < 2:
                return
            outside = members[(place != counts.argmax()) & active[alive[members]]]
            if not active[alive[members]].all():
                outside = members[active[alive[members]]]
            left = [p for p in outside.tolist() if p not in tried]
            if not left:
                return
            tried.add(left[0])
            test(left[0], members)

    join(np.arange(len(alive)), 0)
    return links


_LINK = "a1 long, a2 long, b1 long, b2 long"


_LINK_ARROW = pa.schema([(c, pa.int64()) for c in ("a1", "a2", "b1", "b2")])


def _region_links(config: JoinConfig):
    def found(batches: Iterator[pa.RecordBatch]) -> list[tuple[int, int, int, int]]:
        frames, views = [], []
        for batch in batches:  # the sets stay where Arrow has them, once
            frames.append(batch.select(["region", "cell", "k1", "k2", "active"]).to_pandas())
            views += K.binary_views(batch.column("shingles"), U64)
        rows = pd.concat(frames, ignore_index=True).sort_values("active", ascending=False, kind="stable")
        out = []
        for _, part in rows.drop_duplicates(["region", "cell", "k1", "k2"]).groupby(["region", "cell"], sort=False):
            if len(part) < 2:
                continue
            sets = [views[i] for i in part.index]
            k1, k2 = part["k1"].to_numpy(), part["k2"].to_numpy()
            active = part["active"].to_numpy().astype(bool)
            out += [(k1[i], k2[i], k1[j], k2[j]) for i, j in _links(sets, active, config)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            links = np.array(found(batches), np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, i].copy()) for i in range(4)], schema=_LINK_ARROW)
        finally:
            K.release()

    return run


def _join_buckets(rows: DataFrame, cells: int, config: JoinConfig) -> DataFrame:
    """Joins regions of known size, many to a task."""
    tasks = max(1, -(-cells // config.region_cells))
    return rows.withColumn("_bucket", F.pmod(F.xxhash64("region", "cell"), F.lit(tasks))).groupBy("_bucket") \
        .applyInArrow(_region_links(config), _LINK)


def _split_large(large: DataFrame, config: JoinConfig) -> tuple[DataFrame, DataFrame]:
    """(links with pivots, rows by cell) of regions too large for one task.

    Distances to the region's pivots give links, Voronoi regions and windows. Members that pivots connect to
    the region's largest component ("core") need no comparison with each other; every other member is
    active, goes to each Voronoi region within its window, and meets all members at home there. Voronoi
    regions are cut in blocks by a hash, each block of active members meeting each block of members.
    """
    by_hash = Window.partitionBy("region").orderBy(F.xxhash64("k1", "k2"), "k1", "k2")
    chosen = large.withColumn("i", F.row_number().over(by_hash)).where(F.col("i") <= config.pivots)
    chosen = chosen.groupBy("region").agg(
        F.sort_array(F.collect_list(F.struct("i", "k1", "k2", "shingles"))).alias("pivots"))
    radius = 1 - config.percent / 100
    schema = ("region long, k1 long, k2 long, n long, shingles binary, home int, window array<int>, mask long, "
              "links array<struct<p1: long, p2: long>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = np.frombuffer(row["shingles"], U64)
                dist, mask, links = [], 0, []
                for j, p in enumerate(row["pivots"]):
                    other = np.frombuffer(p["shingles"], U64)
                    place = np.minimum(np.searchsorted(other, own), len(other) - 1)
                    inter = int((other[place] == own).sum())
                    whole = len(own) + len(other) - inter
                    dist.append(1 - inter / whole)
                    if 100 * inter >= config.percent * whole:
                        mask |= 1 << j
                        if (p["k1"], p["k2"]) != (row["k1"], row["k2"]):
                            links.append({"p1": p["k1"], "p2": p["k2"]})
                low = min(dist)
                out.append({k: row[k] for k in ("region", "k1", "k2", "n", "shingles")} | {
                    "home": dist.index(low), "mask": mask, "links": links,
                    "window": [j for j, d in enumerate(dist) if d <= low + 2 * radius + 1e-9]})
            yield pa.RecordBatch.from_pylist(out, schema=ARROW)

    pair = pa.struct([("p1", pa.int64()), ("p2", pa.int64())])
    ARROW = pa.schema([("region", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()),
                       ("shingles", pa.binary()), ("home", pa.int32()), ("window", pa.list_(pa.int32())),
                       ("mask", pa.int64()), ("links", pa.list_(pair))])
    placed = written(large.join(chosen, "region").select("region", "k1", "k2", "n", "shingles", "pivots")
                     .mapInArrow(K.tidy(run), schema), "placed")

    # Pivots that a member links with are one component; the largest by members is the core.
    def cores(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        groups: list[list[int]] = []
        for mask, count in zip(rows["mask"].tolist(), rows["count"].tolist(), strict=True):
            if mask:
                joined = [g for g in groups if g[0] & mask]
                groups = [g for g in groups if not g[0] & mask]
                total = [mask, count]
                for g in joined:
                    total = [total[0] | g[0], total[1] + g[1]]
                groups.append(total)
        best = max(groups, key=lambda g: g[1], default=[0, 0])
        return pd.DataFrame({"region": [rows["region"].iloc[0]], "core": [best[0]]})

    masks = placed.groupBy("region", "mask").agg(F.count("*").alias("count"))  # at most 2^pivots per region
    core = masks.groupBy("region").applyInPandas(cores, "region long, core long")
    placed = placed.join(core, "region").withColumn(
        "active", F.col("mask").bitwiseAND(F.col("core")) == 0)
    links = placed.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.explode("links").alias("p")) \
        .select("a1", "a2", F.col("p.p1").alias("b1"), F.col("p.p2").alias("b2"))
    homes = placed.select("region", F.col("home").alias("part"), "k1", "k2", "n", "shingles")
    guests = placed.where("active").select(
        "region", F.explode("window").alias("part"), "k1", "k2", "n", "shingles")
    sizes = homes.groupBy("region", "part").agg(F.sum("n").alias("all_cells")).join(
        guests.groupBy("region", "part").agg(F.sum("n").alias("open_cells")), ["region", "part"])
    half = config.region_cells // 2
    sizes = sizes.withColumn("blocks", F.ceil(F.col("all_cells") / half).cast("int")) \
        .withColumn("opens", F.ceil(F.col("open_cells") / half).cast("int"))
    salt = F.xxhash64("k2", "k1")
    at = F.concat_ws("/", "part", F.col("x"), F.col("y"))
    near = homes.join(sizes, ["region", "part"]).withColumn("x", F.pmod(salt, F.col("blocks"))) \
        .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("opens") - 1))) \
        .select("region", at.alias("cell"), "k1", "k2", "n", "shingles", F.lit(False).alias("active"))
    far = guests.join(sizes, ["region", "part"]).withColumn("y", F.pmod(salt, F.col("opens"))) \
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("region", at.alias("cell"), "k1", "k2", "n", "shingles", F.lit(True).alias("active"))
    return links, near.unionByName(far)


def _classes(docs: DataFrame, config: JoinConfig, handle: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Profiles (doc_id, n, k1, k2) of all documents, and (k1, k2, root1, root2) of classes that link."""
    spark = docs.sparkSession
    small_batches(spark)
    handle = F.xxhash64("doc_id", "text") if handle is None else handle
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), handle.alias("handle"), "text")
    profiled = written(_profiles(rows, config), "profiles")
    profiles = profiled.where("kind = 0").drop("kind")
    total = profiles.agg(F.count("*").alias("docs"), F.sum("n").alias("cells")).first()
    least = max(8, config.frequent_share * total.docs)
    frequent = profiled.where("kind = 1").groupBy("k1").agg(F.sum("n").alias("c")).where(F.col("c") >= least)
    late = np.sort(np.array([r.k1 for r in frequent.select("k1").collect()], np.int64).view(U64))
    late = spark.sparkContext.broadcast(late)
    members = _members(rows, late, total.cells or 0, config)
    sizes = profiles.where("n > 0").groupBy("k1").agg(F.max("n").alias("n"))
    members = written(_with_partner(members, sizes, config.percent), "crowded")
    classes = profiles.where("n > 0").groupBy("k1", "k2").agg(F.min("handle").alias("handle"))
    wanted = members.select("k1").distinct().join(classes, "k1").select("handle")
    sets = written(_with_sets(rows.join(wanted, "handle", "left_semi").select("text"), config), "sets")
    placed = members.drop("n").join(sets, "k1").select("region", "k1", "k2", "n", "shingles")
    sizes = written(members.groupBy("region").agg(
        F.sum("n").alias("cells"), F.count("*").alias("members")).where("members > 1"), "sizes")
    normal = sizes.where(F.col("cells") <= config.region_cells)
    large = sizes.where(F.col("cells") > config.region_cells)
    cells = normal.agg(F.sum("cells")).first()[0] or 0
    own = placed.join(normal.select("region"), "region").withColumn("cell", F.lit("")) \
        .withColumn("active", F.lit(True))
    links = written(_join_buckets(own, cells, config).distinct(), "links")
    if large.limit(1).count():
        found, rest = _split_large(placed.join(large.select("region"), "region"), config)
        rest = written(rest, "cells")
        cells = rest.agg(F.sum("n")).first()[0] or 0
        links = links.unionByName(found).unionByName(_join_buckets(rest, cells, config))
    links = links.select(F.struct(F.col("a1").alias("x"), F.col("a2").alias("y")).alias("u"),
                         F.struct(F.col("b1").alias("x"), F.col("b2").alias("y")).alias("v"))
    roots = components(links).select(
        F.col("node.x").alias("k1"), F.col("node.y").alias("k2"),
        F.col("root.x").alias("root1"), F.col("root.y").alias("root2"))
    return profiles, roots


def _with_sets(rows: DataFrame, config: JoinConfig) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # repeated rows meet in a task
        for batch in batches:
            for _, data, offsets in K.text_chunks(batch.column("text")):
                sets = _sets(data, offsets, config.width)
                n, a, b = _keys(sets)
                new = []
                for i, key in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
                    if key not in seen:
                        seen.add(key)
                        new.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[new]), pa.array(b[new]), pa.array(n[new]),
                     pa.array([sets[i].tobytes() for i in new], pa.binary())], names=["k1", "k2", "n", "shingles"])

    return rows.mapInArrow(K.tidy(run), "k1 long, k2 long, n long, shingles binary")


def _grouped(profiles: DataFrame, roots: DataFrame) -> DataFrame:
    """(k1, k2, n, component_id, rep1, rep2): the smallest id of each class's component, and whose class has it."""
    classes = profiles.where("n > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"))
    classes = classes.join(roots, ["k1", "k2"], "left").withColumns({
        "root1": F.coalesce("root1", "k1"), "root2": F.coalesce("root2", "k2")})
    best = classes.groupBy("root1", "root2").agg(
        F.min("least").alias("component_id"),
        F.min(F.struct(F.col("least").isNull(), "least", "k1", "k2")).alias("rep"))
    return classes.join(best, ["root1", "root2"]).select(
        "k1", "k2", "component_id", F.col("rep.k1").alias("rep1"), F.col("rep.k2").alias("rep2"))


def link(docs: DataFrame, config: JoinConfig | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every row of docs."""
    profiles, roots = _classes(docs, config or JoinConfig())
    groups = _grouped(profiles, roots).select("k1", "k2", "component_id")
    alone = profiles.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return profiles.where("n > 0").join(groups, ["k1", "k2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def keep_one(docs: DataFrame, config: JoinConfig | None = None) -> DataFrame:
    """One row of docs for each component, that of the smallest doc_id; rows without words all stay."""
    config = config or JoinConfig()
    # All columns name a row, so of rows that agree in id and text the same one stays on every run.
    whole = [F.to_json(F.struct(f"`{f.name}`")) if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`")
             for f in docs.schema.fields]
    names = [F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole[::-1])]
    profiles, roots = _classes(docs, config, names[0])
    groups = _grouped(profiles, roots)
    kept = groups.where("k1 = rep1 and k2 = rep2").select("k1", "k2", F.col("component_id").alias("_keep"))
    light = profiles.join(kept, ["k1", "k2"]).where(F.col("doc_id").eqNullSafe(F.col("_keep")))
    first = light.groupBy("k1", "k2").agg(F.min("handle").alias("_llm_handle")).select("_llm_handle")
    chosen = first.unionByName(profiles.where("n = 0").select(F.col("handle").alias("_llm_handle"))).distinct()
    rows = docs.withColumns({"_llm_handle": names[0], "_llm_second": names[1]}).join(chosen, "_llm_handle", "left_semi")
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # Rows that agree in both halves agree in all columns; rows that share one half by chance both stay.
    single = rows.where(words).dropDuplicates(["_llm_handle", "_llm_second"])
    return single.unionByName(rows.where(~F.coalesce(words, F.lit(False)))).drop("_llm_handle", "_llm_second")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(documents(spark, sf_dir))


#: The same rows in DuckDB: all pairs that share a shingle, counted.
SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as x
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.x = b.x and a.doc_id < b.doc_id
      group by all),
l as (select x, y from c join n a on c.x = a.doc_id join n b on c.y = b.doc_id where 100 * k >= 75 * (a.n + b.n - k)),
e as (select x, y from l union all select y, x from l),
r as (select doc_id, doc_id as least from d union select e.y, r.least from r join e on r.doc_id = e.x where r.least < e.y)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(r.least) as component_id
from d join r using (doc_id) left join n using (doc_id) group by d.doc_id, n.n
"""
