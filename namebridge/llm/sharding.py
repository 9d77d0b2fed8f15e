"""Operator 3: shards by fixed virtual slots.

Every record hashes into one of a fixed number of virtual slots. Bytes are summed per slot, and a
versioned map says which shard a slot belongs to. Version 1 deals the slots out in turn; rebalancing adds a
version in which only the slots that must move have moved. Reading a record's shard is a lookup in the map.

Nulls, empty texts and repeated rows are records like any other (a null text has no bytes and size 1).
Further columns pass through ``assign``. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from namebridge.llm.stages import documents, written

SLOTS = 4096
#: Tasks over which repeated rows are dealt while they learn that they repeat.
_SALTS = 16


@dataclass(frozen=True)
class SlotMap:
    """The shard of each virtual slot in each version; the last version holds."""

    shards: int
    versions: tuple[tuple[int, ...], ...]

    @property
    def current(self) -> tuple[int, ...]:
        return self.versions[-1]

    def table(self, spark: SparkSession) -> DataFrame:
        """version, vslot, shard: versions times slots rows, whatever the data."""
        rows = [(v + 1, s, shard) for v, m in enumerate(self.versions) for s, shard in enumerate(m)]
        return spark.createDataFrame(rows, "version int, vslot int, shard int")

    def rebalanced(self, weights: dict[int, int]) -> SlotMap:
        """One version more, with near equal weight per shard, moving few slots.

        Each step takes the heaviest and the lightest shard and moves the slot (or swaps the two slots)
        that brings both closest together, until no step helps.
        """
        now = list(self.current)
        held = [{} for _ in range(self.shards)]
        for slot, shard in enumerate(now):
            if weights.get(slot):
                held[shard][slot] = weights[slot]
        total = [sum(h.values()) for h in held]
        for _ in range(4 * len(now)):
            high = max(range(self.shards), key=lambda k: (total[k], -k))
            low = min(range(self.shards), key=lambda k: (total[k], k))
            gap = total[high] - total[low]
            move = min(((abs(gap - 2 * w), s) for s, w in held[high].items() if w < gap), default=None)
            swap = None
            if move is None or move[0] > gap // 20:
                small = sorted((w, s) for s, w in held[low].items())
                for s, w in held[high].items():
                    for v, t in small:
                        if 0 < w - v < gap and (swap is None or abs(gap - 2 * (w - v)) < swap[0]):
                            swap = (abs(gap - 2 * (w - v)), s, t)
            if move is None and swap is None:
                break
            if swap is not None and (move is None or swap[0] < move[0]):
                pairs = [(swap[1], high, low), (swap[2], low, high)]
            else:
                pairs = [(move[1], high, low)]
            best = swap[0] if len(pairs) == 2 else move[0]
            if best >= gap:
                break
            for slot, a, b in pairs:
                w = held[a].pop(slot)
                held[b][slot] = w
                total[a] -= w
                total[b] += w
                now[slot] = b
        return SlotMap(self.shards, (*self.versions, tuple(now)))


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    return SlotMap(shards, (tuple(s % shards for s in range(slots)),))


def record_slot(columns: list[str], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes per slot: at most one number per virtual slot, so it may come to the driver."""
    return {r.vslot: r.b for r in records.groupBy("vslot").agg(F.sum("size").alias("b")).collect()}


def assign(docs: DataFrame, shards: int = 8, slots: int = SLOTS) -> tuple[DataFrame, SlotMap]:
    """docs with size, vslot, shard and slot (place in the shard, gapless from 0), and the map behind it.

    The slot hashes doc_id and text together, so neither a frequent id nor a group of copies fills one slot; equal
    texts are spread like any others. Rows that repeat id and text are told apart by their place in the table, so they
    are spread as well. Columns of docs with the names added here (and ``slot_begin``) are replaced.
    """
    light = written(_light(docs, slots), "sharding")
    counts = {r.vslot: (r.b, r.n) for r in light.groupBy("vslot").agg(
        F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
    layout = first_map(shards, slots).rebalanced({s: b for s, (b, _) in counts.items()})
    begin, place = [0] * shards, {}
    for s in sorted(counts):
        shard = layout.current[s]
        place[s] = (shard, begin[shard])
        begin[shard] += counts[s][1]
    # One row per virtual slot: bounded by the number of slots, so safe to broadcast.
    places = docs.sparkSession.createDataFrame(
        [(s, a, b) for s, (a, b) in place.items()], "vslot int, shard int, slot_begin long")
    order = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    out = light.withColumn("slot", F.row_number().over(order).cast("long") - 1)
    out = out.join(F.broadcast(places), "vslot")
    return out.withColumn("slot", F.col("slot") + F.col("slot_begin")).drop("slot_begin"), layout


def _light(docs: DataFrame, slots: int) -> DataFrame:
    """docs without text, with size, text_crc32 and vslot.

    Rows that agree in id and text with more than one other are spread by a number that each row has once it is
    written here; they look up in many tasks that they are repeated, so that no group of them meets in one.
    """
    sized = docs.withColumns({
        "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1,
        "text_crc32": F.crc32(F.coalesce("text", F.lit(""))),
        "_llm_h": F.xxhash64("doc_id", "text"),
        "_llm_at": F.monotonically_increasing_id(),
    }).drop("text", "slot_begin")
    sized = written(sized, "sizes")
    often = sized.groupBy("_llm_h").agg(F.count("*").alias("n")).where("n > 2").select(
        "_llm_h", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_llm_salt"), F.lit(True).alias("_llm_often"))
    marked = sized.withColumn("_llm_salt", F.pmod(F.xxhash64("_llm_at"), F.lit(_SALTS)).cast("int")) \
        .join(often, ["_llm_h", "_llm_salt"], "left")
    place = F.when(F.col("_llm_often"), F.xxhash64("_llm_h", "_llm_at")).otherwise(F.col("_llm_h"))
    return marked.withColumn("vslot", F.pmod(place, F.lit(slots)).cast("int")) \
        .drop("_llm_h", "_llm_at", "_llm_salt", "_llm_often")


def load_map(spark: SparkSession, path: str) -> SlotMap:
    """The map that ``write_shards`` or ``rebalance`` stored: versions times slots rows."""
    rows = spark.read.parquet(f"{path}/map").orderBy("version", "vslot").collect()
    versions: dict[int, list[int]] = {}
    for r in rows:
        versions.setdefault(r.version, []).append(r.shard)
    return SlotMap(1 + max(r.shard for r in rows), tuple(tuple(v) for _, v in sorted(versions.items())))


def rebalance(records: DataFrame, path: str, out: str) -> SlotMap:
    """Edit the stored map by the bytes per slot of records(vslot, size); its versions, one more, go to out."""
    layout = load_map(records.sparkSession, path).rebalanced(slot_bytes(records))
    layout.table(records.sparkSession).write.parquet(f"{out}/map")
    return layout


def write_shards(docs: DataFrame, path: str, shards: int = 8, slots: int = SLOTS) -> SlotMap:
    """One folder of Parquet files per shard under path/data, the map's versions under path/map.

    Here the slot follows from id and text alone, so rows that repeat both stay together.
    """
    counts = slot_bytes(docs.select(
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"),
        record_slot(["doc_id", "text"], slots).alias("vslot")))
    layout = first_map(shards, slots).rebalanced(counts)
    current = layout.table(docs.sparkSession).where(F.col("version") == len(layout.versions)).drop("version")
    placed = docs.withColumn("vslot", record_slot(["doc_id", "text"], slots)).join(F.broadcast(current), "vslot")
    placed.repartition("vslot").write.partitionBy("shard").parquet(f"{path}/data")
    layout.table(docs.sparkSession).write.parquet(f"{path}/map")
    return layout


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = assign(documents(spark, sf_dir).select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot",
    )
