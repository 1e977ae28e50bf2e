"""Sharding over fixed virtual slots.

A record's slot is a hash of its key and text, modulo a few thousand; it never
changes.  Which shard holds a slot stands in a small map with a version, kept
beside the data.  The first version deals the slots out in turn; rebalancing
sums the bytes of every slot and edits the map: slots move from shards above
the mean to shards below it, as few as bring the sizes together.  A further
shard gets slots from all others and gives none away.

The map has ``n_slots`` rows at most (a parameter), so it is read by the
driver and joined as a broadcast; records never are.

Nulls: a null key or text is a value like any other; a null text has no bytes.
Equal rows share a slot.  An empty table gives an empty result and a map whose
slots all weigh nothing.  Other columns are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_path

N_SLOTS = 4096
#: a virtual slot is numbered in this many pieces, so no task sorts a whole slot
PIECES = 16


def record_slot(key: Column, text_crc: Column, size: Column, n_slots: int) -> Column:
    return F.pmod(F.xxhash64(key, text_crc, size), F.lit(n_slots)).cast("int")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """key, size, text_crc32 and virtual slot of every record."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    d = docs.select(F.col(key).alias("doc_id"), (F.octet_length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).cast("bigint").alias("text_crc32"))
    return d.withColumn("vslot", record_slot(F.col("doc_id"), F.col("text_crc32"), F.col("size"), n_slots))


def slot_bytes(records: DataFrame) -> DataFrame:
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(n_slots: int, shards: int) -> dict[int, int]:
    return {s: s % shards for s in range(n_slots)}


def rebalanced(held: dict[int, int], weight: dict[int, int], shards: int) -> dict[int, int]:
    """``held`` with few slots moved, so that the shards' bytes come together.

    The heaviest shard gives the lightest one the slot nearest half their
    difference, as long as that narrows the difference.
    """
    held = dict(held)
    own: dict[int, list[int]] = {k: [] for k in range(shards)}
    total = dict.fromkeys(range(shards), 0)
    for s, k in held.items():
        own[k].append(s)
        total[k] += weight.get(s, 0)
    for _ in range(4 * len(held)):
        high, low = max(total, key=lambda k: (total[k], -k)), min(total, key=lambda k: (total[k], k))
        gap = total[high] - total[low]
        moving = [s for s in own[high] if 0 < weight.get(s, 0) < gap]
        if not moving:
            break
        s = min(moving, key=lambda s: (abs(weight[s] - gap / 2), s))
        swap = [t for t in own[low] if 0 < weight[s] - weight.get(t, 0) < gap]
        back = min(swap, key=lambda t: (abs(weight[s] - weight.get(t, 0) - gap / 2), t), default=None)
        if back is not None and abs(weight[s] - weight.get(back, 0) - gap / 2) >= abs(weight[s] - gap / 2):
            back = None
        if gap - 2 * min(abs(weight[s] - gap / 2), gap / 2) <= 0:
            break
        for t, a, b in ((s, high, low), *([(back, low, high)] if back is not None else [])):
            own[a].remove(t)
            own[b].append(t)
            held[t] = b
            total[a] -= weight.get(t, 0)
            total[b] += weight.get(t, 0)
    return held


def grown(held: dict[int, int], weight: dict[int, int], shards: int) -> dict[int, int]:
    """``held`` with one more shard, which takes slots until it has its share; no other shard gains."""
    held = dict(held)
    total = dict.fromkeys(range(shards), 0)
    for s, k in held.items():
        total[k] += weight.get(s, 0)
    want, got = sum(total.values()) / (shards + 1), 0
    heaps = {k: [] for k in range(shards)}
    for s, k in held.items():
        heapq.heappush(heaps[k], (weight.get(s, 0), s))
    while got < want:
        k = max((k for k in heaps if heaps[k]), key=lambda k: (total[k], -k), default=None)
        if k is None:
            break
        w, s = heapq.heappop(heaps[k])
        held[s], total[k], got = shards, total[k] - w, got + w
    return held


class SlotMap:
    """The versions of a slot-to-shard map below one folder, each a small table of its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def store(self, version: int, held: dict[int, int], shards: int) -> None:
        rows = [(s, k, shards) for s, k in sorted(held.items())]
        self.spark.createDataFrame(rows, "vslot int, shard int, shards int").coalesce(1).write.parquet(f"{self.path}/version={version}")

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema("vslot int, shard int, shards int").parquet(f"{self.path}/version={version}")

    def rows(self, version: int) -> dict[int, int]:
        return {r[0]: r[1] for r in self.read(version).collect()}


def positions(records: DataFrame) -> DataFrame:
    """``records`` with a gapless position within each shard, from 0.

    The order is by virtual slot, piece, key, crc and size.  Counts of the
    pieces (at most slots x pieces rows) give each piece its first position;
    only the rows within a piece are sorted.
    """
    r = records.withColumn("piece", F.pmod(F.xxhash64("text_crc32", "doc_id", F.lit(7)), F.lit(PIECES)).cast("int"))
    counts = r.groupBy("shard", "vslot", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("vslot", "piece").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("vslot", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("vslot", "piece").orderBy("doc_id", "text_crc32", "size")
    r = r.withColumn("nth", F.row_number().over(inside) - 1)
    return r.join(first, ["vslot", "piece"]).withColumn("slot", (F.col("first") + F.col("nth")).cast("bigint")).drop("first", "nth", "piece")


def shard(docs: DataFrame, shards: int = 8, n_slots: int = N_SLOTS, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Records with their shard and position under the rebalanced map (law ``bytes``).

    Version 1 of the map deals the slots in turn, version 2 is rebalanced by
    the slots' bytes, version 3 has one more shard.
    """
    spark = docs.sparkSession
    records = measured(docs, key, text, n_slots)
    weight = {r["vslot"]: int(r["bytes"]) for r in slot_bytes(records).collect()}  # n_slots rows at most
    store = SlotMap(spark, path or shared_path(spark, "slots"))
    start = first_map(n_slots, shards)
    held = rebalanced(start, weight, shards)
    store.store(1, start, shards)
    store.store(2, held, shards)
    store.store(3, grown(held, weight, shards), shards + 1)
    now = F.broadcast(store.read(2).select("vslot", "shard"))
    return positions(records.join(now, "vslot"))
