r"""Sharding by fixed virtual slots.

A record's hash gives its slot, one of ``SLOTS``, for good. Bytes are summed up by slot, and a
map from slots to shards, kept in numbered versions, says where each slot lives. Rebalancing
edits the map: slots leave shards that are too full for those that are too empty, and a new
version is written; nothing else moves. Only the table of slots (``SLOTS`` rows, whatever the
data) reaches the driver or is broadcast.

Defined results: a NULL text counts 0 bytes; a NULL id is hashed with its text; repeated rows
share a slot and get places of their own; with no rows every version still names a shard for
each slot; extra columns are ignored. A slot that weighs more than a shard's even part cannot
be split: its shard then holds little else.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 1 << 14
SHARDS = 24
#: Bytes that a row takes beside its text.
ROW_BYTES = 8


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record; text decides only where there is no id."""
    return F.pmod(F.xxhash64(F.lit("slot"), doc_id, F.when(doc_id.isNull(), text)), F.lit(slots)).cast("int")


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def first_map(slots: int = SLOTS, shards: int = SHARDS) -> list[int]:
    """The shard of each slot before anything is known of their bytes."""
    return [slot % shards for slot in range(slots)]


def rebalance(now: list[int], weight: list[int], shards: int) -> list[int]:
    """``now`` edited until shards weigh about the same; slots move only out of too full ones."""
    out, held = list(now), [[] for _ in range(shards)]
    for slot, shard in enumerate(now):
        held[shard % shards].append(slot)
        out[slot] = shard % shards
    load = [sum(weight[s] for s in slots) for slots in held]
    even = sum(load) / shards
    loose = []
    for shard in range(shards):
        # the largest slots that still leave the shard at its even part, then the smallest one over it
        for slot in sorted(held[shard], key=lambda s: (-weight[s], s)):
            if weight[slot] and load[shard] - weight[slot] >= even:
                loose.append(slot)
                load[shard] -= weight[slot]
        small = min((s for s in held[shard] if s not in set(loose) and weight[s]), key=lambda s: (weight[s], s), default=None)
        if load[shard] > even and small is not None and len(held[shard]) > 1:
            loose.append(small)
            load[shard] -= weight[small]
    emptiest = [(load[shard], shard) for shard in range(shards)]
    heapq.heapify(emptiest)
    for slot in sorted(loose, key=lambda s: (-weight[s], s)):
        total, shard = heapq.heappop(emptiest)
        out[slot] = shard
        heapq.heappush(emptiest, (total + weight[slot], shard))
    return _evened(out, weight, shards)


def _evened(out: list[int], weight: list[int], shards: int, rounds: int = 2000) -> list[int]:
    """Single moves and swaps between the fullest and the emptiest shard while they help."""
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(out):
        if weight[slot]:
            held[shard].add(slot)
    load = [sum(weight[s] for s in slots) for slots in held]
    for _ in range(rounds):
        full, empty = max(range(shards), key=lambda k: (load[k], k)), min(range(shards), key=lambda k: (load[k], k))
        gap = load[full] - load[empty]
        ours = sorted((weight[s], s) for s in held[full])
        theirs = [(0, -1), *sorted((weight[s], s) for s in held[empty])]
        best, at = None, 0
        for w, s in ours:  # the pair whose difference is nearest to half the gap
            while at + 1 < len(theirs) and w - theirs[at + 1][0] >= gap / 2:
                at += 1
            for v, t in theirs[max(0, at - 1) : at + 2]:
                moved = w - v
                if 0 < moved < gap and (best is None or abs(moved - gap / 2) < best[0]):
                    best = (abs(moved - gap / 2), moved, s, t)
        if best is None:
            break
        _, moved, s, t = best
        held[full].remove(s), held[empty].add(s)
        out[s] = empty
        if t >= 0:
            held[empty].remove(t), held[full].add(t)
            out[t] = full
        load[full], load[empty] = load[full] - moved, load[empty] + moved
    return out


def grow(now: list[int], weight: list[int], shards: int) -> list[int]:
    """``now`` for one shard more: slots move only into the new shard ``shards``."""
    out, load = list(now), [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(now):
        load[shard] += weight[slot]
        held[shard].append(slot)
    even = sum(load) / (shards + 1)
    for shard in range(shards):
        for slot in sorted(held[shard], key=lambda s: (-weight[s], s)):
            if weight[slot] and load[shard] - weight[slot] >= even:
                out[slot] = shards
                load[shard] -= weight[slot]
    return out


def slot_bytes(docs: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes by slot: one pre-aggregated row per slot and task is shuffled."""
    sums = (
        docs.select(slot_of(F.col("doc_id"), F.col("text"), slots).alias("slot"), record_bytes(F.col("text")).alias("n"))
        .groupBy("slot").agg(F.sum("n").alias("n")).collect()
    )
    weight = [0] * slots
    for slot, n in sums:
        weight[slot] = n
    return weight


def write_map(spark: SparkSession, shard_of: list[int], version: int, path: str) -> None:
    """The map as one numbered version below ``path``; versions are never changed."""
    rows = spark.createDataFrame(list(enumerate(shard_of)), "vslot int, shard int")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(vslot, shard) of ``version``, the last by default."""
    versions = spark.read.parquet(path)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == version).drop("version")


def place(docs: DataFrame, shard_map: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, vslot, shard, and ``slot``: the place in the shard, gapless from 0.

    Places are numbered in two levels: within a virtual slot, and by offsets of slots in a
    shard, so that no shard's rows meet in one task.
    """
    text = F.col("text")
    rows = docs.select(
        "doc_id", record_bytes(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        slot_of(F.col("doc_id"), text).alias("vslot"),
    )
    counts = rows.groupBy("vslot").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shard_map.join(counts, "vslot").select(
        "vslot", "shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1)
    placed = ranked.join(F.broadcast(offsets), "vslot")  # at most one row per virtual slot
    return placed.withColumn("slot", (F.col("offset") + F.col("rank")).cast("bigint")).drop("offset", "rank")
