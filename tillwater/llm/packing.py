r"""Best-fit packing by linear grouping.

Every document becomes its token ids and an end id 0; one longer than a sequence is cut into
pieces of the full length, the first of which may be shorter. Only the histogram of piece
lengths (at most one row per length) reaches the driver, which plans the sequences:

1. full pieces fill a sequence each; the other lengths above a share ``LARGE`` of a sequence (the best
   of a few shares) are sorted and split into groups of equal cardinality, and each length is rounded
   up to its group's largest;
2. with the few rounded sizes, configurations (sets of sizes that fit a sequence) are
   optimised by column generation: a linear program whose columns come from a knapsack;
3. the whole parts of the solution are filled with actual lengths, largest first; the last piece of
   a sequence is the largest that fits, which wins back the room that the rounding took;
4. what is left, and all small pieces, goes best-fit, longest first, into the sequence with
   the least room that suffices, or opens a new one.

The plan says, for each length, which ranks of its pieces go to which run of sequences and at
what offset. Ranks within a length are given by Spark, in two levels, so that no length's
pieces meet in one task.

Defined results: a NULL or empty text is the end id alone; repeated rows are packed each;
NULL ids are packed like others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwater.llm.common import cut
from tillwater.llm.tokens import Encoder, vocabulary

CAPACITY = 2048
#: Pieces longer than this share of a sequence are grouped, the others are small: each share is
#: tried, and the plan with the fewest sequences is taken. Above a half, no two grouped pieces fit
#: together, and configurations would decide nothing.
LARGE = (2 / 5, 1 / 3, 1 / 4)
GROUPS = 32
#: Columns that the linear program may generate.
COLUMNS = 400
#: Buckets that share the pieces of one length while they are numbered.
BUCKETS = 64


def _pieces(batches: Iterator[pd.DataFrame], vocab: str, capacity: int) -> Iterator[pd.DataFrame]:
    encode = Encoder.shared(vocab)
    for batch in batches:
        out = defaultdict(list)
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            ids = encode.little_endian(text or "") + b"\0\0\0\0"
            n = len(ids) // 4
            first = n % capacity or min(n, capacity)
            starts = [0, *range(first, n, capacity)]
            for piece, (start, end) in enumerate(zip(starts, [*starts[1:], n])):
                out["doc_id"].append(doc_id)
                out["piece"].append(piece)
                out["start"].append(start)
                out["length"].append(end - start)
                out["ids_crc32"].append(zlib.crc32(memoryview(ids)[4 * start : 4 * end]))
        frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
        frame["doc_id"] = frame["doc_id"].astype(batch["doc_id"].dtype) if len(frame) else frame["doc_id"]
        yield frame


def pieces(docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    path, kind = vocab or vocabulary(), docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    cut_up = keyed.mapInPandas(
        lambda batches: _pieces(batches, path, capacity),
        "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint",
    )
    return cut_up.withColumn("doc_id", F.col("doc_id").cast(kind))


# --- the plan: lengths and counts only -------------------------------------------------------


def _groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Runs (length, count) of equal total count, shortest lengths first; a length may be split."""
    total, done, out = sum(counts.values()), 0, [[]]
    for length in sorted(counts):
        left = counts[length]
        while left:
            room = -(-total * len(out) // groups) - done
            if room <= 0:
                out.append([])
                continue
            taken = min(left, room)
            out[-1].append((length, taken))
            done, left = done + taken, left - taken
    return [g for g in out if g]


def _best_configuration(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of sizes within ``capacity`` with the highest total value."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(sizes.min()), capacity + 1):
        fits = np.flatnonzero(sizes <= room)
        gains = best[room - sizes[fits]] + values[fits]
        top = int(gains.argmax())
        if gains[top] > best[room - 1] + 1e-12:
            best[room], choice[room] = gains[top], fits[top]
        else:
            best[room] = best[room - 1]
    counts, room = np.zeros(len(sizes), int), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        counts[choice[room]] += 1
        room -= int(sizes[choice[room]])
    return counts


def configurations(sizes: list[int], demand: list[int], capacity: int, columns: int = COLUMNS):
    """[(sizes used, times)] that cover at most ``demand``: the linear program's whole parts."""
    size, need = np.array(sizes), np.array(demand, float)
    basis = np.diag(capacity // size).astype(float)
    for _ in range(columns):
        inverse = np.linalg.inv(basis)
        amounts = inverse @ need
        prices = np.ones(len(size)) @ inverse
        column = _best_configuration(prices, size, capacity)
        if column @ prices <= 1 + 1e-7:
            break
        direction = inverse @ column
        rows = np.flatnonzero(direction > 1e-9)
        leaves = rows[(amounts[rows] / direction[rows]).argmin()]
        basis[:, leaves] = column
    amounts = np.linalg.inv(basis) @ need
    return [(basis[:, j].astype(int), int(amounts[j] + 1e-7)) for j in range(len(size)) if amounts[j] >= 1 - 1e-7]


class Plan:
    """Runs of equal sequences and, for each length, the ranks that they take."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sequences = 0
        self.taken: dict[int, int] = defaultdict(int)  # next rank by length
        self.places: list[tuple[int, int, int, int, int]] = []  # length, first rank, count, sequence, offset
        self.by_room: dict[int, list[list[int]]] = defaultdict(list)  # room -> [first sequence, count]
        self.rooms: list[int] = []

    def open(self, count: int) -> int:
        first, self.sequences = self.sequences, self.sequences + count
        return first

    def place(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.places.append((length, self.taken[length], count, sequence, offset))
        self.taken[length] += count

    def close(self, sequence: int, count: int, room: int) -> None:
        """These sequences have ``room`` left for small pieces."""
        if not self.by_room[room]:
            bisect.insort(self.rooms, room)
        self.by_room[room].append([sequence, count])

    def fit(self, length: int, count: int) -> None:
        """Place ``count`` pieces where the least room suffices, else into new sequences."""
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = self.capacity // length
                self.close(self.open(-(-count // each)), -(-count // each), self.capacity)
                continue
            room = self.rooms[at]
            first, n = self.by_room[room].pop()
            if not self.by_room[room]:
                self.rooms.pop(at)
            each = min(room // length, count)
            full = min(n, count // each)  # sequences that take ``each`` pieces of this length
            for k in range(each):
                self.place(length, full, first, self.capacity - room + k * length)
            count -= each * full
            if room - each * length:
                self.close(first, full, room - each * length)
            if n > full:
                self.close(first + full, n - full, room)


class _Supply:
    """The actual lengths of the groups, and how many pieces of each are left."""

    def __init__(self, groups: dict[int, list[tuple[int, int]]]):
        self.left: dict[int, int] = defaultdict(int)
        self.lengths = {size: sorted({length for length, _ in group}) for size, group in groups.items()}
        for group in groups.values():
            for length, n in group:
                self.left[length] += n
        self.all = sorted(self.left)

    def count(self, length: int) -> int:
        return self.left[length]

    def take(self, length: int, count: int) -> None:
        self.left[length] -= count
        if not self.left[length]:
            self.all.remove(length)

    def choose(self, slots: list[int], capacity: int) -> list[int]:
        """Actual lengths for the slots of a configuration, none if one cannot be filled.

        A slot takes its group's largest length, and the last one the largest of all groups that fits:
        the lengths before it are below their groups' sizes, and it makes up for them.
        """
        chosen: list[int] = []
        for at, size in enumerate(slots):
            last = at == len(slots) - 1
            lengths = self.all if last else self.lengths[size]
            k = bisect.bisect_right(lengths, capacity - sum(chosen) if last else size) - 1
            while k >= 0 and self.left[lengths[k]] <= chosen.count(lengths[k]):
                k -= 1
            if k < 0:
                return []
            chosen.append(lengths[k])
        return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """Sequences for ``counts`` (pieces by length): the best plan over the shares of ``LARGE``."""
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    best = None
    for share in LARGE:
        made = grouped_plan(counts, capacity, groups, share)
        if best is None or made.sequences < best.sequences:
            best = made
        if best.sequences == least:
            break
    return best


def grouped_plan(counts: dict[int, int], capacity: int, groups: int, share: float) -> Plan:
    """Lengths above ``share`` of a sequence by linear grouping, the others best-fit."""
    out, left = Plan(capacity), dict(counts)
    if full := left.pop(capacity, 0):
        out.place(capacity, full, out.open(full), 0)
    large = {length: n for length, n in left.items() if length > share * capacity}
    grouped = _groups(large, groups) if large else []
    if grouped:
        sizes = [g[-1][0] for g in grouped]
        merged: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for size, group in zip(sizes, grouped):
            merged[size].extend(group)  # groups that round to one size are one
        supply = _Supply(merged)
        order = sorted(merged)
        for used, times in configurations(order, [sum(n for _, n in merged[s]) for s in order], capacity):
            slots = [size for size, k in sorted(zip(order, used), reverse=True) for _ in range(int(k))]
            while times and (lengths := supply.choose(slots, capacity)):
                run = min(times, *(supply.count(length) // lengths.count(length) for length in lengths))
                sequence, offset = out.open(run), 0
                for length in lengths:
                    supply.take(length, run)
                    left[length] -= run
                    out.place(length, run, sequence, offset)
                    offset += length
                if offset < capacity:
                    out.close(sequence, run, capacity - offset)
                times -= run
    for length in sorted(left, reverse=True):
        if left[length]:
            out.fit(length, left[length])
    return out


def pack(docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence_id and offset."""
    spark = docs.sparkSession
    ready = cut(
        pieces(docs, vocab, capacity).withColumn(
            "_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int")
        )
    )
    sums = ready.groupBy("length", "_bucket").agg(F.count("*").alias("n")).collect()  # capacity x BUCKETS rows
    counts, before, starts = defaultdict(int), defaultdict(int), []
    for length, bucket, n in sorted(tuple(r) for r in sums):
        counts[length] += n
        starts.append((length, bucket, before[length]))
        before[length] += n
    made = plan(dict(counts), capacity)
    # both tables are bounded: by capacity x BUCKETS, and by the runs of the plan
    runs = defaultdict(list)
    for length, first, count, sequence, offset in made.places:
        runs[length].append((first, count, sequence, offset))
    before_bucket = spark.createDataFrame(starts, "length bigint, _bucket int, _start bigint")
    plan_rows = spark.createDataFrame(
        list(runs.items()),
        "length bigint, _runs array<struct<first:bigint,count:bigint,sequence:bigint,offset:bigint>>",
    )
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = ready.withColumn("_rank", F.row_number().over(order) - 1)
    ranked = ranked.join(F.broadcast(before_bucket), ["length", "_bucket"]).join(F.broadcast(plan_rows), "length")
    ranked = ranked.withColumn("_at", F.col("_rank") + F.col("_start"))
    run = F.filter("_runs", lambda r: (r["first"] <= F.col("_at")) & (F.col("_at") < r["first"] + r["count"]))
    return ranked.withColumn("_run", F.get(run, F.lit(0))).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_run.sequence") + F.col("_at") - F.col("_run.first")).alias("sequence_id"),
        F.col("_run.offset").alias("offset"),
    )
