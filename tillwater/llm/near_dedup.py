r"""Near-duplicates by b-bit MinHash, with every link confirmed on the full shingle sets.

1. One pass over the texts gives each document its shingle set's 128-bit digest, the low
   ``BITS`` bits of ``MINIMA`` minima packed into 64-bit words, and its band keys. Documents
   with one digest form a class; from here on only classes travel, so a group of copies costs
   one row, however large it is.
2. Classes that share a band are compared by counting equal bits, corrected for those that
   agree by chance. Pairs down to ``SLACK`` (five standard deviations) below the threshold count
   as near; each band gives a spanning forest of them, not the pairs, and the forests join to
   clusters. A band beyond ``BAND_ROWS`` classes counts as near altogether, which only means
   more exact comparisons.
3. Within a cluster, full sets are compared in blocks of about ``BLOCK_ROWS`` classes. First
   every block meets the cluster's first block; after that nearly all members hang together.
   What does not (all but the cluster's most frequent component) then meets all blocks. Each
   task yields only the links that join something new, so a group of near copies never gives
   all its pairs, and no link between different texts is lost.

The number of bands of ``ROWS`` rows follows from the threshold: a pair that just reaches it
shares no band with a chance of at most ``MISSED`` (24 bands for 0.85, 35 for 0.8).

Defined results: NULL, empty and blank texts have no shingles, link with nothing and are
kept; fewer words than a shingle count as one shingle; repeated rows are copies of each other
(``keep`` lets one of them stay); NULL ids take part, and a component of NULL ids only has the
id NULL; an empty table gives no rows; extra columns are ignored by ``classes`` and kept by
``keep``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwater.llm.common import cut, whole_rows
from tillwater.llm.components import components

SHINGLE = 3
PERCENT = 85
ROWS = 5
#: Chance that a pair at the threshold shares no band, at most.
MISSED = 1e-6
MINIMA, BITS = 256, 4
LANES = 64 // BITS
WORDS = MINIMA // LANES
#: Five standard deviations of the estimate at the threshold.
SLACK = 0.116
#: Classes of a band that are compared with each other, and of a block of full sets.
BAND_ROWS = 4_096
BLOCK_ROWS = 1_024
#: Hashes by functions that are formed at once, so that one long text needs no large matrix.
CELLS = 1 << 20

_draw = np.random.default_rng(7)
FACTORS = _draw.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _draw.integers(0, 2**63, MINIMA, dtype=np.uint64)
_MIX = _draw.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of the lower-cased words of ``text``."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=1)], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    last = len(hashed) - size + 1
    total = hashed[:last] * _MIX[0]
    for k in range(1, size):
        total = _mixed(total) + hashed[k : k + last] * _MIX[k]
    return np.unique(_mixed(total))


def digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def minima(shingles: np.ndarray) -> np.ndarray:
    lowest = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, CELLS // MINIMA)
    for start in range(0, len(shingles), step):
        hashed = np.multiply.outer(FACTORS, shingles[start : start + step])
        hashed += OFFSETS[:, None]
        np.minimum(lowest, hashed.min(axis=1), out=lowest)
    return _mixed(lowest)


def packed(lowest: np.ndarray) -> np.ndarray:
    """The low bits of the minima, ``LANES`` to a 64-bit word."""
    low = (lowest & np.uint64(2**BITS - 1)).reshape(WORDS, LANES)
    return (low << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def bands_for(percent: int) -> int:
    """How many bands a similarity needs; the minima allow for ``MINIMA // ROWS``."""
    return min(MINIMA // ROWS, ceil(log(MISSED) / log(1 - min(percent / 100, 0.999) ** ROWS)))


def band_keys(lowest: np.ndarray, bands: int) -> np.ndarray:
    rows = lowest[: bands * ROWS].reshape(bands, ROWS)
    key = np.arange(bands, dtype=np.uint64) * _MIX[40]
    for k in range(ROWS):
        key = _mixed(key + rows[:, k] * _MIX[41 + k])
    return key


def _signatures(batches: Iterator[pa.RecordBatch], size: int, n_bands: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        counts, digests, packs, bands = [], [], [], []
        for text in texts:
            shingles = shingle_set(text.as_py(), size)
            counts.append(len(shingles))
            if not len(shingles):
                digests.append(None), packs.append(None), bands.append(None)
                continue
            lowest = minima(shingles)
            digests.append(digest(shingles))
            packs.append(packed(lowest).view(np.int64))
            bands.append(band_keys(lowest, n_bands).view(np.int64))
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                ids, batch.column(2), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                pa.array(packs, longs), pa.array(bands, longs),
            ],
            ["doc_id", "text_hash", "n_shingles", "class", "packed", "bands"],
        )


def signatures(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ids and hash, n_shingles, class (digest), packed low bits, band keys."""
    kind, n_bands = docs.schema["doc_id"].dataType.simpleString(), bands_for(percent)
    schema = (
        f"doc_id {kind}, text_hash bigint, n_shingles bigint, class binary, packed array<bigint>, bands array<bigint>"
    )
    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(lambda batches: _signatures(batches, size, n_bands), schema)


def _estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarities from equal low bits, corrected for the ``2**-BITS`` that agree by chance."""
    x = one ^ others
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    differ = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1)
    chance = 2.0**-BITS
    return ((1 - differ / MINIMA) - chance) / (1 - chance)


def _groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[object, Iterator[pd.DataFrame]]]:
    """Runs of equal ``key`` in a sorted stream, each as an iterator over its parts."""

    def parts() -> Iterator[tuple[object, pd.DataFrame]]:
        for batch in batches:
            keys = batch[key].to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1 if len(keys) else []
            for start, end in zip([0, *cuts], [*cuts, len(keys)]):
                if end > start:
                    yield keys[start], batch.iloc[start:end]

    for group, run in itertools.groupby(parts(), key=lambda part: part[0]):
        yield group, (part for _, part in run)


def _merge(labels: np.ndarray, one: int, other: int) -> None:
    labels[labels == labels[other]] = labels[one]


def _forest(frame: pd.DataFrame, percent: int) -> Iterator[tuple[bytes, bytes]]:
    """Edges that join the classes of one band whose estimates are near the threshold."""
    names, sizes = frame["class"].to_numpy(), frame["n_shingles"].to_numpy()
    bits = np.stack(frame["packed"].to_numpy()).view(np.uint64)
    labels = np.arange(len(names))
    for i in range(len(names) - 1):
        others = np.flatnonzero(labels[i + 1 :] != labels[i]) + i + 1
        if not len(others):
            continue
        fits = 100 * np.minimum(sizes[i], sizes[others]) >= percent * np.maximum(sizes[i], sizes[others])
        others = others[fits]
        for j in others[_estimates(bits[i], bits[others]) >= percent / 100 - SLACK]:
            if labels[j] != labels[i]:
                _merge(labels, i, j)
                yield names[i], names[j]


def _near(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    out: list[tuple[bytes, bytes]] = []
    for _, parts in _groups(batches, "band"):
        held, first = [], None
        for part in parts:
            if first is None:
                held.append(part)
                if sum(map(len, held)) <= BAND_ROWS:
                    continue
                part, held = pd.concat(held), []
                first = part["class"].iloc[0]
            out += [(first, name) for name in part["class"]]  # too many: all of the band is near
        if held and first is None:
            frame = pd.concat(held) if len(held) > 1 else held[0]
            if len(frame) > 1:
                out += _forest(frame, percent)
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=["a", "b"])
            out = []
    yield pd.DataFrame(out, columns=["a", "b"])


def _sets(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingle_set(text, size) for text in batch["text"]]
        yield pd.DataFrame({
            "class": [digest(s) if len(s) else None for s in sets], "shingles": [s.view(np.int64) for s in sets]
        })


def _links(frame: pd.DataFrame, percent: int) -> Iterator[tuple[bytes, bytes]]:
    """Links that join components: left rows with right rows, and right ones among each other where ``inside``."""
    names, left = frame["class"].to_numpy(), frame["left"].to_numpy(bool)
    labels = pd.factorize(frame["root"])[0]
    if labels.max(initial=0) == 0:
        return
    sets = [np.asarray(s, np.int64) for s in frame["shingles"]]
    lengths = np.array([len(s) for s in sets])
    vocabulary, codes = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    right = np.flatnonzero(~left)
    if not len(right):
        return
    right_codes = np.concatenate([codes[bounds[j] : bounds[j + 1]] for j in right])
    starts = np.concatenate([[0], np.cumsum(lengths[right])[:-1]])
    mark = np.zeros(len(vocabulary), np.int32)
    for i in range(len(names)) if frame["inside"].iloc[0] else np.flatnonzero(left):
        open_rows = labels[right] != labels[i]
        if not left[i]:
            open_rows &= right > i
        if not open_rows.any():
            continue
        own = codes[bounds[i] : bounds[i + 1]]
        mark[own] = 1
        both = np.add.reduceat(mark[right_codes], starts)
        mark[own] = 0
        reach = 100 * both >= percent * (lengths[i] + lengths[right] - both)
        for j in right[open_rows & reach]:
            if labels[j] != labels[i]:
                _merge(labels, i, j)
                yield names[i], names[j]


def _linked(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    for _, parts in _groups(batches, "task"):
        found = list(_links(pd.concat(list(parts)), percent))  # at most two blocks
        if found:
            yield pd.DataFrame(found, columns=["a", "b"])


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    """The links found by the tasks that ``rows`` are dealt to."""
    dealt = rows.repartition("task").sortWithinPartitions("task", "class", "left")
    wanted = dealt.select("task", "class", "root", "left", "inside", "shingles")
    return wanted.mapInPandas(lambda batches: _linked(batches, percent), "a binary, b binary")


def _clustered(clusters: DataFrame, one_of: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(cluster, class, shingles, blocks, block) of the classes in clusters."""
    ids = clusters.select("class").join(one_of, "class").select(F.col("doc_id").alias("wanted_id")).distinct()
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    sets = texts.mapInPandas(lambda batches: _sets(batches, size), "class binary, shingles array<bigint>")
    blocks = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = clusters.join(blocks, "cluster").join(sets, "class")
    # copies and repeated ids give a class more than one row; one is enough
    placed = placed.dropDuplicates(["class"])
    return placed.withColumn("block", F.pmod(F.hash("class"), F.col("blocks")))


def _task(*parts) -> Column:
    return F.concat_ws("-", F.hex("cluster"), *[p.cast("string") for p in parts])


def classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, class, root, component_id and kept."""
    signed = cut(signatures(docs, size, percent))
    found = signed.where("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("packed").alias("packed"), F.first("bands").alias("bands"),
    )
    found = cut(found)
    one_of = found.select("class", "doc_id")
    banded = found.select("class", F.explode("bands").alias("band"))
    shared = banded.withColumn("n", F.count("*").over(Window.partitionBy("band"))).where("n > 1").drop("n")
    described = shared.join(found.select("class", "n_shingles", "packed"), "class")
    near = described.repartition("band").sortWithinPartitions("band", "class").mapInPandas(
        lambda batches: _near(batches, percent), "a binary, b binary"
    )
    clusters = components(near).select(F.col("node").alias("class"), F.col("root").alias("cluster"))

    members = cut(_clustered(cut(clusters), one_of, docs, size))
    alone = members.withColumns({"root": F.col("class"), "inside": F.lit(True)})
    own = alone.withColumns({"task": _task(F.col("block")), "left": F.lit(False)})
    first = alone.where("block = 0 AND blocks > 1").withColumn(
        "other", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1))
    )
    first = first.withColumns({"task": _task(F.col("other")), "left": F.lit(True)}).drop("other")
    links = cut(_compared(own.unionByName(first), percent))
    roots = cut(components(links))

    # clusters of several blocks that do not hang together yet
    placed = members.where("blocks > 1").join(roots.withColumnRenamed("node", "class"), "class", "left")
    placed = cut(placed.withColumn("root", F.coalesce("root", "class")))
    if not placed.isEmpty():
        parts = placed.groupBy("cluster", "root").agg(F.count("*").alias("n"))
        main = parts.groupBy("cluster").agg(
            F.max_by("root", "n").alias("main"), (F.sum("n") - F.max("n")).alias("minors")
        ).where("minors > 0")
        left_open = placed.join(main, "cluster").withColumns({
            "minor_blocks": F.ceil(F.col("minors") / BLOCK_ROWS).cast("int"), "inside": F.lit(False)
        })
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        minor = left_open.where("root <> main").withColumn("other", every("blocks"))
        minor_block = F.pmod(F.hash("class", F.lit(1)), F.col("minor_blocks"))
        minor = minor.withColumns({"task": _task(minor_block, F.col("other")), "left": F.lit(True)})
        rest = left_open.withColumn("other", every("minor_blocks"))
        rest = rest.withColumns({"task": _task(F.col("other"), F.col("block")), "left": F.lit(False)})
        late = cut(_compared(minor.unionByName(rest), percent))
        if not late.isEmpty():
            roots = cut(components(links.union(late)))

    rows = signed.select("doc_id", "text_hash", "n_shingles", "class").join(
        roots.withColumnRenamed("node", "class"), "class", "left"
    ).withColumn("root", F.coalesce("root", "class"))
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least_id"))
    named = rows.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least_id"))
    named = named.select(
        "doc_id", "text_hash", "n_shingles", "class", "root", component.alias("component_id")
    )
    return named.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with its own columns only.

    A component keeps the row of its lowest id (of its lowest text hash, where ids repeat) and
    one of rows that are equal in both; rows without a shingle all stay.
    """
    hashed = docs.select(whole_rows(docs).alias("_row"), F.xxhash64("text").alias("_hash"))
    judged = cut(classes(docs, size, percent))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    winners = (
        judged.where("class IS NOT NULL")
        .groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
        .groupBy("root").agg(F.min_by(F.struct("doc_id", "text_hash", "copies"), first).alias("best"))
        .select("best.*")
    )
    blank = judged.where("class IS NULL").select("doc_id", "text_hash", F.lit(1).alias("copies")).distinct()
    chosen = cut(winners.unionByName(blank))
    same = F.col("_row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))
    once = hashed.join(chosen.where("copies = 1"), same, "left_semi")
    several = hashed.join(chosen.where("copies > 1"), same).groupBy("doc_id", "text_hash")
    return once.select("_row.*").union(several.agg(F.first("_row").alias("_row")).select("_row.*"))
