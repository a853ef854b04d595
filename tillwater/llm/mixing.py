r"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: the sources, by code point and NULL last, weigh 5, 2, 1, repeating, and share
``TOTAL`` of all words; a target stops at ``MOST`` times its source's size, the excess is
reshared by weight until none is above. Every step of that is one aggregate over the table of
sources.

Draw: a target of r times the source's size takes every document floor(r) times and a random
part of the rest once more. For that part the documents of a source are dealt by a hash into
permuted blocks, blocks are taken whole in order of their number, and of the one block that
the quota cuts, documents are taken largest first as they fit. What is then left of the quota
goes on to the documents that still fit, in rounds of the same kind, until none fits. A
document stands in one block only, so no draw overlaps another.

Split: the drawn blocks are exact quotas per source. A tree halves the output shards: at each
node the left half's blocks are a multivariate-hypergeometric draw from the node's quotas, so
that each leaf (shard) has its exact number of blocks, distributed as in a full random
permutation of all blocks. The tree runs over a fixed number of source groups on the driver,
then within each group over its sources on the executors. Shards then take disjoint ranges
of a source's permuted blocks and order their documents by a hash. ``taken`` counts the copies
that stand in shards; ``mixed`` brings the rows of a shard together.

Defined results: a NULL or empty text has size 0; NULL sources form one source, ordered last;
rows equal in id, source and text are taken together; an empty table gives no rows; extra
columns are ignored by ``taken`` and kept by ``mixed``. All draws come from hashes and fixed
seeds, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwater.llm.common import cut, whole_rows, words

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MOST = 2
SHARDS = 16
#: Source groups that the driver's part of the tree holds, whatever the number of sources.
GROUPS = 256
#: Documents that a block holds on average, and blocks that a source has at most.
BLOCK_ROWS = 16
MOST_BLOCKS = 4096
SEED = 11


def _size(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, from 0 by code point and NULL last; no task gets them all.

    Range partitions are numbered each for itself; offsets come from the partitions' counts.
    """
    spread = sources.withColumn("_none", F.col("source").isNull())
    spread = cut(spread.repartitionByRange(GROUPS, "_none", F.col("source").asc_nulls_last()))
    spread = spread.withColumn("_part", F.spark_partition_id())
    spread = cut(spread)
    counts = sorted((r[0], r[1]) for r in spread.groupBy("_part").count().collect())  # at most GROUPS rows
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    offsets = sources.sparkSession.createDataFrame(starts, "_part int, _offset bigint")
    order = Window.partitionBy("_part").orderBy("_none", "source")
    return (
        spread.join(F.broadcast(offsets), "_part")
        .withColumn("place", F.col("_offset") + F.row_number().over(order) - 1)
        .drop("_none", "_part", "_offset")
    )


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size, ...) with ``target``."""
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS)).cast("int"))
    weighed = cut(_numbered(sources).withColumn("weight", weight))
    most = MOST * F.col("source_size").cast("double")
    words_in_all = weighed.agg(F.sum("source_size")).first()[0] or 0
    share, free = 0.0, F.lit(True)
    while True:
        full, open_weight, n = weighed.agg(
            F.coalesce(F.sum(F.when(~free, most)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(~free, 1)),
        ).first()
        if not open_weight:
            break
        share = (TOTAL * words_in_all - full) / open_weight
        # a source that reached its top stays there: the share only grows
        above = weighed.where(F.col("weight") * share > most).count()
        free = F.col("weight") * share <= most
        if above == n:
            break
    return weighed.withColumn("target", F.least(F.col("weight") * share, most) if words_in_all else F.lit(0.0))


def _keyed(docs: DataFrame) -> DataFrame:
    """The units that are taken together: rows equal in id, source and text."""
    sized = docs.select("doc_id", "source", _size(F.col("text")).alias("size"), F.xxhash64("text").alias("digest"))
    return sized.groupBy("source", "doc_id", "size", "digest").agg(F.count("*").alias("rows"))


def _greedy(block: pd.DataFrame) -> pd.DataFrame:
    """Of the block that a quota cuts: documents that fit, largest first."""
    block = block.sort_values(["words", "order"], ascending=[False, True], kind="stable")
    left, more = float(block["left"].iloc[0]) if len(block) else 0.0, []
    for n in block["words"]:
        fits = 0 < n <= left
        left -= n if fits else 0
        more.append(int(fits))
    return block.assign(more=more)[["source", "order", "digest", "more"]]


#: What names a unit.
UNIT = ["source", "doc_id", "size", "digest"]


def _fill(units: DataFrame) -> DataFrame:
    """``units`` with ``more`` (0 or 1), up to the block that their source's ``left`` cuts, that block included.

    Blocks are taken whole as they fit, in order of their number; the next one as ``_greedy`` does.
    """
    filled = units.groupBy("source", "block").agg(F.sum("words").alias("_words"), F.first("left").alias("_left"))
    so_far = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = filled.withColumn("_upto", F.sum("_words").over(so_far))
    before = F.col("_upto") - F.col("_words")
    states = filled.where(before < F.col("_left")).select(
        F.col("source").alias("_source"), F.col("block").alias("_block"),
        (F.col("_upto") <= F.col("_left")).alias("whole"), (F.col("_left") - before).alias("_rest"),
    )
    same = units["source"].eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    placed = cut(units.join(states, same).withColumn("left", F.col("_rest")).drop("_source", "_block", "_rest"))
    kind = dict(units.dtypes)["source"]
    edge = placed.where("NOT whole")
    picked = edge.groupBy("source").applyInPandas(
        _greedy, f"source {kind}, order bigint, digest bigint, more int"
    )  # no ids: beside NULLs, pandas makes floats of them
    same = "p.source <=> q.source AND p.order = q.order AND p.digest = q.digest"
    parts = edge.alias("p").join(picked.alias("q"), F.expr(same)).select("p.*", "q.more")
    both = placed.where("whole").withColumn("more", F.lit(1)).unionByName(parts)
    return both.select(*UNIT, "more", "block", "words")


def _picked(known: DataFrame) -> DataFrame:
    """The units that are taken once more, by quota; each round goes on with what is left of it.

    A round after the first takes only what fits into half of what is left, where there is
    such a unit, and stops at one that does not fit: so what is left halves (or all such
    units are taken), and the rounds are as many as the quota has binary digits, at most.
    """
    some = known.where("words > 0 AND quota > 0").withColumn("left", F.col("quota"))
    done = None
    while True:
        tried = cut(_fill(some.select(*UNIT, "words", "order", "block", "left")))
        taken_now = tried.where("more = 1").select(*UNIT, "words")
        done = taken_now if done is None else cut(done.unionByName(taken_now))
        spent = done.groupBy("source").agg(F.sum("words").alias("_spent")).withColumnRenamed("source", "_source")
        same = F.expr(" AND ".join(f"k.{c} <=> d.{c}" for c in UNIT))
        rest = known.where("words > 0 AND quota > 0").alias("k").join(done.alias("d"), same, "left_anti")
        rest = rest.join(spent, rest["source"].eqNullSafe(F.col("_source")), "left").drop("_source")
        rest = rest.withColumn("left", F.col("quota") - F.coalesce("_spent", F.lit(0))).drop("_spent")
        rest = cut(rest.where("words <= left"))
        least = rest.groupBy("source").agg(F.min("words").alias("_least")).withColumnRenamed("source", "_source")
        if least.isEmpty():
            return done.select(*UNIT)
        some = rest.join(least, rest["source"].eqNullSafe(F.col("_source"))).drop("_source")
        some = some.where("words <= left / 2 OR _least > left / 2").drop("_least")


def draw(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(units with source_size, target, times, block; the sources)."""
    units = cut(_keyed(docs))
    by_source = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("docs")
    )
    sources = targets(by_source)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = cut(
        sources.withColumn("full", F.floor(ratio).cast("int"))
        .withColumn("quota", F.col("target") - F.col("full") * F.col("source_size"))
        .withColumn("blocks", F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("docs") / BLOCK_ROWS)).cast("int"))
    )
    order = F.xxhash64(F.lit(SEED), "source", "doc_id", "size", "digest")
    named = sources.withColumnRenamed("source", "_source")
    known = units.join(named, units["source"].eqNullSafe(F.col("_source"))).drop("_source")
    known = known.withColumns({
        "order": order,
        "words": F.col("size") * F.col("rows"),
        "block": F.pmod(order, F.col("blocks")).cast("int"),
    })
    known = cut(known.drop("docs", "weight", "place", "blocks"))
    chosen = _picked(known).select(*[F.col(c).alias(f"_{c}") for c in UNIT], F.lit(1).alias("_more"))
    same = F.expr(" AND ".join(f"{c} <=> _{c}" for c in UNIT))
    times = F.col("full") + F.coalesce("_more", F.lit(0))
    both = known.join(chosen, same, "left").withColumn("times", times)
    return both.drop("quota", "full", "_more", *[f"_{c}" for c in UNIT]), sources


def taken(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words), shards (of its copies)."""
    return _dealt(cut(draw(docs)[0]), shards).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * F.size("shards")).alias("taken"), "shards",
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_row"),
    ).drop("_row")


# --- output shards ----------------------------------------------------------------------------


def splitting_tree(quotas: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """counts[shard, source] with rows summing to ``sizes`` and columns to ``quotas``."""
    random = np.random.default_rng(seed)
    out = np.zeros((len(sizes), len(quotas)), np.int64)

    def split(low: int, high: int, quota: np.ndarray) -> None:
        if high - low == 1:
            out[low] = quota
            return
        middle = (low + high) // 2
        left = random.multivariate_hypergeometric(quota, int(sizes[low:middle].sum()), method="marginals")
        split(low, middle, left)
        split(middle, high, quota - left)

    split(0, len(sizes), np.asarray(quotas, np.int64))
    return out


def _even(total: int, shards: int) -> np.ndarray:
    return np.array([total // shards + (k < total % shards) for k in range(shards)], np.int64)


def block_shards(blocks: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(source, block, copy) drawn blocks with their output shard, by the splitting tree."""
    grouped = blocks.withColumn("_group", F.pmod(F.xxhash64("source"), F.lit(GROUPS)).cast("int"))
    totals = dict((r[0], r[1]) for r in grouped.groupBy("_group").count().collect())  # at most GROUPS rows
    quotas = np.array([totals.get(g, 0) for g in range(GROUPS)], np.int64)
    counts = splitting_tree(quotas, _even(int(quotas.sum()), shards), seed)
    by_group = {g: counts[:, g].tolist() for g in totals}

    def ranges(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("source", na_position="last")
        group = int(frame["_group"].iloc[0])
        tree = splitting_tree(frame["n"].to_numpy(), np.array(by_group[group]), seed + 1 + group)
        return pd.DataFrame({"source": frame["source"], "ends": list(np.cumsum(tree, axis=0).T)})

    kind = dict(blocks.dtypes)["source"]
    ends = grouped.groupBy("_group", "source").agg(F.count("*").alias("n")).groupBy("_group").applyInPandas(
        ranges, f"source {kind}, ends array<bigint>"
    ).withColumnRenamed("source", "_source")
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "block", "copy"), "block", "copy")
    ranked = blocks.withColumn("_rank", F.row_number().over(order) - 1)
    joined = ranked.join(ends, ranked["source"].eqNullSafe(F.col("_source")))
    shard = F.size(F.filter("ends", lambda end: end <= F.col("_rank")))
    return joined.select("source", "block", "copy", shard.alias("shard"))


def _dealt(units: DataFrame, shards: int) -> DataFrame:
    """``units`` with ``shards``, the output shard of each copy that is taken."""
    drawn = units.where("times > 0").groupBy("source", "block").agg(F.max("times").alias("_n"))
    blocks = drawn.select("source", "block", F.explode(F.sequence(F.lit(1), "_n")).alias("copy"))
    # a block has at most MOST copies
    lists = block_shards(blocks, shards).groupBy("source", "block").agg(
        F.array_sort(F.collect_list(F.struct("copy", "shard")))["shard"].alias("_shards")
    ).withColumnsRenamed({"source": "_source", "block": "_block"})
    same = units["source"].eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    own = F.coalesce(F.slice("_shards", F.lit(1), F.col("times")), F.array().cast("array<int>"))
    return units.join(lists, same, "left").withColumn("shards", own).drop("_source", "_block", "_shards")


def mixed(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of the mix (as often as taken) with their own columns, each partition of one shard, in its order.

    A shard is cut into ranges of its order, as many as make the session's number of shuffle
    partitions; partition (written file) k holds rows of shard k // ranges only.
    """
    copies = _dealt(cut(draw(docs)[0]), shards).select(
        F.col("source").alias("_source"), F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_of_text"),
        "order", F.posexplode("shards").alias("copy", "shard"),
    )
    place = copies.withColumn("_order", F.xxhash64(F.lit(SEED + 1), "order", "copy")).drop("order", "copy")
    sized = docs.select(whole_rows(docs).alias("_row")).withColumn("_digest", F.xxhash64("_row.text"))
    same = (
        F.col("_row.source").eqNullSafe(F.col("_source"))
        & F.col("_row.doc_id").eqNullSafe(F.col("_doc_id"))
        & (F.col("_digest") == F.col("_of_text"))
    )
    ranges = max(1, -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    # the upper 31 bits of the order, from 0, so that ranges follow each other in order
    high = F.shiftright("_order", 33) + F.lit(1 << 30)
    part = F.col("shard") * ranges + F.shiftright(high * ranges, 31)
    dealt = sized.join(place, same).withColumn("_part", part.cast("int"))
    return dealt.repartitionById(shards * ranges, "_part").sortWithinPartitions("_order").select("_row.*")
