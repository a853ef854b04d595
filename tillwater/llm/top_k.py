r"""Exact top-k inner products with one KD-tree per shard.

Vectors become whole numbers floor(64 * x). Rows are dealt to shards of about ``SHARD_ROWS`` by
a hash, so that equal vectors with many ids spread out, and each shard is packed into one row
that holds its KD-tree: the vectors in leaf order, split at the median of the widest dimension,
with a tight bounding box per node. The queries are packed into blocks, ordered by the same
splits, so that queries which walk through a tree together lie close together.

A block is searched against one shard at a time, best node first by the box-to-query bound
sum(max(q * low, q * high)); a node whose bound is below the query's kth score is left out. The
first round searches one shard per block and yields each query's kth score so far; the second
round passes it on to all other shards, which return only what can still enter the list. Trees
and blocks meet in an equi-join on (block, shard), one row per pair.

Defined results: rows whose vector is NULL, empty, or holds a NULL or non-finite component
take no part, as query or candidate; vectors are compared with those of equal length; a row is
never its own candidate, nor is a row of the same id; repeated candidate rows count each,
repeated query rows are answered once; NULL ids take no part; ties go to the smaller id; fewer
candidates than k give them all; an empty table gives no rows; extra columns are ignored.
Scores are exact while every partial sum stays below 2**53.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwater.llm.common import cut

K = 20
SCALE = 64
SHARD_ROWS = 16_384
LEAF_ROWS = 128
#: Queries in a block, and how many of them open nodes together.
BLOCK_ROWS = 4_096
QUERY_ROWS = 32


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, vector of whole numbers) of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    usable = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("bigint").alias("id"), x.alias("x"))
        .where(F.col("id").isNotNull() & (F.size("x") > 0) & F.coalesce(usable, F.lit(False)))
        .select("id", F.transform("x", lambda v: F.floor(v * scale).cast("double")).alias("x"))
    )


def tree(ids: np.ndarray, x: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict:
    """Rows in leaf order, and per node: first and last row, children, tight box."""
    order = np.arange(len(ids))
    nodes, boxes = [], []

    def build(start: int, end: int) -> int:
        rows = x[order[start:end]]
        low, high = rows.min(axis=0), rows.max(axis=0)
        me = len(nodes)
        nodes.append([start, end, -1, -1])
        boxes.append((low, high))
        widest = int((high - low).argmax())
        if end - start > leaf_rows and high[widest] > low[widest]:
            middle = (end - start) // 2
            parted = np.argpartition(rows[:, widest], middle, kind="introselect")
            order[start:end] = order[start:end][parted]
            nodes[me][2] = build(start, start + middle)
            nodes[me][3] = build(start + middle, end)
        return me

    if len(ids):
        build(0, len(ids))
    smallest = np.int8 if len(x) and np.abs(x).max() < 127 else np.float64
    return {
        "ids": ids[order], "x": x[order].astype(smallest), "nodes": np.array(nodes, np.int64),
        "low": np.array([b[0] for b in boxes]), "high": np.array([b[1] for b in boxes]),
    }


def search(made: dict, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, id, score) of the candidates that can enter a query's first ``k``.

    ``floor`` is each query's kth score so far (or -inf). Queries open a node together when it
    can help any of them, in the order of the best bound.
    """
    ids, x = made["ids"], made["x"].astype(np.float64)
    n, kth = len(queries), floor.astype(np.float64).copy()
    scores, found = np.full((n, 0), -np.inf), np.zeros((n, 0), np.int64)
    if not len(ids):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = plus @ made["high"].T + minus @ made["low"].T  # query by node
    heap = [(-bounds[:, 0].max(), 0)]
    while heap:
        _, node = heapq.heappop(heap)
        helped = np.flatnonzero(bounds[:, node] >= kth)
        if not len(helped):
            continue
        start, end, left, right = made["nodes"][node]
        if left >= 0:
            for child in (left, right):
                heapq.heappush(heap, (-bounds[helped, child].max(), child))
            continue
        got = queries[helped] @ x[start:end].T
        got[own[helped][:, None] == ids[start:end][None, :]] = -np.inf
        enters = (got >= kth[helped][:, None]).any(axis=1)  # else the list stays as it is
        if not enters.any():
            continue
        helped, got = helped[enters], got[enters]
        width = max(scores.shape[1], k)
        if scores.shape[1] < width:
            scores = np.full((n, width), -np.inf)
            found = np.full((n, width), np.iinfo(np.int64).max)
        all_scores = np.concatenate([scores[helped], got], axis=1)
        all_ids = np.concatenate([found[helped], np.broadcast_to(ids[start:end], got.shape)], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, :width]
        scores[helped] = np.take_along_axis(all_scores, order, axis=1)
        found[helped] = np.take_along_axis(all_ids, order, axis=1)
        kth[helped] = np.maximum(kth[helped], scores[helped, k - 1])
    row, place = np.nonzero((scores >= floor[:, None]) & np.isfinite(scores)) if scores.shape[1] else ([], [])
    return np.asarray(row, np.int64), found[row, place], scores[row, place].astype(np.int64)


def _packed_trees(frame: pd.DataFrame) -> pd.DataFrame:
    made = tree(frame["id"].to_numpy(np.int64), np.stack(frame["x"].to_numpy()).astype(np.float64))
    return pd.DataFrame({"dim": [frame["dim"].iloc[0]], "shard": [frame["shard"].iloc[0]], "tree": [pickle.dumps(made)]})


def _packed_queries(frame: pd.DataFrame) -> pd.DataFrame:
    made = tree(frame["id"].to_numpy(np.int64), np.stack(frame["x"].to_numpy()).astype(np.float64), QUERY_ROWS)
    return pd.DataFrame({"dim": [frame["dim"].iloc[0]], "block": [frame["block"].iloc[0]], "queries": [pickle.dumps(made)]})


def _searched(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for pair in batch.itertuples():
            made, asked = pickle.loads(pair.tree), pickle.loads(pair.queries)
            known = dict(zip(pair.known_ids, pair.known)) if pair.known_ids is not None else {}
            floor = np.array([known.get(i, -np.inf) for i in asked["ids"]], float)
            leaves = [(s, e) for s, e, left, _ in asked["nodes"] if left < 0]
            for s, e in leaves:
                for at in range(s, e, QUERY_ROWS):
                    to = min(e, at + QUERY_ROWS)
                    rows, ids, scores = search(
                        made, asked["x"][at:to].astype(np.float64), asked["ids"][at:to], floor[at:to], k
                    )
                    yield pd.DataFrame({"query_id": asked["ids"][at:to][rows], "vec_id": ids, "score": scores})


def _grid(trees: DataFrame, blocks: DataFrame, home: bool, k: int) -> DataFrame:
    """Candidates of each block in its home shard, or in all others."""
    n_shards = trees.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    n_blocks = blocks.groupBy("dim").agg((F.max("block") + 1).alias("blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    at_home = F.pmod("block", "shards") == F.col("shard")
    chosen = at_home if home else ~at_home
    left = trees.join(n_shards, "dim").join(n_blocks, "dim").withColumn("block", every("blocks")).where(chosen)
    right = blocks.join(n_shards, "dim").withColumn("shard", every("shards")).where(chosen)
    pairs = left.select("dim", "block", "shard", "tree").join(right.drop("shards"), ["dim", "block", "shard"])
    return pairs.select("tree", "queries", "known_ids", "known").mapInPandas(
        lambda batches: _searched(batches, k), "query_id bigint, vec_id bigint, score bigint"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``k`` best; inputs have id and x."""

    def dealt(df: DataFrame, per: int, name: str) -> DataFrame:
        sized = df.select("id", "x", F.size("x").alias("dim"))
        counts = sized.groupBy("dim").agg(F.ceil(F.count("*") / per).alias("n"))  # one row per vector length
        return sized.join(counts, "dim").withColumn(name, F.pmod(F.xxhash64("id", "x"), "n").cast("int")).drop("n")

    trees = cut(
        dealt(candidates, shard_rows, "shard")
        .groupBy("dim", "shard").applyInPandas(_packed_trees, "dim int, shard int, tree binary")
    )
    asked = cut(dealt(queries.distinct(), block_rows, "block"))
    blocks = cut(asked.groupBy("dim", "block").applyInPandas(_packed_queries, "dim int, block int, queries binary"))

    nothing = {"known_ids": F.lit(None).cast("array<bigint>"), "known": F.lit(None).cast("array<double>")}
    first = cut(_best(_grid(trees, blocks.withColumns(nothing), True, k), k))
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("kth"))
    known = asked.join(kth, "id").groupBy("dim", "block").agg(  # at most a block's queries
        F.collect_list(F.struct("id", "kth")).alias("known")
    )
    passed_on = blocks.join(
        known.select("dim", "block", F.col("known.id").alias("known_ids"), F.col("known.kth").alias("known")),
        ["dim", "block"], "left",
    )
    rest = _grid(trees, passed_on, False, k)
    return _best(first.drop("rank").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
