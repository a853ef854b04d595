"""Connected components of a table of links, by rounds of one shuffle each."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut

#: Nodes that a task holds at once.
HELD_NODES = 1 << 20
#: A node with more links than this, and than a thousandth of all, has them dealt over ``SPREADS`` tasks.
HUB_LINKS, SPREADS = 10_000, 64


class _Forest:
    """Nodes with the lowest node that they are known to hang together with."""

    def __init__(self):
        self.above: dict = {}

    def root(self, node):
        above = self.above
        while (up := above.setdefault(node, node)) != node:
            above[node] = above.setdefault(up, up)
            node = above[node]
        return node

    def join(self, one, other) -> None:
        one, other = self.root(one), self.root(other)
        if one != other:
            self.above[max(one, other)] = min(one, other)


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as stars around the lowest nodes."""
    forest = _Forest()

    def stars() -> pa.RecordBatch:
        found = [(node, forest.root(node)) for node in forest.above]
        found = [x for x in found if x[0] != x[1]]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kind) for k in (0, 1)], ["u", "v"])

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for one, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(one, other)
        if len(forest.above) > HELD_NODES:
            yield stars()
            forest = _Forest()
    if kind is not None:
        yield stars()


def _round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node's links, sorted: each node that this task has links of hangs on the lowest one in reach.

    ``home``: the node's own row, one in all tasks. ``open``: the links were not yet stars around
    their lowest nodes, that is, a node had a lower neighbour and another one besides.
    """
    forest, homes, kind = _Forest(), [], None
    now = least = last = None
    settled = True

    def told() -> pa.RecordBatch:
        rows = [(node, forest.root(node), True) for node in homes]
        own = set(homes)
        rows += [(node, root, False) for node in forest.above if node not in own and (root := forest.root(node)) != node]
        columns = [pa.array([r[k] for r in rows], kind) for k in (0, 1)]
        flags = pa.array([r[2] for r in rows], pa.bool_()), pa.array([not settled] * len(rows), pa.bool_())
        return pa.RecordBatch.from_arrays([*columns, *flags], ["u", "v", "home", "open"])

    for batch in batches:
        kind = batch.column(0).type
        for u, spread, v in zip(*(batch.column(k).to_pylist() for k in range(3))):
            first = (u, spread) != now
            if not first and v in (u, last):
                continue
            if not first:
                settled &= least == u  # a second neighbour beside a lower one
            if len(forest.above) > HELD_NODES:
                yield told()
                forest, homes, settled = _Forest(), [], True
                if not first:  # the next links of a node meet its lowest one again
                    forest.join(u, least)
            if first:
                now, least = (u, spread), min(u, v)
                if spread == 0:
                    homes.append(u)
            last = v
            forest.join(u, v)
    if now is not None:
        yield told()


def _dealt(edges: DataFrame, total: int) -> DataFrame:
    """(u, spread, v): every link from both ends, those of a hub dealt over ``SPREADS`` parts.

    At most 2,000 nodes have more than a thousandth of the links, so the hubs are broadcast. Each
    part of a hub has its lowest neighbour too, or a row of its own where it is lower still.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    degrees = both.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("least"))
    hubs = degrees.where(F.col("n") > max(HUB_LINKS, total // 1000)).select(F.col("u").alias("hub"), "least")
    marked = both.join(F.broadcast(hubs.select("hub")), F.col("u") == F.col("hub"), "left")
    part = F.pmod(F.xxhash64("v"), F.lit(SPREADS)).cast("int")
    spread = marked.select("u", F.when(F.col("hub").isNull(), F.lit(0)).otherwise(part).alias("spread"), "v")
    parts = F.explode(F.sequence(F.lit(0), F.lit(SPREADS - 1))).alias("spread")
    own = hubs.select(F.col("hub").alias("u"), parts, F.least("hub", "least").alias("v"))
    return spread.union(own).repartition("u", "spread").sortWithinPartitions("u", "spread", "v")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b, not NULL); root is the lowest node.

    Each task first reduces its links to stars. A round then brings the links of a node together,
    sorted, and hangs everything that meets in a task on the lowest node there; the rounds end
    when the links are stars around their lowest nodes. A task streams its links and holds
    ``HELD_NODES`` nodes at most, and a hub's links are split. Each round is written to the shared
    folder; only a count and whether one more round is needed reach the driver.
    """
    kind = dict(links.dtypes)["a"]
    edges = cut(links.where("a <> b").select("a", "b").mapInArrow(_reduced, f"u {kind}, v {kind}"))
    total = edges.count()
    while True:
        rows = cut(_dealt(edges, total).mapInArrow(_round, f"u {kind}, v {kind}, home boolean, open boolean"))
        if not rows.agg(F.max("open")).first()[0]:
            return rows.where("home").select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = rows.where("u <> v")
