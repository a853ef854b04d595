r"""Chat formatting of reply trees.

Messages with a parent form trees. Rounds of self-joins by pointer doubling give every message
its depth and the score of its branch so far, and then list the messages of the chosen
branches: after round k an ancestor 2**k above is known, so a conversation of n turns takes
log2(n) rounds, and a round's join keys are single messages, so that a large tree is spread
out. Branches are ranked by mean score within their tree, and each chosen root-to-leaf path is
formatted as one conversation: turn by turn, as columns (:func:`turn_pieces`), whose pieces in order
are the conversation. :func:`formatted_paths` joins them to a row each; :func:`read_back` reads them as a
stream, so that a long conversation is never held as a whole.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` per turn. Inside texts a backslash becomes two
and ``<|`` becomes ``<\|``, so that no text holds a control string; in roles a line end becomes
``\/`` besides. The loss mask covers the texts of assistant turns.

Defined results: a NULL text or role is empty; a NULL tree id is a tree of its own; rows that
share a turn follow each other by role and text; repeated rows are turns of their own; a
message whose parent is missing is a root; messages that hang on a circle belong to no path; a
NULL score counts 0 and ties go to the lower leaf; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import ceil, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwater.llm.common import cut

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "\n"
TRAINED = "assistant"


def as_trees(rows: DataFrame, tree: str, turn: str) -> DataFrame:
    """Plain conversations as trees: each turn replies to the one before it."""
    order = Window.partitionBy(tree).orderBy(F.col(turn).asc_nulls_last(), "role", "text")
    node = F.row_number().over(order).cast("bigint")
    return rows.select(F.col(tree).alias("tree_id"), node.alias("node"), "role", "text").select(
        "tree_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"), "role", "text",
    )


def _key(tree: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit(""))


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Per round k: (tree, node, up, depth, total); up is the ancestor 2**k above, or NULL."""
    parents = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    known = (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("n"))
    now = cut(
        nodes.join(parents, known, "left").select(
            "tree", "node", F.col("n").alias("up"), F.lit(1).cast("bigint").alias("depth"),
            F.coalesce("score", F.lit(0.0)).alias("total"),
        )
    )
    rounds = [now]
    largest = now.groupBy("tree").count().agg(F.max("count")).first()[0] or 1
    for _ in range(ceil(log2(largest)) + 1):
        climbing, arrived = now.where("up IS NOT NULL"), now.where("up IS NULL")
        if climbing.isEmpty():
            break
        above = now.select(
            F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up2"),
            F.col("depth").alias("depth2"), F.col("total").alias("total2"),
        )
        higher = climbing.join(above, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("n"))).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"),
            (F.col("total") + F.col("total2")).alias("total"),
        )
        now = cut(higher.unionByName(arrived))
        rounds.append(now)
    return rounds


def paths(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, leaf, rank, node, below): the messages of each chosen branch, ``below`` up from the leaf."""
    rounds = _jumps(nodes)
    parents = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = rounds[-1].where("up IS NULL").join(parents, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(best))
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    found = cut(
        ranked.select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("bigint").alias("below"))
    )
    for k, jump in enumerate(rounds[:-1]):
        # each message of a path is reached once: by the jumps that make up its distance from the leaf
        steps = jump.where("up IS NOT NULL").select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        reached = found.join(steps, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n"))).select(
            "tree", "leaf", "rank", F.col("up").alias("node"), (F.col("below") + 2**k).alias("below")
        )
        found = cut(found.unionByName(reached))
    return found


# --- formatting ---------------------------------------------------------------------------------


def escaped(text: Column) -> Column:
    """The text without control strings."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "/" else m[1], text, flags=re.DOTALL)


def turn_pieces(trees: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, tree_id, leaf, rank, place, formatted, loss_start, loss_end): the turns of the ``branches`` best paths (all).

    The pieces of a tree and leaf in the order of ``place`` are the conversation; the code points of a
    piece from ``loss_start`` to ``loss_end`` are under the loss mask (NULL: none).
    """
    nodes = cut(trees.withColumn("tree", _key(F.col("tree_id"))))
    chosen = paths(nodes.select("tree", "node", "parent", "score"), branches)
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    told = nodes.select("tree", "node", "tree_id", role, text)
    named = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\/"))
    turns = chosen.join(told, ["tree", "node"]).select(
        "tree", "tree_id", "leaf", "rank", (-F.col("below")).alias("place"),
        F.concat(F.lit(START), named, F.lit(NEWLINE)).alias("head"),
        escaped(F.col("text")).alias("body"), (F.col("role") == TRAINED).alias("trained"),
    )
    begins = F.when(F.col("trained"), F.char_length("head"))
    return turns.select(
        "tree", "tree_id", "leaf", "rank", "place", F.concat("head", "body", F.lit(END + NEWLINE)).alias("formatted"),
        begins.alias("loss_start"), (begins + F.char_length("body")).alias("loss_end"),
    )


def formatted_paths(trees: DataFrame, branches: int | None = None) -> DataFrame:
    """tree_id, leaf, rank, formatted and loss_spans: each chosen path as one row."""
    before = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("formatted")).over(before), F.lit(0))
    placed = turn_pieces(trees, branches).withColumn("start", start)
    span = F.struct((F.col("start") + F.col("loss_start")).alias("start"), (F.col("start") + F.col("loss_end")).alias("end"))
    turn = F.struct("place", "formatted", F.when(F.col("loss_start").isNotNull(), span).alias("span"))
    grouped = placed.groupBy("tree", "leaf", "rank").agg(
        F.first("tree_id").alias("tree_id"), F.sort_array(F.collect_list(turn)).alias("turns")
    )
    spans = F.filter("turns.span", lambda span: span.isNotNull())
    return grouped.select(
        "tree_id", "leaf", "rank", F.array_join("turns.formatted", "").alias("formatted"), spans.alias("loss_spans")
    )


# --- reading back -------------------------------------------------------------------------------


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns that a formatted conversation holds."""
    turns = []
    for part in formatted.split(START)[1:]:
        head, _, rest = part.partition(NEWLINE)
        turns.append((unescaped(head), unescaped(rest[: -len(END + NEWLINE)])))
    return turns


class _Reader:
    """Counts and digests of one conversation, read piece by piece."""

    def __init__(self):
        self.unread, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.turns_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()

    def read(self, piece: str, start: int | None, end: int | None) -> None:
        self.chars += len(piece)
        if start is not None:
            loss = unescaped(piece[start:end])
            self.loss_chars += len(loss)
            self.loss_digest.update(loss.encode("utf-8", "surrogatepass"))
        whole, mark, self.unread = (self.unread + piece).rpartition(END + NEWLINE)
        for role, text in parse_turns(whole + mark):
            self.turns += 1
            self.turns_digest.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))

    def told(self) -> tuple:
        return self.turns, self.turns_digest.hexdigest(), self.loss_chars, self.loss_digest.hexdigest(), self.chars


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The conversations of a stream of pieces in order."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["tree_id", "leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        ids = [pa.concat_arrays([row[k] for row in found]) for k in (0, 1)]
        told = zip(*[row[2].told() for row in found])
        return pa.RecordBatch.from_arrays([*ids, *[pa.array(c, t) for c, t in zip(told, kinds)]], names)

    now, done = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("tree", "leaf", "formatted", "loss_start", "loss_end")]
        for at, (tree, leaf, piece, start, end) in enumerate(zip(*columns)):
            if (tree, leaf) != now:
                now = tree, leaf
                done.append((batch.column("tree_id").slice(at, 1), batch.column("leaf").slice(at, 1), _Reader()))
                if len(done) > 10_000:
                    yield rows(done[:-1])
                    done = done[-1:]
            done[-1][2].read(piece, start, end)
    if done:
        yield rows(done)


def read_back(pieces: DataFrame) -> DataFrame:
    """tree_id, leaf, and counts and digests of turns and loss text, parsed from the pieces of :func:`turn_pieces`.

    The pieces of a conversation are read in order, one by one: a digest of the whole is sequential, but
    only the piece at hand is held.
    """
    kinds = dict(pieces.dtypes)
    dealt = pieces.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "place")
    return dealt.select("tree", "tree_id", "leaf", "formatted", "loss_start", "loss_end").mapInArrow(
        _read,
        f"tree_id {kinds['tree_id']}, leaf {kinds['leaf']}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
