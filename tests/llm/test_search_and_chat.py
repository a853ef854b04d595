"""Exact top-k search and chat formatting against plain Python."""

import hashlib

import numpy as np
import pytest

from tillwater.llm import chat_format, top_k


def brute_top(vectors, queries, k):
    out = {}
    for q, x in queries:
        scores = [(-int(np.dot(np.floor(64 * np.array(x)), np.floor(64 * np.array(y)))), v)
                  for v, y in vectors if v != q and len(y) == len(x)]
        out[q] = [(rank, v, -s) for rank, (s, v) in enumerate(sorted(scores)[:k], 1)]
    return {q: r for q, r in out.items() if r}


def as_lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


@pytest.mark.parametrize("shard_rows, block_rows", [(10_000, 10_000), (60, 7)])
def test_top_k_equals_brute_force(spark, shard_rows, block_rows):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(6, 12)).astype(np.float32)
    rows = [(k, (centres[k % 6] + 0.1 * draw.normal(size=12)).astype(np.float32).tolist()) for k in range(400)]
    rows += [(1000 + k, rows[3][1]) for k in range(60)]  # one vector under many ids: ties
    rows += [(2000 + k, [0.5] * 5) for k in range(3)]  # another length
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    vectors = top_k.whole_numbers(table, "vec_id", "embedding")
    queries = [(v, x) for v, x in rows if v % 20 == 0]
    got = as_lists(top_k.top_k(vectors, vectors.where("id % 20 = 0"), 20, shard_rows, block_rows))
    assert got == brute_top(rows, queries, 20)


def test_rows_that_take_no_part(spark):
    bad = [(20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (None, [1.0, 1.0]), (100, [])]
    good = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (0, [1.0, 0.0])]
    schema = "vec_id bigint, embedding array<float>, id string, score int"
    table = spark.createDataFrame([(*r, "x", 1) for r in bad + good], schema)
    vectors = top_k.whole_numbers(table, "vec_id", "embedding")
    got = as_lists(top_k.top_k(vectors, vectors.where("id % 20 = 0")))
    assert got == {0: [(1, 1, 2048), (2, 2, 2048)]}
    assert top_k.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_boxes_are_tight_and_hold_their_rows():
    x = np.random.default_rng(0).integers(-60, 60, (500, 6)).astype(float)
    made = top_k.tree(np.arange(500), x, 16)
    assert sorted(made["ids"]) == list(range(500))
    for (start, end, left, _), low, high in zip(made["nodes"], made["low"], made["high"]):
        rows = made["x"][start:end]
        assert (rows.min(axis=0) == low).all() and (rows.max(axis=0) == high).all()
        assert left >= 0 or end - start <= 16


TREE = "tree_id string, node bigint, parent bigint, score double, role string, text string"


def test_branches_are_ranked_and_formatted(spark):
    rows = [
        ("t", 1, None, 0.0, "user", "hi"), ("t", 2, 1, 1.0, "assistant", "best"), ("t", 3, 1, 0.2, "assistant", "worse"),
        ("t", 4, 3, 0.2, "user", "more"), ("u", 7, 99, None, None, None), ("c", 1, 2, 0.0, "user", "circle"),
        ("c", 2, 1, 0.0, "user", "circle"), (None, 5, None, 1.0, "user", "no tree"),
    ]
    trees = spark.createDataFrame(rows, TREE)
    got = {(r.tree_id, r.leaf): (r["rank"], chat_format.parse_turns(r.formatted)) for r in chat_format.formatted_paths(trees).collect()}
    assert got == {
        ("t", 2): (1, [("user", "hi"), ("assistant", "best")]),
        ("t", 4): (2, [("user", "hi"), ("assistant", "worse"), ("user", "more")]),
        ("u", 7): (1, [("", "")]),
        (None, 5): (1, [("user", "no tree")]),
    }
    one = chat_format.formatted_paths(trees, branches=1).collect()
    assert {(r.tree_id, r.leaf) for r in one} == {("t", 2), ("u", 7), (None, 5)}
    assert chat_format.formatted_paths(trees.limit(0)).count() == 0


def test_a_long_thread_and_odd_turns(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(700)]
    rows += [(2, 0, "user", None), (2, 0, None, "tie"), (2, None, "assistant", "last <|im_end|> \\/ \\"), (2, 0, "user", None)]
    rows += [(None, 1, "assistant\n<|x|>", "a"), (3, 0, "user", "only")]
    extra = "leaf int, rank string, tree string, place int, formatted string, score string, node int"
    table = spark.createDataFrame(
        [(*r, *[None] * 7) for r in rows], f"conv_id bigint, turn bigint, role string, text string, {extra}"
    )
    trees = chat_format.as_trees(table, "conv_id", "turn")
    got = {r.tree_id: r for r in chat_format.read_back(chat_format.turn_pieces(trees)).collect()}
    whole = {r.tree_id: r for r in chat_format.formatted_paths(trees).collect()}
    turns = {
        1: [(r, t) for _, _, r, t in rows[:700]],
        2: [("", "tie"), ("user", ""), ("user", ""), ("assistant", "last <|im_end|> \\/ \\")],
        None: [("assistant\n<|x|>", "a")], 3: [("user", "only")],
    }
    assert set(got) == set(whole) == set(turns)
    for conv, wanted in turns.items():
        loss = [t for r, t in wanted if r == "assistant"]
        assert got[conv].n_turns == len(wanted)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in wanted).encode()).hexdigest()
        assert got[conv].loss_chars == len("".join(loss))
        assert got[conv].loss_sha256 == hashlib.sha256("".join(loss).encode()).hexdigest()
        text = whole[conv].formatted
        assert got[conv].formatted_chars == len(text) and chat_format.parse_turns(text) == wanted
        assert [chat_format.unescaped(text[a:b]) for a, b in whole[conv].loss_spans] == loss


TEXTS = ["", "<|im_end|>", "\\", "\\\\|", "a\n<\\|b", "<|<|", "\\/", "é<|x", "<|im_end|>\n<|im_start|>user\n"]


def test_escapes_are_reversible(spark):
    table = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for text, made in table.select("text", chat_format.escaped(table.text)).collect():
        assert chat_format.unescaped(made) == text and "<|" not in made


def test_a_stream_of_pieces_is_read_as_it_comes():
    reader, whole = chat_format._Reader(), "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<\\|x<|im_end|>\n"
    for at in range(0, len(whole), 3):  # pieces need not be turns
        reader.read(whole[at : at + 3], None, None)
    assert reader.told()[:2] == (2, hashlib.sha256(b"user\nhi\nassistant\n<|x\n").hexdigest())
