"""Vector codes against plain integer arithmetic: large components, ties, odd lengths and odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from tillwater.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code int, error string"


def made(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, None, "x") for r in rows], schema)


def brute(rows, entries=64, rounds=2, parts=16):
    """(vec_id, code, error, label) of each usable row, and the digest of the codebooks."""
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    short, longer = divmod(size, parts)
    ends = [k * short + min(k, longer) for k in range(parts + 1)]
    cut = lambda v: [v[a:b] for a, b in zip(ends, ends[1:])]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]

    def assign(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(assign(cut(v)[p], book)[0], []).append(cut(v)[p])
            books[p] = [
                [sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else book[e] for e in range(len(book))
            ]
    out = []
    for i, v, label in kept:
        found = [assign(x, book) for x, book in zip(cut(v), books)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(far for _, far in found), label))
    text = ",".join(str(x) for book in books for c in book for x in c)
    return out, hashlib.sha256(text.encode()).hexdigest()


def checked(spark, rows, partitions=3):
    got = vector_codes.compress(made(spark, rows).repartition(partitions)).collect()
    want, digest = brute(rows)
    totals = {}
    for _, _, error, label in want:
        totals[label] = totals.get(label, 0) + error
    key = lambda r: (str(r[0]), r[1], r[2], r[3])
    assert sorted([(r.vec_id, r.code, r.error, r.label_error) for r in got], key=key) == sorted(
        [(i, code, error, totals[label]) for i, code, error, label in want], key=key
    )
    assert {r.codebooks_sha256 for r in got} == {digest}


@pytest.mark.parametrize("size, scale", [(32, 1), (32, 400_000), (35, 3), (5, 1)])
def test_codes_equal_plain_arithmetic(spark, size, scale):
    draw = random.Random(size)
    rows = [(k, [draw.gauss(0, 1) * scale / 8 for _ in range(size)], draw.choice([0, 1, None])) for k in range(150)]
    checked(spark, rows)


def test_ties_repeated_rows_and_odd_rows(spark):
    draw = random.Random(1)
    grid = lambda: [draw.choice([-0.5, 0.0, 0.25]) for _ in range(16)]
    rows = [(k, grid(), 1) for k in range(90)]
    rows += rows[:3] * 5 + [(None, grid(), None), (5, grid(), 2)]  # repeated rows, a NULL id, an id with two vectors
    rows += [(200, None, 1), (201, [], 1), (202, [1.0] * 15 + [None], 1), (203, [math.nan] * 16, 1)]
    rows += [(204, [math.inf] + [0.0] * 15, 1), (205, [1.0] * 17, 1)]
    checked(spark, rows)


def test_few_rows_and_none(spark):
    checked(spark, [(k, [float(k)] * 16, None) for k in range(3)])
    none = vector_codes.compress(made(spark, [(1, None, 1)]))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    other_first = [(0, [1.0] * 16, 1), (1, [2.0] * 8, 1), (2, [3.0] * 16, 1)]
    assert vector_codes.compress(made(spark, other_first)).count() == 2


def test_products_are_exact_beyond_float64():
    draw = np.random.default_rng(2)
    for length, bits in ((1, 30), (7, 28), (64, 28), (300, 20)):
        left, right = (draw.integers(-(1 << bits), 1 << bits, (9, length)) for _ in range(2))
        want = left.astype(object) @ right.T.astype(object)
        assert (vector_codes.exact_products(left, right).astype(object) == want).all()
    assert vector_codes.exact_products(np.zeros((2, 0), np.int64), np.zeros((3, 0), np.int64)).shape == (2, 3)


def test_too_large_components_are_an_error():
    with pytest.raises(ValueError):
        vector_codes.whole(np.array([[2.0**20]]))


def test_codes_decode_to_entries(spark):
    draw = random.Random(4)
    rows = [(k, [draw.random() for _ in range(16)], 0) for k in range(64)]
    vectors = made(spark, rows).selectExpr("vec_id AS id", "embedding AS vector", "label")
    length, books = vector_codes.train(vectors, rounds=0)
    for r in vector_codes.encode(vectors, length, books).collect():
        back = vector_codes.decode(r.code, books)  # each vector is an entry of its own
        assert r.error == 0 and (back == vector_codes.whole(np.array(rows[r.id][1], np.float32))).all()
