"""Near-duplicates against all pairs, with small blocks so that every path runs."""

import itertools
import random

import numpy as np
import pytest

from tillwater.llm import components, near_dedup


def brute(rows, size, percent):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        sets[doc_id] = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def noisy_copies(n, seed=3):
    """One original with copies of growing distance, texts of their own, and exact copies."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3, 4, 6, 9])):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(f"v{draw.randrange(5000)}" for _ in range(80))) for k in range(40)]
    rows += [(2000 + k, rows[k][1].upper()) for k in range(0, n, 5)]
    return rows + [(3000, "one two"), (3001, "ONE two"), (3002, "one"), (3003, ""), (3004, None), (3005, " ")]


@pytest.mark.parametrize("size, percent, block", [(3, 85, 1024), (5, 80, 16)])
def test_components_equal_all_pairs(documents, monkeypatch, size, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    rows = noisy_copies(90)
    docs = documents(*rows)
    want = brute(rows, size, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.classes(docs, size, percent).collect()}
    assert got == want
    kept = near_dedup.keep(docs, size, percent)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, (_, c) in want.items() if k == c)


def test_a_band_beyond_its_limit_is_near_altogether(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(near_dedup, "BAND_ROWS", 4)
    frame = pd.DataFrame({"band": [1] * 9 + [2], "class": [bytes([k]) for k in range(10)]})
    frame["n_shingles"], frame["packed"] = 5, [np.zeros(near_dedup.WORDS, np.int64)] * 10
    out = pd.concat(list(near_dedup._near(iter([frame.iloc[:3], frame.iloc[3:]]), 85)))
    assert set(out["b"]) >= {bytes([k]) for k in range(1, 9)} and bytes([9]) not in set(out["b"])


def test_estimates_are_corrected_for_chance():
    draw = np.random.default_rng(1)
    a = draw.integers(0, 2**63, 4000, dtype=np.uint64)
    b = np.concatenate([a[:3000], draw.integers(0, 2**63, 1000, dtype=np.uint64)])
    one, other = (near_dedup.packed(near_dedup.minima(np.unique(x))) for x in (a, b))
    assert abs(near_dedup._estimates(one, other[None, :])[0] - 0.6) < 0.15


def test_odd_rows(odd_documents):
    got = near_dedup.classes(odd_documents)
    assert got.count() == odd_documents.count()
    by_id = {(r.doc_id, r.n_shingles): r for r in got.collect()}
    assert by_id[(1, 0)].kept and by_id[(2, 0)].kept and by_id[(3, 0)].kept
    assert by_id[(7, by_id[(6, r)].n_shingles)].component_id == 6 if (r := max(n for d, n in by_id if d == 6)) else True
    kept = near_dedup.keep(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 4, 5, 6, 8]
    assert sum(r.doc_id is None for r in kept.collect()) == 2
    assert near_dedup.keep(odd_documents.limit(0)).count() == 0


def roots_of(links):
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("hub_links, held", [(10_000, 1 << 20), (5, 1 << 20), (5, 3)])
def test_components_of_chains_stars_and_nothing(spark, monkeypatch, hub_links, held):
    monkeypatch.setattr(components, "HUB_LINKS", hub_links)
    draw = random.Random(1)
    links = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(2000, 2000)]
    links += [(1500, 3000 + k) for k in range(90)] + [(3050, 1100)]  # a hub that hangs on another one
    links += [(draw.randrange(5000, 5400), draw.randrange(5000, 5400)) for _ in range(260)]
    df = spark.createDataFrame(links, "a bigint, b bigint").repartition(7)
    found = components.components(df).collect()
    assert {r.node: r.root for r in found} == roots_of([x for x in links if x[0] != x[1]])
    assert len({r.node for r in found}) == len(found)
    assert components.components(df.limit(0)).count() == 0


def test_a_task_that_holds_few_nodes_keeps_what_hangs_together(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(components, "HELD_NODES", 3)
    draw = random.Random(2)
    links = sorted({(min(x), max(x)) for x in ((draw.randrange(60), draw.randrange(60)) for _ in range(70)) if x[0] != x[1]})
    links += [(5, k) for k in range(100, 130)]
    both = sorted([(a, 0, b) for a, b in links] + [(b, 0, a) for a, b in links])
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*both)], ["u", "spread", "v"])
    out = [r for made in components._round(iter([batch])) for r in made.to_pylist()]
    assert roots_of([(r["u"], r["v"]) for r in out]) == roots_of(links)
    assert sorted(r["u"] for r in out if r["home"]) == sorted({x for link in links for x in link})
