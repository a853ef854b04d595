"""Sharding, mixing and packing: laws, quotas and round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwater.llm import mixing, packing, sharding, tokens


def many(documents, n=600, hot="a"):
    draw = random.Random(5)
    rows = []
    for k in range(n):
        source = hot if k % 3 == 0 else draw.choice(["b", "c", "d", None])
        rows.append((k, " ".join(f"w{draw.randrange(99)}" for _ in range(draw.randrange(0, 60))), source))
    return documents(*rows)


# --- sharding


def placed(docs):
    weight = sharding.slot_bytes(docs)
    shard_map = sharding.rebalance(sharding.first_map(), weight, sharding.SHARDS)
    rows = docs.sparkSession.createDataFrame(list(enumerate(shard_map)), "vslot int, shard int")
    return sharding.place(docs, rows).collect()


def test_shards_weigh_the_same_and_places_are_gapless(documents):
    docs = many(documents)
    rows = placed(docs)
    load, places = Counter(), defaultdict(list)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert len(rows) == 600 and len(load) == 24
    assert max(load.values()) - min(load.values()) <= 400
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_odd_rows_have_a_place_each(odd_documents):
    rows = placed(odd_documents)
    assert len(rows) == odd_documents.count()
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert sorted(r.size for r in rows)[0] == 8
    assert placed(odd_documents.limit(0)) == []


def test_growing_moves_slots_only_into_the_new_shard():
    weight = [random.Random(k).randrange(1, 100) for k in range(sharding.SLOTS)]
    now = sharding.rebalance(sharding.first_map(), weight, 24)
    grown = sharding.grow(now, weight, 24)
    assert all(b in (a, 24) for a, b in zip(now, grown)) and 24 in grown
    moved = sum(w for w, b in zip(weight, grown) if b == 24)
    assert abs(moved - sum(weight) / 25) < sum(weight) * 0.01


def test_maps_have_versions(spark, tmp_path):
    first, second = sharding.first_map(), [0] * sharding.SLOTS
    sharding.write_map(spark, first, 1, f"{tmp_path}/map")
    sharding.write_map(spark, second, 2, f"{tmp_path}/map")
    assert {r.shard for r in sharding.read_map(spark, f"{tmp_path}/map").collect()} == {0}
    old = {r.vslot: r.shard for r in sharding.read_map(spark, f"{tmp_path}/map", 1).collect()}
    assert old == dict(enumerate(first))


# --- mixing


def water_level(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full = {}
    while len(full) < len(names):
        free = [s for s in names if s not in full]
        share = (1.5 * sum(sizes.values()) - sum(full.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * share > 2 * sizes[s]]
        if not over:
            return {s: full.get(s, weight[s] * share) for s in names}
        full |= {s: 2 * sizes[s] for s in over}
    return full


def test_targets_and_takings(documents):
    docs = many(documents)
    rows = mixing.taken(docs).collect()
    sizes, got, target = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r.size
        got[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size
    want = water_level(sizes)
    assert len(rows) == 600 and all(abs(target[s] - want[s]) < 1e-6 for s in want)
    assert all(abs(got[s] - want[s]) <= 30 for s in want)
    assert sorted((r.doc_id, r.taken) for r in mixing.taken(docs.repartition(5)).collect()) == sorted(
        (r.doc_id, r.taken) for r in rows
    )


def test_the_quota_goes_on_after_a_document_that_does_not_fit(documents):
    draw = random.Random(3)
    rows = [(k, " ".join(["w"] * draw.randrange(1, 30)), "long") for k in range(400)]
    rows += [(1000, " ".join(["w"] * 4000), "long"), *((2000 + k, f"w w w w {k}", "other") for k in range(9000))]
    rows += [(None, f"no id {k}", "nulls") for k in range(3000)]
    got, target = Counter(), {}
    for r in mixing.taken(documents(*rows)).collect():
        got[r.source] += r.taken
        target[r.source] = r.target
    assert all(0 <= target[s] - got[s] < 30 for s in target), (got, target)


def test_the_mix_holds_each_row_as_often_as_taken(documents):
    docs = many(documents)
    times = {r.doc_id: r.taken // r.size for r in mixing.taken(docs).collect() if r.size}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.collect())
    assert all(got[k] == n for k, n in times.items())


def test_rows_of_a_shard_lie_together(documents):
    docs = many(documents)
    rows = mixing.taken(docs, shards=4).collect()
    assert all(r.taken == r.size * len(r.shards) for r in rows)
    want = {s: Counter(r.doc_id for r in rows for x in r.shards if x == s) for s in range(4)}
    laid = mixing.mixed(docs, shards=4).withColumn("part", F.spark_partition_id()).collect()
    ranges = -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    got = {s: Counter(r.doc_id for r in laid if r.part // ranges == s) for s in range(4)}
    assert got == want and all(want.values())


def test_the_splitting_tree_keeps_quotas():
    quotas, sizes = np.array([50, 0, 7, 300]), mixing._even(357, 11)
    made = mixing.splitting_tree(quotas, sizes, 1)
    assert (made.sum(axis=0) == quotas).all() and (made.sum(axis=1) == sizes).all() and (made >= 0).all()


def test_blocks_are_dealt_evenly(spark):
    blocks = spark.createDataFrame([(s, b, c) for s in ("x", "y", None) for b in range(40) for c in (1, 2)], "source string, block int, copy int")
    dealt = mixing.block_shards(blocks, shards=8).collect()
    assert len(dealt) == 240 and set(Counter(r.shard for r in dealt).values()) == {30}


def test_mixing_odd_rows(odd_documents):
    rows = mixing.taken(odd_documents).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mixed(odd_documents).columns == odd_documents.columns
    assert mixing.taken(odd_documents.limit(0)).count() == 0 and mixing.mixed(odd_documents.limit(0)).count() == 0


# --- packing


def test_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    encoder, plain = tokens.Encoder(tokens.vocabulary()), Tokenizer.from_file(tokens.vocabulary())
    plain.encode_special_tokens = True
    texts = ["", " ", "a  b\n\n c\t", "Ünï çödé ß", "日本語 и русский 👍🏽", "don't <|endoftext|> 12345 --- ", "\x00\x85 x", "é ǅ"]
    for text in texts:
        assert list(encoder.ids(text)) == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("capacity, groups", [(64, 6), (64, 2), (2048, 48)])
@pytest.mark.parametrize("share", [0.5, 0.4, 0.125])
def test_plans_place_every_piece_once(capacity, groups, share):
    draw = random.Random(9)
    counts = Counter(draw.choice([capacity, draw.randrange(1, capacity), draw.randrange(1, capacity // 4)]) for _ in range(3000))
    made = packing.grouped_plan(dict(counts), capacity, groups, share)
    used, ranks = defaultdict(list), defaultdict(list)
    for length, first, count, sequence, offset in made.places:
        ranks[length].append((first, count))
        for k in range(count):
            used[sequence + k].append((offset, length))
    for length, runs in ranks.items():
        assert sorted(runs)[0][0] == 0 and sum(n for _, n in runs) == counts[length]
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(runs), sorted(runs)[1:]))
    for pieces in used.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(used) == made.sequences
    best = packing.plan(dict(counts), capacity, groups)
    assert best.sequences <= made.sequences
    assert best.sequences <= 1.02 * sum(k * n for k, n in counts.items()) / capacity + 2


def test_packed_pieces_read_back(documents, odd_documents):
    docs = many(documents, 200).union(odd_documents.select("doc_id", "text", "lang", "source", "n_chars"))
    rows = packing.pack(docs, capacity=128).collect()
    encoder = tokens.Encoder(tokens.vocabulary())
    want = Counter()
    for r in docs.collect():
        ids = np.array([*encoder.ids(r.text or ""), 0], "<u4")
        first = len(ids) % 128 or min(128, len(ids))
        starts = [0, *range(first, len(ids), 128)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[(r.doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for pieces in filled.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 128
    assert packing.pack(docs.limit(0)).count() == 0


def test_configurations_of_large_pieces_carry_the_plan():
    draw = random.Random(9)
    counts = Counter(min(2047, max(20, int(draw.lognormvariate(6.4, 0.8)))) for _ in range(12_000))
    least = -(-sum(length * n for length, n in counts.items()) // 2048)
    made = packing.plan(dict(counts))
    assert made.sequences <= least * 1.003
    large, used = Counter(), Counter()
    for length, _, count, sequence, offset in made.places:
        for k in range(count):
            used[sequence + k] += length
            large[sequence + k] += length > max(packing.LARGE) * 2048
    assert max(used.values()) <= 2048 and sum(used.values()) == sum(length * n for length, n in counts.items())
    grouped = packing.grouped_plan(dict(counts), 2048, packing.GROUPS, packing.LARGE[0])
    assert grouped.sequences == made.sequences
    assert sum(n >= 2 for n in large.values()) > 0.25 * made.sequences


def test_the_last_piece_of_a_configuration_is_the_largest_that_fits():
    supply = packing._Supply({1000: [(900, 1), (1000, 2)], 1040: [(1010, 1), (1040, 1)]})
    assert supply.choose([1000, 1000], 2048) == [1000, 1040]
    for length in (1040, 1010):
        supply.take(length, 1)
    assert supply.choose([1000, 1000], 2048) == [1000, 1000]
    supply.take(1000, 2)
    assert supply.choose([1000, 1000], 2048) == []
