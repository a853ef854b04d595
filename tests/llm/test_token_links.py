"""Cross-tokenizer alignment against a plain walk over byte ranges; the hash; lanes and odd rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tillwater.llm import token_links
from tillwater.llm.tokens import vocabulary

NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def ranges(ids, table):
    at, out = 0, []
    for i in ids:
        out.append((i, at, at + len(table[i])))
        at += len(table[i])
    return out


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    letters = token_links._byte_letters()
    a_table = {i: bytes(letters[c] for c in e) for e, i in a.get_vocab().items() if all(c in letters for c in e)}
    b_table = [
        bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()
        for k in range(b.get_piece_size())
    ]
    found = []
    for _, text in rows:
        want = (" " + (text or "")).encode()
        one, other = a.encode(want.decode(), add_special_tokens=False).ids, b.encode(text or "")
        if not text or b"".join(a_table[i] for i in one) != want or b"".join(b_table[i] for i in other) != want:
            found.append(None)
            continue
        left, right = ranges(one, a_table), ranges(other, b_table)
        links = [(i, j) for i, s, e in left for j, t, f in right if s < f and t < e]
        ends = sorted({e for _, _, e in left} & {e for _, _, e in right})
        groups, start = [], 0
        for end in ends:
            inside = [",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (left, right)]
            groups.append("|".join(inside))
            start = end
        found.append((len(one), len(other), len(ends), links, ";".join(groups)))
    counts = Counter(x for f in found if f for x in f[3])
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for (doc_id, _), f in zip(rows, found):
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links, text = f
            marked = sum(counts[x] == best[x[1]] for x in links)
            total = sum(counts[x] for x in links)
            out.append((doc_id, n_a, n_b, groups, len(links), marked, total, hashlib.sha256(text.encode()).hexdigest()))
    return out


TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "naïve café — déjà vu, señor", "日本語の文章と emoji 😀😀", "a",
    " leading space", "two  spaces and\ttabs\nand lines\r\n", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁ is not a space",
    "ﬁ ligature and ½", "zero​width", "ÅÄÖ åäö " * 20, "internationalization unbelievable antidisestablishmentarianism",
    "x" * 300, "\x00 nul", "Übergrößenträger fährt", None, "", "  ", "The quick brown fox",
]


def checked(documents, rows, partitions=3):
    got = token_links.align(documents(*rows).repartition(partitions)).collect()
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted([(r.doc_id, *[r[n] for n in NAMES]) for r in got], key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("block_bytes, lane_blocks, fan_in", [(4 << 20, 512, 16), (40, 3, 2)])
def test_alignment_equals_a_walk_over_bytes(documents, monkeypatch, block_bytes, lane_blocks, fan_in):
    monkeypatch.setattr(token_links, "LANE_BLOCKS", lane_blocks)
    monkeypatch.setattr(token_links, "FAN_IN", fan_in)
    rows = [(k, TEXTS[k % len(TEXTS)]) for k in range(2 * len(TEXTS))]
    rows += [(None, "no id at all"), (None, None), (7, "a repeated id"), (7, "a repeated id"), (7, "another text")]
    docs = documents(*rows)
    if block_bytes < 1000:  # the workers import the module anew, so small blocks come from small batches
        docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        checked(documents, rows)
    finally:
        docs.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(odd_documents):
    got = token_links.align(odd_documents).collect()
    assert len(got) == odd_documents.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[6][1:] == by_id[7][1:] and by_id[6].n_links > 60_000
    assert by_id[1][1:] == by_id[2][1:] == (0, 0, 0, 0, 0, 0, "")
    assert token_links.align(odd_documents.limit(0)).count() == 0


def test_places_are_minimal_perfect():
    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 60_000):
        keys = np.unique(draw.integers(0, 1 << 31, n))
        made = token_links.PerfectHash.from_bytes(token_links.PerfectHash.build(keys).to_bytes())
        assert sorted(made.places(keys)) == list(range(len(keys)))
        if n == 1000:
            other = np.setdiff1d(np.arange(5000), keys)
            places, table = made.places(other), np.empty(len(keys), np.int64)
            table[made.places(keys)] = keys
            assert ((places == -1) | (table[places] != other)).all()  # the stored key tells
            with pytest.raises(AssertionError):
                token_links._looked_up(made, table, other[:10])


def test_a_bucket_is_bounded_by_the_vocabularies():
    space = token_links.Space(50_257, 32_000)
    assert space.buckets * space.rows >= 32_000 and space.span < 1 << 24
    a, b = np.meshgrid(np.array([0, 50_256]), np.arange(32_000))
    keys = space.keys(a.ravel(), b.ravel())
    assert len(np.unique(keys)) == 64_000 and keys.max() < space.buckets * space.span
    assert (keys // space.span == b.ravel() % space.buckets).all()
