"""Cross-tokenizer alignment: how often tokens of two vocabularies meet, counted by minimal perfect hashes.

A text's tokens of both tokenizers cut the same bytes. Where tokens of both end, a group ends; every
byte range between two neighbouring ends is a link of one token of A with one of B.

1. First pass: blocks of documents (``BLOCK_BYTES`` of text, or one longer text) are tokenized and
   aligned. A block leaves its token ids and, for each bucket of the pair space, its distinct
   pairs with their counts; so a frequent pair is one entry a block, not one a link.
2. A bucket holds the pairs of every n-th B id, at most ``BUCKET_PAIRS`` pairs by the sizes of the
   vocabularies, whatever the corpus. Its distinct pairs are united in a tree over lanes of
   ``LANE_BLOCKS`` blocks, and a minimal perfect hash is built: levels of bits, a pair's place is
   the rank of the first level's bit that no other pair shares.
3. Every lane adds its blocks' counts to a dense vector indexed by the hash; each place holds its pair,
   which verifies the lookup. Vectors are summed in a tree, and the highest count of each B id
   (all of whose pairs lie in one bucket) marks its best pairs.
4. The buckets answer the blocks' pairs, lane by lane. Second pass: each block aligns its
   documents anew and looks its links up in its answers.

Defined results: a text that is NULL or empty, or whose token bytes in A or B are not a space and
the text, has no tokens, all its numbers are 0 and its digest is the empty string; NULL and repeated
ids and repeated rows are documents of their own; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillwater.llm.common import cut
from tillwater.llm.tokens import Encoder, vocabulary

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20
#: Pairs that a bucket can hold at most (8 bytes each in the tables of a bucket, a few times over).
BUCKET_PAIRS = 1 << 23
#: Blocks whose counts one task adds up, and vectors that one task sums.
LANE_BLOCKS, FAN_IN = 512, 16
#: Bits of a hash's level for each pair that is still without a place.
GAMMA = 2
DOCUMENTS = -1


# --- tokens and their bytes ---------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers of a Python worker, and the bytes of their tokens."""

    _made: dict[tuple[str, str], "Pair"] = {}

    @classmethod
    def shared(cls, a_path: str, b_path: str) -> "Pair":
        if (a_path, b_path) not in cls._made:
            cls._made[a_path, b_path] = cls(a_path, b_path)
        return cls._made[a_path, b_path]

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Encoder.shared(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters, entries = _byte_letters(), Tokenizer.from_file(a_path).get_vocab()
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, at in entries.items():
            self.a_bytes[at] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.b_bytes = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))

    def _piece(self, at: int) -> bytes:
        piece = self.b.id_to_piece(at)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(at) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> tuple[list, list]:
        """Ids by A and by B of each text; none where the token bytes are not a space and the text."""
        a_ids, b_ids = [], self.b.encode([t or "" for t in texts], num_threads=1)
        for k, text in enumerate(texts):
            found = self.a.ids(" " + text) if text else []
            if text:
                want = (" " + text).encode()
                joined = (b"".join(map(t.__getitem__, ids)) for t, ids in ((self.a_bytes, found), (self.b_bytes, b_ids[k])))
                if any(x != want for x in joined):
                    found = []
            a_ids.append(found)
            if not len(found):
                b_ids[k] = []
        return a_ids, b_ids


class Space:
    """The pair space of two vocabularies, dealt to buckets by B id: no bucket depends on the corpus."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a = n_a
        self.buckets = -(-n_a * n_b // BUCKET_PAIRS)
        self.rows = -(-n_b // self.buckets)
        self.span = self.rows * n_a

    def keys(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A pair's number; the bucket is its quotient by ``span``, and the B id's row in it that of the rest by ``n_a``."""
        return ((b % self.buckets) * self.rows + b // self.buckets) * self.n_a + a


class Links:
    """The alignment of a block: one entry per link, by the last byte of its range."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a, self.b = a, b
        self.a_last, self.b_last = np.cumsum(a_lengths[a]) - 1, np.cumsum(b_lengths[b]) - 1
        size = int(self.a_last[-1]) + 1 if len(a) else 0
        a_ends, b_ends = np.zeros(size, bool), np.zeros(size, bool)
        a_ends[self.a_last], b_ends[self.b_last] = True, True
        self.at = np.flatnonzero(a_ends | b_ends)
        both = a_ends & b_ends
        #: Whether a link is its group's last, and the group of each byte.
        self.closes = both[self.at]
        self.group = np.cumsum(both, dtype=np.int32) - both
        self.of_a = a[(np.cumsum(a_ends, dtype=np.int32) - a_ends)[self.at]]
        self.of_b = b[(np.cumsum(b_ends, dtype=np.int32) - b_ends)[self.at]]


# --- a minimal perfect hash ---------------------------------------------------------------------


def _placed(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (keys ^ np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Places 0 to n - 1 for n distinct keys, from levels of bits; other keys get any place or -1."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.ranks = np.cumsum(bits, dtype=np.int64) - 1

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, levels, left = [], [], keys.astype(np.uint64)
        while len(left):
            size = max(64, GAMMA * len(left))
            places = _placed(left, len(sizes), size)
            alone = np.bincount(places, minlength=size)[places] == 1
            bits = np.zeros(size, bool)
            bits[places[alone]] = True
            sizes.append(size), levels.append(bits)
            left = left[~alone]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def places(self, keys: np.ndarray) -> np.ndarray:
        keys, found, start = keys.astype(np.uint64), np.full(len(keys), -1, np.int64), 0
        open_keys = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = start + _placed(keys[open_keys], level, size)
            hit = self.bits[at]
            found[open_keys[hit]] = self.ranks[at[hit]]
            open_keys, start = open_keys[~hit], start + size
        return found

    def to_bytes(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], "<i8").tobytes() + np.packbits(self.bits).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "PerfectHash":
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8).tolist()
        packed = np.frombuffer(data, np.uint8, offset=8 * (n + 1))
        return cls(sizes, np.unpackbits(packed, count=sum(sizes)).astype(bool))


# --- tables of a task ---------------------------------------------------------------------------


def _pack(numbers: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(numbers.astype(kind).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind).astype(np.int64)


def _id_kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _made(schema: pa.Schema, columns: dict[str, list]) -> pa.Table:
    return pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``BLOCK_BYTES`` of text."""
    start, size = 0, 0
    for k, text in enumerate(batch.column("text")):
        more = len(text.as_buffer()) if text.is_valid else 0
        if k > start and size + more > BLOCK_BYTES:
            yield batch.slice(start, k - start)
            start, size = k, 0
        size += more
    if batch.num_rows > start:
        yield batch.slice(start)


def _first_pass(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """Per block: a row with its documents' ids and tokens, and a row with its pairs for each bucket that has some."""
    pair, n, schema = Pair.shared(a_path, b_path), 0, None
    space = Space(len(pair.a_bytes), len(pair.b_bytes))
    kinds = _id_kind(len(pair.a_bytes)), _id_kind(len(pair.b_bytes))
    for batch in batches:
        for some in _blocks(batch):
            name, n = f"{TaskContext.get().partitionId()}-{n}", n + 1
            a_ids, b_ids = pair.encode(some.column("text").to_pylist())
            a, b = (np.concatenate([np.asarray(x, np.int64) for x in [[], *ids]]) for ids in (a_ids, b_ids))
            a, b = a.astype(np.int64), b.astype(np.int64)
            links = Links(a, b, pair.a_lengths, pair.b_lengths)
            keys, counts = np.unique(space.keys(links.of_a, links.of_b), return_counts=True)
            edges = np.searchsorted(keys, np.arange(space.buckets + 1) * space.span)
            used = np.flatnonzero(np.diff(edges))
            pairs = [
                (_pack(np.diff(keys[i:j], prepend=k * space.span), "<u4"), _pack(counts[i:j], "<u4"))
                for k, i, j in zip(used, edges[used], edges[used + 1])
            ]
            none, longs = [None] * len(used), pa.list_(pa.int32())
            ids = pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), some.column("doc_id"))
            schema = schema or pa.list_(some.schema.field("doc_id").type)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (len(used) + 1)), pa.array([DOCUMENTS, *used.tolist()], pa.int32()),
                    pa.concat_arrays([ids.cast(schema), pa.nulls(len(used), schema)]),
                    pa.array([[len(x) for x in a_ids], *none], longs), pa.array([[len(x) for x in b_ids], *none], longs),
                    pa.array([_pack(a, kinds[0]), *none], pa.binary()), pa.array([_pack(b, kinds[1]), *none], pa.binary()),
                    pa.array([None, *[x for x, _ in pairs]], pa.binary()), pa.array([None, *[x for _, x in pairs]], pa.binary()),
                ],
                ["block", "bucket", "ids", "n_a", "n_b", "a", "b", "keys", "counts"],
            )


def _united(rows: pa.Table) -> np.ndarray:
    """The distinct pairs of all rows, as numbers within their bucket."""
    found = np.zeros(0, np.int64)
    for data in rows.column("keys").to_pylist():
        found = np.union1d(found, np.cumsum(_unpack(data, "<u4")))
    return found


_KEYS = pa.schema([("bucket", pa.int32()), ("lane", pa.int32()), ("keys", pa.binary())])
_HASHES = pa.schema([("bucket", pa.int32()), ("hash", pa.binary()), ("pairs", pa.binary())])
_VECTORS = pa.schema([("bucket", pa.int32()), ("lane", pa.int32()), ("vector", pa.binary())])
_TABLES = pa.schema([*_HASHES, ("vector", pa.binary()), ("best", pa.binary())])
_ANSWERS = pa.schema(
    [("block", pa.string()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())]
)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _unite(key: tuple, rows: pa.Table) -> pa.Table:
    bucket, lane = (k.as_py() for k in key)
    packed = _pack(np.diff(_united(rows), prepend=0), "<u4")
    return _made(_KEYS, {"bucket": [bucket], "lane": [lane], "keys": [packed]})


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    keys = _united(rows)
    made = PerfectHash.build(keys)
    placed = np.empty_like(keys)
    placed[made.places(keys)] = keys
    return _made(_HASHES, {"bucket": [key[0].as_py()], "hash": [made.to_bytes()], "pairs": [placed.astype("<u4").tobytes()]})


def _looked_up(made: PerfectHash, pairs: np.ndarray, keys: np.ndarray) -> np.ndarray:
    places = made.places(keys)
    if (places < 0).any() or (pairs[places] != keys).any():
        raise AssertionError("a pair that the hash was not built from")
    return places


def _opened(table: pa.Table) -> tuple[PerfectHash, np.ndarray]:
    row = table.slice(0, 1).to_pylist()[0]
    return PerfectHash.from_bytes(row["hash"]), np.frombuffer(row["pairs"], "<u4")


def _count(key: tuple, rows: pa.Table, hashes: pa.Table) -> pa.Table:
    """A lane's counts as a dense vector in the order of the hash."""
    if not rows.num_rows:
        return _VECTORS.empty_table()
    made, pairs = _opened(hashes)
    total = np.zeros(len(pairs), np.int64)
    for data, counts in zip(rows.column("keys").to_pylist(), rows.column("counts").to_pylist()):
        total[_looked_up(made, pairs, np.cumsum(_unpack(data, "<u4")))] += _unpack(counts, "<u4")
    bucket, lane = (k.as_py() for k in key)
    return _made(_VECTORS, {"bucket": [bucket], "lane": [lane], "vector": [_pack(total, "<i8")]})


def _total(rows: pa.Table) -> np.ndarray:
    return sum(_unpack(data, "<i8") for data in rows.column("vector").to_pylist())


def _add(key: tuple, rows: pa.Table) -> pa.Table:
    bucket, lane = (k.as_py() for k in key)
    return _made(_VECTORS, {"bucket": [bucket], "lane": [lane], "vector": [_pack(_total(rows), "<i8")]})


def _finish(key: tuple, hashes: pa.Table, vectors: pa.Table, n_a: int) -> pa.Table:
    """A bucket's hash, pairs and counts, and which pairs have the highest count of their B id."""
    row, total = hashes.to_pylist()[0], _total(vectors)
    b_row = np.frombuffer(row["pairs"], "<u4") // n_a
    highest = np.zeros(int(b_row.max()) + 1, np.int64)
    np.maximum.at(highest, b_row, total)
    best = np.packbits(total == highest[b_row])
    return _made(_TABLES, {**{k: [v] for k, v in row.items()}, "vector": [_pack(total, "<i8")], "best": [best.tobytes()]})


def _answer(key: tuple, rows: pa.Table, tables: pa.Table) -> pa.Table:
    """For each block of the lane, its pairs of this bucket with their counts in the corpus."""
    if not rows.num_rows:
        return _ANSWERS.empty_table()
    (made, pairs), row = _opened(tables), tables.slice(0, 1).to_pylist()[0]
    vector, best = _unpack(row["vector"], "<i8"), np.unpackbits(np.frombuffer(row["best"], np.uint8))
    counts, flags, asked = [], [], rows.column("keys").to_pylist()
    for data in asked:
        places = _looked_up(made, pairs, np.cumsum(_unpack(data, "<u4")))
        counts.append(_pack(vector[places], "<i8"))
        flags.append(np.packbits(best[places]).tobytes())
    blocks = rows.column("block").to_pylist()
    return _made(_ANSWERS, {
        "block": blocks, "bucket": rows.column("bucket").to_pylist(), "keys": asked, "counts": counts, "best": flags
    })


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of the numbers below ``size``, one row each, and how many there are."""
    texts = [str(k).encode() for k in range(size)]
    width = max(map(len, texts))
    table = np.frombuffer(b"".join(t.ljust(width + 1, b"\0") for t in texts), np.uint8).reshape(size, width + 1)
    return table, np.array([len(t) for t in texts])


def _group_texts(links: Links, n_a: np.ndarray, n_b: np.ndarray, digits: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each document, with ids in order."""
    ga, gb = links.group[links.a_last], links.group[links.b_last]
    groups = int(ga[-1]) + 1 if len(ga) else 0
    a_ends, b_ends = np.cumsum(np.bincount(ga, minlength=groups)), np.cumsum(np.bincount(gb, minlength=groups))
    a_place = np.arange(len(ga)) + np.concatenate([[0], b_ends])[ga]
    b_place = np.arange(len(gb)) + a_ends[gb]
    ids, signs = np.empty(len(ga) + len(gb), np.int64), np.empty(len(ga) + len(gb), np.uint8)
    ids[a_place], ids[b_place] = links.a, links.b
    last = lambda g: np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool)
    signs[a_place] = np.where(last(ga), ord("|"), ord(","))
    signs[b_place] = np.where(last(gb), ord(";"), ord(","))
    tokens = np.cumsum(n_a + n_b)
    signs[tokens[n_a > 0] - 1] = 0  # nothing follows a document's last token
    table, lengths = digits
    letters, used = table[ids], lengths[ids]
    letters[np.arange(len(ids)), used] = signs
    used = used + (signs > 0)
    text = letters[np.arange(letters.shape[1]) < used[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(used)])[np.concatenate([[0], tokens])]
    return [text[i:j] for i, j in zip(ends, ends[1:])]


def _second_pass(key: tuple, docs: pa.Table, answers: pa.Table, a_path: str, b_path: str, schema: pa.Schema) -> pa.Table:
    pair = Pair.shared(a_path, b_path)
    space = Space(len(pair.a_bytes), len(pair.b_bytes))
    block = docs.select(["n_a", "n_b", "a", "b"]).to_pylist()[0]
    n_a, n_b = (np.array(block[c], np.int64) for c in ("n_a", "n_b"))
    a, b = (_unpack(block[c], _id_kind(len(t))) for c, t in (("a", pair.a_bytes), ("b", pair.b_bytes)))
    links = Links(a, b, pair.a_lengths, pair.b_lengths)

    told = sorted(answers.select(["bucket", "keys", "counts", "best"]).to_pylist(), key=lambda r: r["bucket"])
    keys = [np.cumsum(_unpack(r["keys"], "<u4")) for r in told]
    flags = [np.unpackbits(np.frombuffer(r["best"], np.uint8), count=len(k)) for r, k in zip(told, keys)]
    known = np.concatenate([np.zeros(0, np.int64), *[k + r["bucket"] * space.span for r, k in zip(told, keys)]])
    counts = np.concatenate([np.zeros(0, np.int64), *[_unpack(r["counts"], "<i8") for r in told]])
    places = np.searchsorted(known, space.keys(links.of_a, links.of_b))
    sums = np.concatenate([[0], np.cumsum(counts[places])])
    bests = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.uint8), *flags])[places], dtype=np.int64)])
    closed = np.concatenate([[0], np.cumsum(links.closes, dtype=np.int64)])

    tokens = np.concatenate([[0], np.cumsum(n_a)])
    sizes = np.concatenate([[0], links.a_last + 1])[tokens]
    edges = np.searchsorted(links.at, sizes)  # links of document k: edges[k] to edges[k + 1]
    per_document = lambda x: x[edges[1:]] - x[edges[:-1]]
    cls = type(pair)
    if not hasattr(cls, "digits"):
        cls.digits = _digits(max(len(pair.a_bytes), len(pair.b_bytes)))
    texts = _group_texts(links, n_a, n_b, cls.digits)
    columns = {
        "n_a": n_a, "n_b": n_b, "n_groups": per_document(closed), "n_links": np.diff(edges),
        "n_best": per_document(bests), "count_sum": per_document(sums),
        "groups_sha256": [hashlib.sha256(t).hexdigest() if t else "" for t in texts],
    }
    ids = docs.column("ids").combine_chunks().flatten()
    return pa.table([ids, *[pa.array(columns[f.name], f.type) for f in list(schema)[1:]]], schema=schema)


# --- the whole ----------------------------------------------------------------------------------


def _treed(df: DataFrame, lanes: int, combine, schema: pa.Schema) -> DataFrame:
    """``df`` with at most ``FAN_IN`` lanes a bucket, combined level by level."""
    while lanes > FAN_IN:
        lanes = -(-lanes // FAN_IN)
        df = df.withColumn("lane", F.floor(F.col("lane") / FAN_IN).cast("int")).groupBy("bucket", "lane").applyInArrow(
            combine, _ddl(schema)
        )
    return df


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row of ``docs``."""
    a_path, b_path = a_path or vocabulary(A_FILE), b_path or vocabulary(B_FILE)
    pair = Pair.shared(a_path, b_path)
    n_a, kind = len(pair.a_bytes), docs.schema["doc_id"].dataType.simpleString()
    first = cut(
        docs.select("doc_id", "text").mapInArrow(
            lambda batches: _first_pass(batches, a_path, b_path),
            f"block string, bucket int, ids array<{kind}>, n_a array<int>, n_b array<int>, a binary, b binary, "
            "keys binary, counts binary",
        )
    )
    blocks = first.where(F.col("bucket") == DOCUMENTS).count()
    lanes = max(1, -(-blocks // LANE_BLOCKS))
    pairs = first.where(F.col("bucket") != DOCUMENTS).select(
        "bucket", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int").alias("lane"), "block", "keys", "counts"
    )
    each_lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")

    keys = pairs.select("bucket", "lane", "keys")
    if lanes > 1:
        keys = _treed(keys.groupBy("bucket", "lane").applyInArrow(_unite, _ddl(_KEYS)), lanes, _unite, _KEYS)
    hashes = cut(keys.groupBy("bucket").applyInArrow(_build, _ddl(_HASHES)))

    spread = hashes.select("*", each_lane)
    vectors = pairs.groupBy("bucket", "lane").cogroup(spread.groupBy("bucket", "lane")).applyInArrow(_count, _ddl(_VECTORS))
    vectors = _treed(vectors, lanes, _add, _VECTORS)
    tables = cut(
        hashes.groupBy("bucket").cogroup(vectors.groupBy("bucket")).applyInArrow(
            lambda key, left, right: _finish(key, left, right, n_a), _ddl(_TABLES)
        )
    )
    answers = pairs.groupBy("bucket", "lane").cogroup(tables.select("*", each_lane).groupBy("bucket", "lane")).applyInArrow(
        _answer, _ddl(_ANSWERS)
    )
    told = first.where(F.col("bucket") == DOCUMENTS).select("block", "ids", "n_a", "n_b", "a", "b")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    out = f"doc_id {kind}, {', '.join(f'{n} bigint' for n in names)}, groups_sha256 string"
    schema = pa.schema([
        ("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)), *[(n, pa.int64()) for n in names], ("groups_sha256", pa.string())
    ])
    return told.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda key, left, right: _second_pass(key, left, right, a_path, b_path, schema), out
    )
