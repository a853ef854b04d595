"""Vector code compression: product codes of whole-number vectors, with exact products by limb-split GEMM.

Every component x becomes ``floor(SCALE * x)``, a vector is cut into ``PARTS`` consecutive parts, and
each part is replaced by the index of its codebook's nearest entry. A part's squared distances to
all entries are ``|x|^2 - 2 x.c + |c|^2``; the products ``x.c`` come from float64 BLAS. So that these
are exact, whole numbers are broken into limbs small enough that a product of two limb matrices
stays below 2^53 (:func:`exact_products`); the limbs' products are put together again in int64, and
the first smallest distance wins.

A codebook starts as the parts of the ``ENTRIES`` smallest ids; each of ``ROUNDS`` rounds assigns all
parts and moves each entry to the componentwise ``floor(sum / count)`` of its parts. Every task sums its
parts by entry, so a round shuffles one small row per task, part, entry and component, and the
driver holds codebooks only: ``ENTRIES`` vectors, whatever the table's size.

Defined results: rows whose vector is NULL, empty, or holds NULL or a non-finite component take no
part, nor do vectors of another length than that of the smallest id that takes part; repeated ids and
rows are rows of their own; NULL ids sort last, and equal ids by their vectors; a length that
``PARTS`` does not divide gives parts that differ by one; an empty table gives no rows; extra columns are
ignored. Distances are 64-bit whole numbers, so a component of 2^20 or more raises an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut
from tillwater.operators.keys import lookup_join

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Whole numbers of vectors that are worked on at once.
CELLS = 1 << 20
#: Whole numbers below this keep squared distances of long vectors within 64 bits.
LARGEST = 1 << 28
#: Bits of a whole number that float64 holds.
EXACT_BITS = 53


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def whole(vectors: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * vectors.astype(np.float64))
    if np.abs(scaled).max(initial=0) >= LARGEST:
        raise ValueError(f"a component of {LARGEST // SCALE} or more")
    return scaled.astype(np.int64)


def _limbs(numbers: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 matrices with ``numbers = sum(limb[k] << bits * k)``; all but the last limb are not negative."""
    limbs = []
    while np.abs(numbers).max(initial=0) >> bits:
        limbs.append((numbers & ((1 << bits) - 1)).astype(np.float64))
        numbers = numbers >> bits
    return [*limbs, numbers.astype(np.float64)]


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of int64 matrices, exact where the result fits int64, by float64 BLAS on limbs."""
    bits = (EXACT_BITS - max(1, left.shape[1]).bit_length()) // 2
    total = np.zeros((len(left), len(right)), np.int64)
    right_limbs = _limbs(right, bits)
    for i, one in enumerate(_limbs(left, bits)):
        for j, other in enumerate(right_limbs):
            total += (one @ other.T).astype(np.int64) << (bits * (i + j))
    return total


def bounds(length: int) -> list[int]:
    """Where the parts of a vector begin and end."""
    short, longer = divmod(length, PARTS)
    return [k * short + min(k, longer) for k in range(PARTS + 1)]


def nearest(vectors: np.ndarray, codebooks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per row and part, the first nearest entry and its squared distance."""
    ends = bounds(vectors.shape[1])
    codes = np.empty((len(vectors), PARTS), np.int64)
    errors = np.empty((len(vectors), PARTS), np.int64)
    for p, entries in enumerate(codebooks):
        x = vectors[:, ends[p] : ends[p + 1]]
        far = (entries * entries).sum(axis=1) - 2 * exact_products(x, entries)
        codes[:, p] = far.argmin(axis=1)
        errors[:, p] = far[np.arange(len(x)), codes[:, p]] + (x * x).sum(axis=1)
    return codes, errors


def _blocks(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The vectors of a batch as whole numbers, ``CELLS`` at a time, with the rows they come from."""
    step = max(1, CELLS // length)
    for start in range(0, batch.num_rows, step):
        some = batch.column("vector").slice(start, step)
        yield start, start + len(some), whole(some.flatten().to_numpy().reshape(len(some), length))


def _summed(batches: Iterator[pa.RecordBatch], length: int, codebooks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row per part and entry that has rows: how many, and the sums of their components."""
    ends = bounds(length)
    sums, counts = [np.zeros_like(entries) for entries in codebooks], np.zeros((PARTS, len(codebooks[0])), np.int64)
    for batch in batches:
        for _, _, vectors in _blocks(batch, length):
            codes, _ = nearest(vectors, codebooks)
            for p in range(PARTS):
                np.add.at(sums[p], codes[:, p], vectors[:, ends[p] : ends[p + 1]])
                counts[p] += np.bincount(codes[:, p], minlength=counts.shape[1])
    parts, entries = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(parts, pa.int32()), pa.array(entries, pa.int32()), pa.array(counts[parts, entries], pa.int64()),
            pa.array([sums[p][e] for p, e in zip(parts, entries)], pa.list_(pa.int64())),
        ],
        ["part", "entry", "n", "sums"],
    )


def _moved(vectors: DataFrame, length: int, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after a round; entries that no part chose stay."""
    schema = "part int, entry int, n bigint, sums array<bigint>"
    told = vectors.mapInArrow(lambda batches: _summed(batches, length, codebooks), schema)
    each = told.select("part", "entry", "n", F.posexplode_outer("sums").alias("at", "sum"))
    total = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
    moved = [entries.copy() for entries in codebooks]
    for row in total.where("at IS NOT NULL").collect():  # at most ENTRIES numbers a component
        moved[row.part][row.entry, row.at] = row.sum // row.n
    return moved


def train(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[int, list[np.ndarray]]:
    """The vectors' length and one codebook per part, from a table with columns id and vector (usable ones)."""
    first = vectors.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return 0, []
    length = len(first[0].vector)
    seeds = [row.vector for row in first if len(row.vector) == length]
    if len(seeds) < len(first):  # other lengths stand among the smallest ids
        same = vectors.where(F.size("vector") == length).select("id", "vector")
        seeds = [r.vector for r in same.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()]
    start, ends = whole(np.array(seeds, np.float64)), bounds(length)
    codebooks = [start[:, a:b].copy() for a, b in zip(ends, ends[1:])]
    of_length = vectors.where(F.size("vector") == length).select("vector")
    for _ in range(rounds):
        codebooks = _moved(of_length, length, codebooks)
    return length, codebooks


def fingerprint(codebooks: list[np.ndarray]) -> str:
    """The digest of all entries by part, entry and position."""
    numbers = ",".join(str(x) for entries in codebooks for x in entries.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def _coded(batches: Iterator[pa.RecordBatch], length: int, codebooks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    digits = np.array([f"{k:02x}" for k in range(max(256, len(codebooks[0])))])
    for batch in batches:
        codes, errors = [], []
        for _, _, vectors in _blocks(batch, length):
            chosen, far = nearest(vectors, codebooks)
            codes += ["".join(row) for row in digits[chosen]]
            errors.append(far.sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), batch.column("label"), pa.array(codes, pa.string()),
                pa.array(np.concatenate(errors) if errors else [], pa.int64()),
            ],
            ["id", "label", "code", "error"],
        )


def encode(vectors: DataFrame, length: int, codebooks: list[np.ndarray]) -> DataFrame:
    """(id, label, code, error): two hex digits per part, and the squared distances summed over parts."""
    kinds = dict(vectors.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error bigint"
    if not codebooks:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = vectors.where(F.size("vector") == length).select("id", "label", "vector")
    return rows.mapInArrow(lambda batches: _coded(batches, length, codebooks), schema)


def decode(code: str, codebooks: list[np.ndarray]) -> np.ndarray:
    """The whole-number vector that a code stands for."""
    return np.concatenate([entries[int(code[2 * p : 2 * p + 2], 16)] for p, entries in enumerate(codebooks)])


def compress(table: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every usable row."""
    vectors = table.select(F.col(id).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    vectors = vectors.where(usable(F.col("vector")))
    length, codebooks = train(vectors)
    coded = cut(encode(vectors, length, codebooks))
    name = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    coded = coded.select(F.col("id").alias(id), "code", "error", name.alias("label_name"))
    sums = coded.groupBy("label_name").agg(F.sum("error").alias("label_error"))
    return lookup_join(coded, sums, ["label_name"]).select(
        id, "code", "error", "label_error", F.lit(fingerprint(codebooks)).alias("codebooks_sha256")
    )


def oracle() -> str:
    """The same in SQL: all distances of all parts to all entries, round by round."""
    size = f"len(v) // {PARTS}"
    steps = [f"""
kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT vec_id, p, list_slice(v, p * ({size}) + 1, (p + 1) * ({size})) AS x FROM kept, range({PARTS}) AS t(p)
), book0 AS (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
    WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})
)"""]
    for k in range(ROUNDS + 1):
        steps.append(f""", near{k} AS (
    SELECT vec_id, q.p AS p, any_value(x) AS x,
           min({ENTRIES} * CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) + e) AS best
    FROM parts q JOIN book{k} b ON q.p = b.p GROUP BY vec_id, q.p
)""")
        if k < ROUNDS:
            steps.append(f""", mean{k} AS (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
        SELECT p, best % {ENTRIES} AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
        FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY p, best % {ENTRIES}, i
    ) GROUP BY p, e
), book{k + 1} AS (
    SELECT b.p AS p, b.e AS e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e
)""")
    return f"""WITH {"".join(steps)}, coded AS (
    SELECT vec_id, string_agg(format('{{:02x}}', best % {ENTRIES}), '' ORDER BY p) AS code,
           CAST(sum(best // {ENTRIES}) AS BIGINT) AS error
    FROM near{ROUNDS} GROUP BY vec_id
), labelled AS (SELECT c.*, k.label AS label FROM coded c JOIN kept k ON c.vec_id = k.vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
FROM labelled
"""
