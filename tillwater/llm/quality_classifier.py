r"""Quality classifier from weak labels.

1. Overlapping heuristic labellers vote good, bad or nothing on every document (symbols, capital
   letters, repeated words, few different words, sentence ends, length, repeated lines, doubled
   marks, word length).
2. Expectation-maximisation estimates how often each labeller votes what on good and on bad
   documents, from the counts of vote patterns over all documents (at most 3 ** labellers rows,
   whatever the corpus), and gives each pattern its posterior.
3. The posteriors label a bounded sample (the ``SAMPLE_ROWS`` different rows of lowest hash), on which a
   logistic scorer over hashed tokens is trained: word shapes, repetitions, and the length.
4. The scorer rates every document: native columns, weights as one constant array.

Defined results: a NULL or empty text has its length token only; NULL ids pass through; repeated
rows are judged alike; with an empty table or a corpus on which no labeller votes bad, the
scorer still has weights, and an empty table gives no rows; extra columns are ignored by
``score`` and kept by ``keep``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import BLANKS, constants, where_late, whole_rows, words

SAMPLE_ROWS = 20_000
BUCKETS = 1 << 12
ROUNDS = 60
STEPS = 400
RIDGE = 1e-4
#: Probability of good quality from which a document is kept.
THRESHOLD = 0.4
#: Weight of what is held of the labellers beforehand, as a share of the documents: the classes have few
#: symptoms in common, and without it some labellers' classes would take in good documents.
PRIOR = 0.25
GOOD, BAD, NONE = "g", "b", "-"


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(NONE))


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern)) - 1


def votes(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``_votes``, one letter per labeller."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    counted = df.withColumns({
        "_w": words(text),
        "_lines": lines,
        "_chars": F.length(plain),
        "_symbols": _count(plain, r"[#*$%&|<>{}\[\]_=~^\\]"),
        "_capitals": F.length(F.regexp_replace(plain, r"\P{Lu}+", "")),
        "_ends": _count(plain, r"[.!?](?:\s|$)"),
        "_marks": _count(plain, r"[!?]{2,}"),
    })
    many = F.greatest(F.size("_w") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_w", F.lit(1), many), F.slice("_w", F.lit(2), many), lambda a, b: a == b)
    counted = counted.withColumns({
        "_n": F.size("_w"),
        "_same": F.size(F.filter(pairs, lambda x: x)),
        "_kinds": F.size(F.array_distinct("_w")),
        "_all_lines": F.size("_lines"),
        "_new_lines": F.size(F.array_distinct("_lines")),
    }).drop("_w", "_lines")
    c, n = F.col, F.greatest(F.col("_n"), F.lit(1))
    chars = F.greatest(c("_chars"), F.lit(1))
    repeated = (c("_all_lines") - c("_new_lines")) / F.greatest(c("_all_lines"), F.lit(1))
    each = [
        _vote(c("_symbols") > 0.1 * n, c("_symbols") <= 0.02 * n),
        _vote((c("_capitals") > 0.3 * chars) & (c("_n") >= 5), c("_capitals") <= 0.1 * chars),
        _vote((c("_same") > 0.15 * n) & (c("_n") >= 5), c("_same") <= 0.03 * n),
        _vote((c("_n") >= 30) & (c("_kinds") < 0.25 * n), c("_kinds") >= 0.45 * n),
        _vote((c("_n") >= 80) & (c("_ends") * 80 < c("_n")), (c("_ends") > 0) & (c("_ends") * 40 >= c("_n"))),
        _vote(c("_n") < 1, c("_n") >= 15),
        _vote((c("_all_lines") >= 4) & (repeated > 0.5), (c("_all_lines") >= 2) & (repeated == 0)),
        _vote(c("_marks") > 0.1 * n, F.lit(False)),
        _vote((c("_chars") > 25 * n) | ((c("_chars") < 2.5 * n) & (c("_n") >= 5)), (c("_chars") > 4 * n) & (c("_chars") < 14 * n)),
    ]
    named = counted.withColumn("_votes", F.concat(*each))
    return named.drop(*[x for x in named.columns if x.startswith("_") and x not in ("_votes", *df.columns)])


def posteriors(patterns: dict[str, int], rounds: int = ROUNDS) -> tuple[dict[str, float], np.ndarray]:
    """P(good) of each vote pattern, and P(vote | class) by class, labeller, vote (good, bad, none).

    Class 0 is good; each further class is one kind of bad document, begun from the documents
    on which that labeller is the first to vote bad, since kinds of junk share few symptoms.
    """
    names = sorted(patterns)
    if not names:
        return {}, np.zeros((1, 0, 3))
    count = np.array([patterns[p] for p in names], float)
    seen = np.array([[[x == v for v in (GOOD, BAD, NONE)] for x in p] for p in names], float)
    labellers = len(names[0])
    share = np.full((1 + labellers, len(names)), 1e-6)
    for at, p in enumerate(names):
        share[1 + p.index(BAD) if BAD in p else 0, at] = 1.0
    # beforehand: bad votes on good documents are rare, and a labeller finds most documents of its own
    # kind; all else is left to the counts
    weight = PRIOR * count.sum()
    prior = np.ones((1 + labellers, labellers, 3))
    prior[0] = weight * np.array([0.9, 0.004, 0.096])
    prior[1 + np.arange(labellers), np.arange(labellers)] = weight * np.array([0.05, 0.9, 0.05])
    for _ in range(rounds):
        share /= share.sum(axis=0)
        table = np.einsum("cp,p,plv->clv", share, count, seen) + prior
        table /= table.sum(axis=2, keepdims=True)
        size = share @ count + 1.0
        log = np.log(size / size.sum())[:, None] + np.einsum("plv,clv->cp", seen, np.log(table))
        share = np.exp(log - log.max(axis=0))
    share /= share.sum(axis=0)
    return dict(zip(names, share[0].tolist())), table


def tokens(df: DataFrame, text: Column, buckets: int) -> DataFrame:
    """``df`` with ``_tokens``: buckets of word shapes, repetitions and the length."""
    shaped = F.coalesce(text, F.lit(""))
    for pattern, letter in ((r"[\p{Ll}\p{Lo}\p{M}]+", "a"), (r"\p{Lu}+", "A"), (r"\p{N}+", "0")):
        shaped = F.regexp_replace(shaped, pattern, letter)
    parts = df.withColumns({"_w": words(text), "_shapes": words(shaped)})
    many = F.greatest(F.size("_w") - 1, F.lit(0))
    length = F.floor(F.log2(F.size("_w") + F.lit(1.0))).cast("int")
    marks = F.zip_with(
        F.slice("_w", F.lit(1), many), F.slice("_w", F.lit(2), many), lambda a, b: F.when(a == b, "=").otherwise("/")
    )
    both = F.concat(
        F.array(F.concat(F.lit("n"), length.cast("string"))),
        F.transform("_shapes", lambda s: F.concat(F.lit("s"), s)),
        marks,
    )
    bucket = F.transform(both, lambda t: F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int"))
    return parts.withColumn("_tokens", bucket).drop("_w", "_shapes")


def train(rows: list[tuple[list[int], list[int]]], good: np.ndarray, buckets: int) -> list[float]:
    """Logistic weights by bucket, and the bias last, for rows of (buckets, counts)."""
    weights, bias = np.zeros(buckets), 0.0
    if not len(rows):
        return [*weights.tolist(), bias]
    row = np.concatenate([np.full(len(b), i) for i, (b, _) in enumerate(rows)])
    column = np.concatenate([np.asarray(b, int) for b, _ in rows])
    value = np.concatenate([np.asarray(c, float) / max(1, sum(c)) for _, c in rows])
    pace, bias_pace, n = np.full(buckets, 1e-8), 1e-8, len(rows)
    for _ in range(STEPS):
        z = np.bincount(row, value * weights[column], n) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - good
        slope = np.bincount(column, value * error[row], buckets) / n + RIDGE * weights / n
        pace += slope**2
        weights -= 10.0 * slope / np.sqrt(pace)
        bias_slope = error.mean()
        bias_pace += bias_slope**2
        bias -= 0.5 * bias_slope / np.sqrt(bias_pace)
    return [*weights.tolist(), bias]


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> list[float]:
    """The scorer's weights, learnt without labels from ``docs``."""
    plain = docs.select("doc_id", "text")
    voted = votes(plain, F.col("text"))
    patterns = {r[0]: r[1] for r in voted.groupBy("_votes").count().collect()}  # at most 3 ** labellers rows
    belief, _ = posteriors(patterns)
    keyed = plain.withColumn("key", F.xxhash64("doc_id", "text"))
    chosen = keyed.select("key").distinct().orderBy("key").limit(sample_rows)
    sample = keyed.join(F.broadcast(chosen), "key")  # at most ``sample_rows`` keys
    counted = tokens(votes(sample, F.col("text")), F.col("text"), buckets).select(
        "key", "_votes", F.explode_outer("_tokens").alias("bucket")  # outer: else a filter on it goes below the join
    )
    by_row = counted.groupBy("key", "_votes", "bucket").count().groupBy("key", "_votes").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "count"))).alias("counts")
    )
    found = by_row.select("_votes", "counts.bucket", "counts.count").collect()  # the sample's rows
    good = np.array([belief[r[0]] for r in found])
    return train([(r[1], r[2]) for r in found], good, buckets)


def _probability(weights: list[float]) -> Column:
    table = constants(weights[:-1])
    total = F.aggregate("_tokens", F.lit(0.0), lambda acc, b: acc + F.get(table, b)) / F.size("_tokens")
    return 1 / (1 + F.exp(-(total + F.lit(weights[-1]))))


def score(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (P of good quality) and kept of every document."""
    weights = fit(docs, sample_rows)
    rated = tokens(docs.select("doc_id", "text"), F.col("text"), len(weights) - 1).select(
        "doc_id", _probability(weights).alias("score")
    )
    return rated.withColumn("kept", F.col("score") >= threshold)


def keep(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with their own columns only."""
    weights = fit(docs, sample_rows)
    rated = tokens(docs.select(whole_rows(docs).alias("_row")), F.col("_row.text"), len(weights) - 1)
    return where_late(rated, _probability(weights) >= threshold).select("_row.*")
