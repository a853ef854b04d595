"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the corpus.

Two multinomials over ``BUCKETS`` hashed word unigrams and bigrams are counted: one over a
bounded sample of trusted rows (labels with quality 1), one over every document. A
document's score is the sum over its n-grams of log(p_target / p_corpus), divided by their
number plus ``PRIOR``; it is kept when the score reaches a fixed threshold. Native columns only.

Defined results: a NULL or empty text has no words, no n-grams and a NULL score, and fails
the base rules; repeated rows count and are judged one by one; NULL ids pass through; with
no trusted row the ratio is 0 everywhere, so only the base rules decide; an empty table
gives no rows. Extra columns of the input are ignored by ``judge`` and kept by ``keep``.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import BLANKS, constants, where_late, whole_rows, words

BUCKETS = 1 << 14
#: Labelled rows that fit the target, at most; those with the lowest hash of the id are taken.
TRUSTED_ROWS = 20_000
#: Share of the corpus in the smoothed target: it bounds the ratio below, at every size of corpus.
BACKGROUND = 0.05
#: Occurrences added to the seen and the expected ones of a bucket in the target, so that a bucket
#: of few occurrences says little.
FIRMNESS = 20
#: Neutral n-grams added to each document, so that a handful of rare words decides nothing.
PRIOR = 20
#: Mean log-likelihood ratio, in nats per n-gram, from which a document is kept.
THRESHOLD = -0.08
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SYMBOL = "[#*$%&|<>]"


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_ROWS) -> DataFrame:
    """The ids of at most ``limit`` rows with quality 1."""
    chosen = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def _joined(left: Column, right: Column, size: Column, shift: int) -> Column:
    """Hashes of left[i] with right[i + shift], for the first ``size`` i."""
    many = F.greatest(size, F.lit(0))
    return F.zip_with(
        F.slice(left, F.lit(1), many), F.slice(right, F.lit(1 + shift), many), lambda x, y: F.xxhash64(x, y)
    )


def _hashed(df: DataFrame, tokens: Column) -> DataFrame:
    """``df`` with the hashes of its words and word pairs, in columns _one and _two."""
    one = df.withColumn("_one", F.transform(tokens, lambda w: F.xxhash64(w)))
    return one.withColumn("_two", _joined(F.col("_one"), F.col("_one"), F.size("_one") - 1, 1))


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(gram, F.lit(buckets)).cast("int")


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted_rows: int = TRUSTED_ROWS) -> list[float]:
    """log(p_target / p_corpus) by bucket, the target mixed with a little of the corpus; ``buckets`` numbers."""
    trusted = trusted_ids(labels, trusted_rows).select("doc_id", F.lit(1).alias("trusted"))
    hashed = _hashed(docs.select("doc_id", "text"), words(F.col("text"))).drop("text")
    grams = (
        hashed.join(F.broadcast(trusted), "doc_id", "left")
        .select("trusted", F.explode_outer(F.concat("_one", "_two")).alias("gram"))
        .where("gram IS NOT NULL")
        .select("trusted", _bucket(F.col("gram"), buckets).alias("bucket"))
    )
    counts = grams.groupBy("bucket").agg(F.count("*").alias("corpus"), F.count("trusted").alias("target"))
    found = {r.bucket: r for r in counts.collect()}  # at most ``buckets`` rows
    corpus, target = (sum(r[name] for r in found.values()) for name in ("corpus", "target"))
    if not target:
        return [0.0] * buckets
    ratios = [0.0] * buckets
    for bucket, r in found.items():
        expected = r.corpus * target / corpus
        share = (r.target + FIRMNESS) / (expected + FIRMNESS)
        ratios[bucket] = log((1 - BACKGROUND) * share + BACKGROUND)
    return ratios


def _score(weights: list[float]) -> Column:
    """The ratio summed over _one and _two, by their number and ``PRIOR`` neutral n-grams."""
    ratios = constants(weights)

    def add(total: Column, gram: Column) -> Column:
        return total + F.get(ratios, _bucket(gram, len(weights)))

    pairs = F.aggregate("_two", F.lit(0.0), add)
    n = F.size("_one") + F.size("_two")
    return F.when(n > 0, F.aggregate("_one", pairs, add) / (n + PRIOR))


def _repeated() -> Column:
    """How many words stand in windows of five (column _five) that the text holds twice or more."""

    def positions(in_order: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            return F.coalesce(x["h"] == y["h"], F.lit(False))

        flagged = F.transform(
            in_order,
            lambda x, i: F.when(
                same(x, F.get(in_order, F.when(i > 0, i - 1))) | same(x, F.get(in_order, i + 1)), x["i"]
            ),
        )
        return F.array_sort(F.filter(flagged, lambda p: p.isNotNull()))

    in_order = F.array_sort(F.transform("_five", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    covered = F.aggregate(
        F.get(F.transform(F.array(in_order), positions), F.lit(0)),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct("_five")) < F.size("_five"), covered).otherwise(F.lit(0).cast("bigint"))


def _ruled(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the base counts, base_failed, and the hashes _one and _two."""

    def repeats(values: Column) -> Column:
        return F.size(values) - F.size(F.array_distinct(values))

    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    parts = df.withColumns({
        "_words": words(text),
        "n_symbols": (F.size(F.split(plain, SYMBOL)) - 1).cast("bigint"),
        "n_dup_lines": F.get(F.transform(F.array(lines), repeats), F.lit(0)).cast("bigint"),
    })
    counted = _hashed(parts, F.col("_words")).withColumns({
        "word_chars": F.aggregate("_words", F.lit(0).cast("bigint"), lambda n, w: n + F.length(w)),
        "n_words": F.size("_words").cast("bigint"),
        "_four": _joined(F.col("_two"), F.col("_two"), F.size("_two") - 2, 2),
    }).drop("_words")
    windows = counted.withColumn("_five", _joined(F.col("_four"), F.col("_one"), F.size("_four") - 1, 4)).drop("_four")
    full = windows.withColumn("n_repeat_words", _repeated()).drop("_five")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return full.withColumn("base_failed", failed)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the base counts, the score and ``kept``."""
    score = _score(fit(docs, labels))
    ruled = _ruled(docs.select("doc_id", "text"), F.col("text")).drop("text")
    rated = ruled.withColumn("score", score).drop("_one", "_two")
    return rated.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False)))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with their own columns only."""
    score = _score(fit(docs, labels))
    ruled = _ruled(docs.select(whole_rows(docs).alias("_row")), F.col("_row.text"))
    passed = where_late(ruled, ~F.col("base_failed")).withColumn("_score", score)
    return where_late(passed, F.col("_score") >= threshold).select("_row.*")
