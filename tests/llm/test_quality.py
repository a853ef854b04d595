"""Quality rules and the weakly supervised classifier."""

import random
import re
from collections import Counter

import numpy as np

from tillwater.llm import quality_classifier, quality_rules

PROSE = [f"the river {k % 5} runs past a quiet town where people {k % 7} meet and talk about {k % 11} things." for k in range(60)]
JUNK = ["x### y&&& z%%% a*** b$$$ c### d&&& e%%% f*** g$$$ h### i&&& " + f"{k}###" for k in range(20)]


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {
        i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)
    }
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(repeated),
    )


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def corpus(documents):
    return documents(*[(k, t) for k, t in enumerate(PROSE)], *[(100 + k, t) for k, t in enumerate(JUNK)])


def test_base_rules_equal_brute_force(spark, documents, odd_documents):
    texts = [
        "a b c d e a b c d e", "one\ntwo\none\n \n\none", "ünï çode wörds | and <marks> # here",
        "a b c d e f a b c d e g h i j k l m n o", "x " * 40, "same same same same same same",
    ]
    docs = documents(*[(50 + k, t) for k, t in enumerate(texts)]).union(odd_documents.select("doc_id", "text", "lang", "source", "n_chars"))
    got = quality_rules.judge(docs, labels_of(spark, []))
    wanted = Counter((r.doc_id, *base_counts(r.text)) for r in docs.collect())
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == wanted
    for r in got.collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)  # without trusted rows only the base rules decide


def test_ratio_equals_brute_force_and_rejects_junk(spark, documents):
    docs = corpus(documents)
    labels = labels_of(spark, [(k, 1, 0) for k in range(0, 60, 2)] + [(100, 0, 0), (None, 1, 0)])
    got = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    assert all(got[k].kept for k in range(60)) and not any(got[100 + k].kept for k in range(20))
    weights = quality_rules.fit(docs, labels)
    words = {w for t in PROSE + JUNK for w in t.split()}
    hashed = {r.w: r.h for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) h").collect()}
    pairs = {(a, b) for t in PROSE + JUNK for a, b in zip(t.split(), t.split()[1:])}
    joined = spark.createDataFrame([(a, b, hashed[a], hashed[b]) for a, b in pairs], "a string, b string, x bigint, y bigint")
    both = {(r.a, r.b): r.h for r in joined.selectExpr("a", "b", "xxhash64(x, y) h").collect()}

    def buckets(text):
        found = text.split()
        return [h % quality_rules.BUCKETS for h in [*(hashed[w] for w in found), *(both[p] for p in zip(found, found[1:]))]]

    raw, target = Counter(), Counter()
    for k, t in [*enumerate(PROSE), *((100 + k, t) for k, t in enumerate(JUNK))]:
        raw.update(buckets(t))
        target.update(buckets(t) if k < 60 and k % 2 == 0 else [])
    expected = {b: raw[b] * sum(target.values()) / sum(raw.values()) for b in raw}
    share = {b: (target[b] + 20) / (expected[b] + 20) for b in raw}
    ratio = {b: np.log(0.95 * x + 0.05) for b, x in share.items()}
    assert all(abs(weights[b] - r) < 1e-9 for b, r in ratio.items())
    grams = buckets(PROSE[5])
    assert abs(got[5].score - sum(ratio[b] for b in grams) / (len(grams) + quality_rules.PRIOR)) < 1e-6


def test_keep_returns_the_columns_of_the_input(spark, documents, odd_documents):
    labels = labels_of(spark, [(8, 1, 0)])
    kept = quality_rules.keep(odd_documents, labels)
    assert kept.columns == odd_documents.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect() if r.doc_id != 6 and r.doc_id != 7) == [
        (False, 8), (False, 8), (False, 9), (True, None)
    ]
    empty = odd_documents.limit(0)
    assert quality_rules.keep(empty, labels).count() == 0 and quality_rules.judge(empty, labels).count() == 0


def test_posteriors_find_kinds_of_junk():
    good, bad_a, bad_b = "ggggggg-g", "bgggggg-g", "ggbbgg--g"
    belief, table = quality_classifier.posteriors({good: 900, bad_a: 60, bad_b: 40, "gggg-g--g": 10})
    assert belief[good] > 0.9 and belief["gggg-g--g"] > 0.5
    assert belief[bad_a] < 0.2 and belief[bad_b] < 0.2
    assert np.allclose(table.sum(axis=2), 1)
    assert quality_classifier.posteriors({})[0] == {}


def test_the_classifier_keeps_prose_and_rejects_junk(spark, documents):
    docs = corpus(documents)
    got = {r.doc_id: r for r in quality_classifier.score(docs).collect()}
    assert all(got[k].kept for k in range(60)) and sum(got[100 + k].kept for k in range(20)) == 0
    again = {r.doc_id: r.score for r in quality_classifier.score(docs.repartition(3)).collect()}
    assert all(abs(again[k] - got[k].score) < 1e-9 for k in again)


def test_the_classifier_takes_odd_rows(odd_documents):
    kept = quality_classifier.keep(odd_documents)
    assert kept.columns == odd_documents.columns
    scores = quality_classifier.score(odd_documents)
    assert scores.count() == odd_documents.count() and scores.where("score IS NULL OR score < 0 OR score > 1").isEmpty()
    assert quality_classifier.score(odd_documents.limit(0)).count() == 0


def test_posteriors_equal_a_plain_walk_over_documents():
    """Expectation maximisation document by document, without patterns or arrays."""
    from math import exp, log

    draw = random.Random(4)
    documents = []
    for k in range(300):
        bad = k % 5 == 0
        documents.append("".join(
            draw.choices("gb-", [(0.1, 0.8, 0.1), (0.3, 0.4, 0.3)][j > 0] if bad else (0.8, 0.03, 0.17))[0] for j in range(3)
        ))
    belief, table = quality_classifier.posteriors(dict(Counter(documents)))

    def prior(c, j):
        weight = quality_classifier.PRIOR * len(documents)
        return [weight * x for x in ((0.9, 0.004, 0.096) if c == 0 else (0.05, 0.9, 0.05))] if c == 0 or j == c - 1 else [1, 1, 1]

    share = [[1.0 if c == (1 + d.index("b") if "b" in d else 0) else 1e-6 for c in range(4)] for d in documents]
    for _ in range(quality_classifier.ROUNDS):
        share = [[x / sum(row) for x in row] for row in share]
        size = [1.0 + sum(row[c] for row in share) for c in range(4)]
        rate = {}
        for c in range(4):
            for j in range(3):
                found = prior(c, j)[:]
                for row, d in zip(share, documents):
                    found["gb-".index(d[j])] += row[c]
                rate[c, j] = [x / sum(found) for x in found]
        share = [
            [exp(log(size[c] / sum(size)) + sum(log(rate[c, j]["gb-".index(v)]) for j, v in enumerate(d))) for c in range(4)]
            for d in documents
        ]
    for d, row in zip(documents, share):
        assert abs(belief[d] - row[0] / sum(row)) < 1e-6
    assert all(abs(table[c, j, k] - rate[c, j][k]) < 1e-6 for c in range(4) for j in range(3) for k in range(3))


def test_the_scorer_equals_plain_gradient_steps():
    from math import exp, sqrt

    rows, good, buckets = [([0, 2], [3, 1]), ([1], [2]), ([], []), ([1, 2], [1, 1])], [1.0, 0.0, 0.5, 0.2], 3
    weights, bias, pace, bias_pace = [0.0] * buckets, 0.0, [1e-8] * buckets, 1e-8
    for _ in range(quality_classifier.STEPS):
        errors = []
        for (b, c), g in zip(rows, good):
            z = bias + sum(n / sum(c) * weights[k] for k, n in zip(b, c))
            errors.append(1 / (1 + exp(-z)) - g)
        for k in range(buckets):
            slope = sum(e * n / sum(c) for (b, c), e in zip(rows, errors) for j, n in zip(b, c) if j == k) / len(rows)
            slope += quality_classifier.RIDGE * weights[k] / len(rows)
            pace[k] += slope**2
            weights[k] -= 10.0 * slope / sqrt(pace[k])
        bias_slope = sum(errors) / len(rows)
        bias_pace += bias_slope**2
        bias -= 0.5 * bias_slope / sqrt(bias_pace)
    made = quality_classifier.train(rows, np.array(good), buckets)
    assert np.allclose(made, [*weights, bias], atol=1e-9)


def test_long_shapes_are_told_apart_to_the_end(spark):
    rows = spark.createDataFrame([(1, "-a" * 9 + "-B"), (2, "-a" * 9 + "-1")], "doc_id bigint, text string")
    one, other = (r._tokens for r in quality_classifier.tokens(rows, rows.text, 4096).collect())
    assert one != other
