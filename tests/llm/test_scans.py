"""License scans and toxicity."""

import zlib

import numpy as np

from tillwater.llm import license_scan, toxicity


def test_verbatim_and_edited_notices_are_found(spark, documents):
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor " * 30
    mit = license_scan.TEMPLATES["MIT-permission"]
    edited = mit.replace("sublicense", "relicense")
    docs = documents(
        (1, f"{filler}\nLicensed under the Apache License, Version 2.0.\n{filler}"),
        (2, "ALL RIGHTS reserved"), (3, f"{filler} {mit} {filler}"), (4, f"{filler} {edited} {filler}"),
        (5, filler), (6, "released under the license of MIT"), (7, "Released under the MIT License. " * 3),
        (7, "All rights reserved."),
    )
    got = {(r.doc_id, r.license): r for r in license_scan.scan(docs).collect()}
    assert set(got) == {
        (1, "Apache-2.0"), (2, "All-rights-reserved"), (3, "MIT-permission"), (4, "MIT-permission"), (7, "MIT"),
        (7, "All-rights-reserved"),
    }
    assert got[(1, "Apache-2.0")].containment == 1 and got[(1, "Apache-2.0")].start_word == 360
    assert got[(3, "MIT-permission")].containment == 1 > got[(4, "MIT-permission")].containment >= 0.8
    assert got[(7, "MIT")].start_word == 0


def test_common_licences_are_found_by_notice_header_and_text(spark, documents):
    texts = license_scan.TEMPLATES
    named = ["BSD-2-Clause-text", "BSD-3-Clause-text", "ISC-text", "MPL-2.0-header", "LGPL-2.1-header", "AGPL-3.0-header",
             "GPL-2.0-header", "CC-BY-4.0-notice", "CC-BY-SA-4.0-long-notice", "CC0-1.0-text", "Unlicense-text",
             "MIT-disclaimer", "MIT-text", "Apache-2.0-text", "GPL-3.0-text", "MPL-2.0-text"]
    docs = documents(*[(k, f"some words before {texts[name]} and after it") for k, name in enumerate(named)])
    got = {(r.doc_id, r.license): r.containment for r in license_scan.scan(docs).collect()}
    assert all(got[(k, name)] == 1 for k, name in enumerate(named))
    assert (7, "CC-BY-NC-4.0") not in got and (6, "GPL-3.0-text") not in got


def test_scan_plan_has_no_python(spark, documents):
    found = license_scan.scan(documents((1, "All rights reserved.")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_odd_rows_and_templates(odd_documents, documents):
    assert license_scan.scan(odd_documents).count() == 0
    assert license_scan.scan(odd_documents.limit(0)).count() == 0
    assert license_scan.scan(odd_documents, {}).count() == 0
    own = license_scan.scan(odd_documents, {"own": "says nothing at all today", "blank": " "}).collect()
    assert sorted(r.doc_id for r in own) == [8, 9]


INSULTS = ["idiot", "worthless", "clown", "scum"]


def sample(n, seed=0):
    draw = np.random.default_rng(seed)
    words = ["".join(draw.choice(list("aeourtnslmd"), draw.integers(3, 9))) for _ in range(400)]
    rows = []
    for k in range(n):
        text = [" ".join(draw.choice(words, 9)) for _ in range(draw.integers(2, 8))]
        toxic = k % 4 == 0
        if toxic:
            at = draw.integers(len(text))
            text[at] += " you " + INSULTS[draw.integers(len(INSULTS))]
        rows.append((k, ". ".join(text) + ".", int(toxic)))
    return rows


def test_kernel_equals_the_sum_over_subsequences():
    from itertools import combinations

    def plain(a, b, n, decay):
        def spans(s):
            out = {}
            for at in combinations(range(len(s)), n):
                key = "".join(s[i] for i in at)
                out[key] = out.get(key, 0) + decay ** (at[-1] - at[0] + 1)
            return out

        x, y = spans(a), spans(b)
        return sum(v * y.get(k, 0) for k, v in x.items())

    for a, b in [("^idiot", "^id1iot"), ("banana", "ananas"), ("abcd", "abcd"), ("abc", "abcd"), ("aaaaa", "aaaa")]:
        got = toxicity._pair_kernel(toxicity._codes([a]), toxicity._codes([b]))[0]
        assert abs(got - plain(a, b, toxicity.LENGTH, toxicity.DECAY)) < 1e-4


def test_learns_insults_also_with_gaps(spark):
    rows = sample(800)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in rows] + [(None, 1, 1), (5, 1, None)], "doc_id bigint, quality int, toxic int")
    extra = spark.createDataFrame([(9001, None), (9002, ""), (None, "you idiot"), (9003, "word " * 50_000 + "you scum")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in toxicity.score(docs.union(extra), labels).collect()}
    for k, r in got.items():
        assert r.held_out == (zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(got[k], y) for k, _, y in rows if got[k].held_out]
    assert np.mean([r.predicted == y for r, y in held]) > 0.95
    assert got[9001].score == got[9002].score < 0.2
    assert got[None].predicted == 1 and got[9003].predicted == 1
    model = toxicity.fit(docs, labels)
    clean, spaced, inserted = model.score(["you are nice", "you i d i o t", "you worth-less thing"])
    assert spaced > 0.5 and inserted > clean


def test_insults_with_an_inserted_character_are_found_and_clean_documents_left_alone():
    """Learnt from the given labels; a fifth of them is held out."""
    import duckdb

    rows = duckdb.sql("""SELECT doc_id, coalesce(text, ''), toxic > 0 FROM '/root/testdata/sf0.1/documents.parquet'
        JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id) WHERE length(text) <= 20000 ORDER BY doc_id""").fetchall()
    held = [zlib.crc32(str(k).encode()) % 5 == 0 for k, _, _ in rows]
    taught = [r for r, out in zip(rows, held) if not out]
    model = toxicity.train([t for _, t, _ in taught], np.array([y for _, _, y in taught]))
    scores = np.array(model.score([t for (_, t, _), out in zip(rows, held) if out])) >= 0.5
    toxic = np.array([y for (_, _, y), out in zip(rows, held) if out])
    assert scores[~toxic].mean() < 0.03 and scores[toxic].mean() > 0.8
    said = lambda word: model.score([f"you are a {word} today."])[0] >= 0.5
    known = [w for w in ("worthless", "trash", "stupid", "clown", "idiot", "scum", "loser") if said(w)]
    assert len(known) >= 6
    broken = [w[:at] + mark + w[at:] for w in known for at in range(1, len(w)) for mark in "x-*.1"]
    assert np.mean([said(w) for w in broken]) > 0.8
    assert all(said(" ".join(w)) for w in known)  # spaced out, behind an article
    assert not any(said(w) for w in ("plumber", "teacher", "student", "cloud", "trader", "score"))


def test_without_labels_every_score_is_zero(spark):
    docs = spark.createDataFrame([(1, "text"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in toxicity.score(docs, labels).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).count() == 0
