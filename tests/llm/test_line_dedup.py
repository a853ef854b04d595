"""Line dedup against brute force: hot lines over several ranges, both rules, bitmaps and odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tillwater.llm import line_dedup


def strip(line):
    line = line.strip(" \t\n\x0b\f\r")
    return re.sub("[A-Z]", lambda m: m[0].lower(), line)


def brute(rows, min_documents, keep, min_length=1):
    """(doc_id, text) -> positions that go; equal rows are one document."""
    documents = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    found, seen, gone = {}, set(), {}
    for document in documents:
        for line in document[1].split("\n"):
            found.setdefault(strip(line), set()).add(document)
    for document in documents:
        gone[document] = set()
        for at, line in enumerate(document[1].split("\n")):
            name = strip(line)
            if len(name) >= min_length:
                if keep == "none" and len(found[name]) >= min_documents or keep == "first" and name in seen:
                    gone[document].add(at)
                seen.add(name)
    return gone


def some_rows():
    draw = random.Random(5)
    rows = []
    for k in range(400):
        lines = [f"own {k} {j}" for j in range(draw.randrange(4))]
        lines += [draw.choice(["  HOT line ", "hot LINE\t", "hot line"])] * draw.choice([0, 1, 3])
        lines += [f"Ünder {draw.randrange(60)}", "", " \x0b "] + [f"few {draw.randrange(30)}"] * draw.randrange(2)
        draw.shuffle(lines)
        rows.append((k, "\n".join(lines)))
    return rows + [(900, "\n".join(f"own {k % 40} 0" if k % 3 else f"row {k}" for k in range(900)))]


def positions(words):
    at, out = 0, set()
    for word in words:
        at += word.skip
        out |= {at * 64 + k for k in range(64) if word.dropped >> k & 1}
        at += 1
    return out


@pytest.mark.parametrize("keep, min_documents, min_length", [("none", 10, 1), ("none", 3, 7), ("first", 2, 1)])
def test_bitmaps_equal_brute_force(documents, keep, min_documents, min_length):
    rows = some_rows()
    want = brute(rows, min_documents, keep, min_length)
    got = line_dedup.digest(documents(*rows), keep=keep, min_documents=min_documents, min_length=min_length).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        gone = want[(r.doc_id, texts[r.doc_id])]
        lines = texts[r.doc_id].split("\n")
        kept = "\n".join(line for at, line in enumerate(lines) if at not in gone)
        assert positions(r.bitmap) == gone and r.n_dropped == len(gone) and r.n_lines == len(lines)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert sum(map(len, want.values())) > 300


def test_all_kept_words_are_left_out(documents):
    rows = [(k, "\n".join([f"{k}-{j}" for j in range(700)] + ["same"])) for k in range(10)]
    got = line_dedup.digest(documents(*rows)).collect()
    assert {len(r.bitmap) for r in got} == {1} and {r.bitmap[0].skip for r in got} == {10}


def test_odd_rows(odd_documents, documents):
    got = line_dedup.digest(odd_documents, min_documents=2).collect()
    assert len(got) == odd_documents.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by_id[1].n_lines, by_id[1].n_dropped, by_id[2].n_lines, by_id[3].n_lines) == (1, 0, 1, 2)
    assert by_id[6].n_dropped == by_id[7].n_dropped == 1  # one very long line in two documents
    assert by_id[8].n_dropped == by_id[9].n_dropped == 1  # a repeated row is one document, 9 is another
    assert by_id[8].kept_sha256 == hashlib.sha256(b"").hexdigest()
    kept = line_dedup.apply(odd_documents, min_documents=2)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count()
    assert {r.doc_id: r.text for r in kept.collect() if r.doc_id in (1, 2, 4, 6)} == {1: None, 2: "", 4: "one", 6: ""}
    assert line_dedup.digest(documents(*[(1, "a")]).limit(0)).count() == 0
    repeated = documents(*[(5, "x\ny")] * 30, *[(k, "x") for k in range(6, 14)])
    assert {r.n_dropped for r in line_dedup.digest(repeated).collect()} == {0}  # nine documents, not 38
    assert {r.n_dropped for r in line_dedup.digest(repeated.union(documents((14, "X")))).collect()} == {1}
    with pytest.raises(ValueError):
        line_dedup.digest(repeated, keep="last")


def test_a_hot_line_is_cut_and_no_python_runs(documents):
    rows = documents(*some_rows()).repartition(4)
    spread = line_dedup.hashed_lines(rows).withColumn("s", F.col("d1").bitwiseAND(line_dedup.SPREADS - 1))
    shares = spread.groupBy("h1", "h2", "s").count()
    assert shares.agg(F.max("count")).first()[0] < spread.count() / 20
    plan = line_dedup.digest(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "ArrowEval" not in plan
    assert plan.count("rangepartitioning(h1") == 1  # the stream takes the ranges as they are
