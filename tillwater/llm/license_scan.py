r"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Texts and templates are lower-cased and taken as words ``[a-z0-9]+``; a template's shingles are
five words (all its words, if fewer). Its windows over a text hold as many shingles as the
template plus a stride less one, so that some window holds a whole verbatim passage. A window
that shares ``CONTAINMENT`` of a template's shingles has a Jaccard similarity of at least 0.55
with it; with ``BANDS`` bands of ``ROWS`` rows the two share a band with a chance of 1 - 1e-5,
and a verbatim passage (0.8 or more) with 1 - 1e-14. Retrieved pairs are verified on the
shingles themselves. Windows without any template shingle can share no minimum and are left
out before hashing, which changes no result. Native columns only.

The templates are a parameter (a bounded list, hence constants and a broadcast of their bands);
``TEMPLATES`` holds the notices, file headers and full texts of common licences, see
``license_texts``. A window is only cut where a document holds ``CONTAINMENT`` of the template's
number of shingles, so that long texts cost short documents nothing.

Defined results: a NULL or empty text matches nothing; rows of one id (also NULL) are one
document; of equally good windows the earliest counts; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.llm import license_texts
from tillwater.llm.common import where_late

SHINGLE = 5
CONTAINMENT = 0.8
BANDS, ROWS = 32, 2

#: Wording of common license notices.
TEMPLATES = {
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "All-rights-reserved": "All rights reserved.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    **license_texts.NOTICES,
    **license_texts.HEADERS,
    **license_texts.TEXTS,
    **license_texts.long_texts(),
}
TEMPLATES["MIT-text"] = f"{TEMPLATES['MIT-permission']} {TEMPLATES['MIT-disclaimer']}"


def _hashes(text: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    return F.transform(found, lambda w: F.xxhash64(w))


def _longer(df: DataFrame, size: int) -> DataFrame:
    """``df`` with column ``s{size}``, the hashes of ``size`` words, built on ``s{size - 1}``."""
    many = F.greatest(F.size(f"s{size - 1}") - 1, F.lit(0))
    joined = F.zip_with(
        F.slice(F.col(f"s{size - 1}"), F.lit(1), many),
        F.slice(F.col("s1"), F.lit(size), many),
        lambda a, w: F.xxhash64(a, w),
    )
    return df.withColumn(f"s{size}", joined)


def _shingled(df: DataFrame, text: Column, sizes: list[int]) -> DataFrame:
    """``df`` with a column of shingle hashes for each of ``sizes``."""
    out = df.withColumn("s1", _hashes(text))
    for size in range(2, max(sizes) + 1):
        out = _longer(out, size)
        if size - 1 not in sizes and size > 2:
            out = out.drop(f"s{size - 1}")
    return out


def _minima(shingles: Column) -> Column:
    """Band keys of a window: hashes of ``ROWS`` minima each, with the band's number."""

    def lowest(seed: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(F.lit(seed), h)))

    return F.array(*[
        F.xxhash64(F.lit(j), *[lowest(ROWS * j + r) for r in range(ROWS)]) for j in range(BANDS)
    ])


def _windows(shingles: Column, number: int, window: int, stride: int, wanted: Column, least: int) -> Column:
    """The windows of one shape that hold any of its templates' shingles, if the text holds ``least`` shingles."""
    starts = F.when(
        (F.size(shingles) >= least) & F.arrays_overlap(shingles, wanted), F.sequence(F.lit(0), F.size(shingles) - 1, F.lit(stride))
    ).otherwise(F.array().cast("array<int>"))
    cut_out = F.transform(
        starts,
        lambda at: F.struct(
            F.lit(number).alias("shape"), at.alias("start"),
            F.array_distinct(F.slice(shingles, at + 1, window)).alias("window"),
        ),
    )
    return F.filter(
        cut_out, lambda w: (F.size(w["window"]) >= least) & F.arrays_overlap(w["window"], wanted)
    )


def _templates(spark: SparkSession, templates: dict[str, str]) -> list[dict]:
    """Shingle size, shingles and window of each template; a bounded parameter, so kept on the driver."""
    rows = spark.createDataFrame(list(templates.items()), "license string, body string")
    shingled = _shingled(rows, F.col("body"), list(range(1, SHINGLE + 1))).collect()
    out = []
    for row in shingled:
        size = min(SHINGLE, len(row.s1))
        if not size:
            continue
        shingles = sorted(set(row[f"s{size}"]))
        stride = max(1, len(row[f"s{size}"]) // 4)
        window = len(row[f"s{size}"]) + stride - 1
        out.append({"license": row.license, "size": size, "shingles": shingles, "stride": stride, "window": window})
    return out


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT
) -> DataFrame:
    """(doc_id, license, containment, start_word): each document's best window for each license found."""
    spark = docs.sparkSession
    known = _templates(spark, TEMPLATES if templates is None else templates)
    kind = dict(docs.dtypes)["doc_id"]
    if not known:
        return spark.createDataFrame([], f"doc_id {kind}, license string, containment double, start_word bigint")
    sizes = sorted({t["size"] for t in known})

    def longs(values: set[int]) -> Column:
        return F.split(F.lit(",".join(map(str, sorted(values)))), ",").cast("array<bigint>")

    def shape(t: dict) -> tuple[int, int, int]:
        return t["size"], t["window"], t["stride"]

    wanted = {s: longs({h for t in known if t["size"] == s for h in t["shingles"]}) for s in sizes}
    shingled = _shingled(docs.select("doc_id", "text"), F.col("text"), sizes).select("doc_id", *[f"s{s}" for s in sizes])
    hit = F.lit(False)
    for s in sizes:
        hit = hit | F.arrays_overlap(F.col(f"s{s}"), wanted[s])
    near = where_late(shingled, hit)

    # all shapes of windows (shingle size, shingles, stride) in one list per document
    shapes = sorted({shape(t) for t in known})
    windows = []
    for number, (size, window, stride) in enumerate(shapes):
        own = [t["shingles"] for t in known if shape(t) == (size, window, stride)]
        least = max(1, ceil(containment * min(map(len, own)) - 1e-9))
        windows.append(_windows(F.col(f"s{size}"), number, window, stride, longs(set().union(*own)), least))
    # outer: else the list is computed twice, first for a filter on its size
    opened = near.select("doc_id", F.explode_outer(F.concat(*windows)).alias("w")).where("w IS NOT NULL")
    opened = opened.select("doc_id", "w.*")
    banded = opened.withColumn("band", F.explode(_minima(F.col("window"))))

    rows = [
        (t["license"], shapes.index(shape(t)), t["shingles"]) for t in known
    ]
    listed = spark.createDataFrame(rows, "license string, shape int, template array<bigint>")
    listed = listed.withColumn("band", F.explode(_minima(F.col("template"))))
    share = F.size(F.array_intersect("window", "template")) / F.size("template")
    found = banded.join(F.broadcast(listed), ["shape", "band"]).withColumn("containment", share)
    return (
        found.where(F.col("containment") >= containment)
        .groupBy("doc_id", "license")
        .agg(F.max(F.struct("containment", (-F.col("start")).alias("back"))).alias("best"))
        .select("doc_id", "license", "best.containment", (-F.col("best.back")).cast("bigint").alias("start_word"))
    )


def oracle(templates: dict[str, str] | None = None) -> str:
    """DuckDB SQL with the same rows, from the exact containment of every window."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in (TEMPLATES if templates is None else templates).items())
    words = "regexp_extract_all(lower({}), '[a-z0-9]+')"
    shingle = "list_transform(range(1, len({w}) - {s} + 2), lambda i: array_to_string(list_slice({w}, i, i + {s} - 1), ' '))"
    return f"""
WITH t AS (SELECT license, {words.format('body')} AS w FROM (VALUES {values}) v(license, body)),
t2 AS (SELECT license, least({SHINGLE}, len(w)) AS s, {shingle.format(w='w', s=f'least({SHINGLE}, len(w))')} AS sh FROM t),
t3 AS (
    SELECT license, s, list_distinct(sh) AS sh, greatest(1, len(sh) // 4) AS stride,
           len(sh) + greatest(1, len(sh) // 4) - 1 AS win FROM t2
),
d AS (SELECT doc_id, {words.format("coalesce(text, '')")} AS w FROM documents),
p AS (
    SELECT s, list_distinct(flatten(list(sh))) AS shingles FROM t3 GROUP BY s
),
near AS (
    SELECT doc_id, s, sh FROM (SELECT doc_id, p.s, shingles, {shingle.format(w='w', s='p.s')} AS sh FROM d, p)
    WHERE list_has_any(sh, shingles)
),
cut AS (
    SELECT doc_id, license, t3.sh AS tsh, unnest(range(0, len(near.sh), stride)) AS pos, near.sh AS dsh, win
    FROM near JOIN t3 USING (s)
),
scored AS (
    SELECT doc_id, license, pos,
           len(list_intersect(list_distinct(list_slice(dsh, pos + 1, pos + win)), tsh)) / len(tsh) AS containment
    FROM cut
)
SELECT doc_id, license, max(containment) AS containment,
       CAST(min(pos) FILTER (containment = best) AS BIGINT) AS start_word
FROM (SELECT *, max(containment) OVER (PARTITION BY doc_id, license) AS best FROM scored)
WHERE best >= {CONTAINMENT} GROUP BY doc_id, license
"""
