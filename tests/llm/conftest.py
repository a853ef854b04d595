import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def make(*rows, schema=DOCUMENTS, extra=()):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] is not None else None, *extra)
            for r in rows
        ]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def odd_documents(documents):
    """NULLs in every column, empty, blank and very long texts, copies, repeated rows, clashing columns."""
    long = " ".join(f"word{k % 977} and{k % 31}" for k in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, long), (7, long),
        (8, "a plain text of more than ten words that says nothing at all today"),
        (8, "a plain text of more than ten words that says nothing at all today"),
        (None, "a text without an id that still has ten words or more in it"), (None, None),
        (9, "a plain text of more than ten words that says nothing at all today", None),
    ]
    names = "score double, kept int, slot int, class string, shard int, words int, row int, block int, n int"
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {names}"
    return documents(*rows, schema=schema, extra=(None,) * 9)
