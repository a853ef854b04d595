r"""Line dedup: repeated lines go, and each document gets a bitmap of the lines that stay.

1. Every line becomes a 128-bit hash of its key (the line stripped of ``[\x20\x09-\x0D]`` at both
   ends, A-Z lower-cased) with its document and position. Texts stay where they are.
2. The hashes are range-partitioned with a spread of the documents as second range column, so that
   a line that a third of all rows hold is cut into ``SPREADS`` ranges, and sorted by document and
   position. One stream over each range finds first occurrences: of the line in a document, and of
   the line in the range, with the number of documents of the range.
3. A second window joins the ranges of one line. Only ranges of fewer than ``min_documents``
   documents and one row of each other range meet there, at most ``SPREADS * min_documents``
   documents' rows; the rows of settled ranges pass by in groups of their own.
4. Dropped positions are packed to words of 64 lines by ``bit_or`` before they are shuffled, and a
   document's words are gathered with runs of all-kept words left out (``bitmap``: an array of
   ``skip``, the number of such words before, and ``dropped``, the bits of the word).

``keep="none"`` drops every occurrence of a key found in ``min_documents`` documents or more;
``keep="first"`` keeps the first one, by document id, then text, then position.

Defined results: a document is what rows of equal id and equal text are together, so repeated rows
count once and get the same bitmap; the same id with other texts, and a NULL id with other texts,
are other documents; a NULL id sorts last; a NULL text is an empty one, of one empty line; keys
shorter than ``min_length`` code points never go; an empty table gives no rows; extra columns are
ignored, whatever their names (:func:`apply` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwater.llm.common import BLANKS, whole_rows

MIN_DOCUMENTS = 10
MIN_LENGTH = 1
#: Ranges that the documents of one line are spread over; a power of two.
SPREADS = 64
WORD_BITS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines(text: Column) -> Column:
    r"""The lines of a text, split at ``\n``; a NULL text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key(line: Column) -> Column:
    """What decides whether two lines are the same."""
    plain = F.octet_length(line) == F.char_length(line)
    lowered = F.when(plain, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))
    return F.btrim(lowered, F.lit(BLANKS))


def _document(doc_id: Column, text: Column) -> list[Column]:
    """Two hashes that stand for a document's id and text."""
    return [F.xxhash64(doc_id, text).alias("d1"), F.xxhash64(F.lit(11), doc_id, text).alias("d2")]


def hashed_lines(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(h1, h2, doc_id, d1, d2, pos): one row per line whose key is long enough."""
    found = docs.select("doc_id", *_document(F.col("doc_id"), F.col("text")), lines(F.col("text")).alias("lines"))
    told = found.select("doc_id", "d1", "d2", F.posexplode("lines").alias("pos", "line"))
    keyed = told.select("doc_id", "d1", "d2", "pos", key(F.col("line")).alias("key"))
    if min_length > 0:
        keyed = keyed.where(F.char_length("key") >= min_length)
    return keyed.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(23), "key").alias("h2"), "doc_id", "d1", "d2", "pos"
    )


def dropped_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, keep: str = "none", min_length: int = MIN_LENGTH
) -> DataFrame:
    """(d1, d2, pos) of every line that goes."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be none or first, not {keep!r}")
    spread = F.col("d1").bitwiseAND(SPREADS - 1).cast("smallint")
    ranged = hashed_lines(docs, min_length).withColumn("spread", spread).repartitionByRange("h1", "h2", "spread")
    place = [F.col("doc_id").asc_nulls_last(), "d1", "d2", "pos"]
    whole = Window.partitionBy("h1", "h2", "spread")
    stream = whole.orderBy(*place)
    before = lambda name: F.lag(name).over(stream)
    opens = before("d1").isNull() | (before("d1") != F.col("d1")) | (before("d2") != F.col("d2"))
    streamed = ranged.withColumns({"opens": opens.cast("int"), "nth": F.row_number().over(stream)})
    streamed = streamed.withColumn("documents", F.sum("opens").over(whole))

    # the head of a range speaks for it; rows that need no other range to be judged stay out of the way
    head = F.col("nth") == 1
    settled = ~head if keep == "first" else ~head & (F.col("documents") >= min_documents)
    line = Window.partitionBy("h1", "h2", "aside")
    if keep == "first":
        stays = F.row_number().over(line.orderBy(*place)) == 1
    else:
        stays = F.sum(F.when(head, F.col("documents"))).over(line) < min_documents
    judged = streamed.withColumn("aside", F.when(settled, F.hash("d1", "d2")))
    judged = judged.withColumn("stays", F.col("aside").isNull() & stays)
    return judged.where(~F.col("stays")).select("d1", "d2", "pos")


def bitmaps(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, keep: str = "none", min_length: int = MIN_LENGTH
) -> DataFrame:
    """(d1, d2, n_dropped, bitmap), one row per document that loses lines."""
    gone = dropped_lines(docs, min_documents, keep, min_length)
    word = F.expr(f"CAST(pos DIV {WORD_BITS} AS INT)").alias("word")
    bit = F.expr(f"shiftleft(1L, pos % {WORD_BITS})")
    words = gone.groupBy("d1", "d2", word).agg(F.bit_or(bit).alias("dropped"))
    gathered = words.groupBy("d1", "d2").agg(
        F.sum(F.bit_count("dropped")).cast("bigint").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", "dropped"))).alias("words"),
    )
    before = "IF(i = 0, -1, words[i - 1].word)"
    bitmap = F.expr(f"transform(words, (e, i) -> struct(e.word - {before} - 1 AS skip, e.dropped AS dropped))")
    return gathered.select("d1", "d2", "n_dropped", bitmap.alias("bitmap"))


def kept_lines(text: Column, bitmap: Column) -> Column:
    """The lines of ``text`` that ``bitmap`` leaves in place."""
    dense = F.flatten(
        F.transform(bitmap, lambda e: F.concat(F.array_repeat(F.lit(0).cast("bigint"), e["skip"]), F.array(e["dropped"])))
    )

    def stays(words: Column, at: Column) -> Column:
        word = F.get(words, F.floor(at / WORD_BITS).cast("int"))
        return F.getbit(F.coalesce(word, F.lit(0).cast("bigint")), at % WORD_BITS) == 0

    # bound by a lambda, the words are unpacked once a text and not once a line
    return F.get(
        F.transform(F.array(dense), lambda words: F.filter(lines(text), lambda _, at: stays(words, at))), F.lit(0)
    )


def marked(docs: DataFrame, rows: DataFrame, **rule) -> DataFrame:
    """``rows`` (with columns doc_id and text, derived from ``docs``) beside n_lines, n_dropped, bitmap and kept text.

    The bitmap of a document that keeps all its lines is empty. ``rule``: see :func:`bitmaps`.
    """
    told = rows.select("*", *_document(F.col("doc_id"), F.col("text")))
    joined = told.join(bitmaps(docs, **rule), ["d1", "d2"], "left").drop("d1", "d2")
    kept = F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(
        F.array_join(kept_lines(F.col("text"), F.col("bitmap")), "\n")
    )
    none = F.array().cast("array<struct<skip:int,dropped:bigint>>")
    return joined.select(
        *rows.columns, F.size(lines(F.col("text"))).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"),
        F.coalesce("bitmap", none).alias("bitmap"), kept.alias("kept_text"),
    )


def apply(docs: DataFrame, **rule) -> DataFrame:
    """``docs`` with the lines that stay as text; all rows and other columns stay as they are (a NULL text too)."""
    held = docs.select(F.col("doc_id"), F.col("text"), whole_rows(docs).alias("_row"))
    swapped = F.col("_row").withField("text", F.col("kept_text"))
    return marked(docs, held, **rule).select(swapped.alias("_row")).select("_row.*")


def digest(docs: DataFrame, **rule) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 and the bitmap of each row of ``docs``."""
    out = marked(docs, docs.select("doc_id", "text"), **rule)
    sha = F.sha2(F.coalesce("kept_text", F.lit("")), 256)
    return out.select("doc_id", "n_lines", "n_dropped", sha.alias("kept_sha256"), "bitmap")
