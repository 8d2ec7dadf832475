"""Repeated lines: hashes range-partitioned, sorted by document and position, kept as bitmaps.

Only hashes, ids and positions move; text is read where it lies and meets its bitmap at the end.
A line's hash is 128 bits wide. Ranges are cut over (hash, document) and sorted by document and
position inside; a window over that order streams the first occurrence of a line in each document,
with no further shuffle. A line that a third of all documents hold is spread over many ranges, each
of which hands on one summary row of it: how many documents, and the largest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemill.llm.common import BLANKS, ascii_lower, let, own_names, stored

MIN_CHARS = 40
MIN_DOCS = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``h1, h2, doc_id, text_hash, pos`` of every line whose key is long enough."""
    lines = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
        F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
    keys = lines.where(F.length("line") >= min_chars).select(
        "doc_id", "text_hash", "pos", ascii_lower(F.btrim("line", F.lit(BLANKS))).alias("key"))
    return keys.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        "doc_id", "text_hash", "pos")


def first_occurrences(lines: DataFrame) -> DataFrame:
    """The row of ``line_hashes`` that comes first of its line and document, in sorted ranges.

    The window's groups are the ranges' own sort keys, so it reads the ranges as they are sorted.
    """
    ranged = lines.repartitionByRange("h1", "h2", "doc_id").sortWithinPartitions(
        "h1", "h2", "doc_id", "pos", "text_hash")
    order = W.partitionBy("h1", "h2", "doc_id").orderBy("pos", "text_hash")
    return ranged.withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")


def drop_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text_hash, dropped`` of documents that lose lines.

    ``dropped`` lists ``(word, bits)``: bit b of word w is line 64 w + b. Lines not listed are
    kept, so clean documents have no row and long ones only the words with a dropped line.
    """
    lines = stored(line_hashes(docs, id_col, text_col, min_chars), "lines")
    common = stored(
        first_occurrences(lines).groupBy(F.col("h1").alias("c1"), F.col("h2").alias("c2"))
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs), "common")
    gone = lines.join(common, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2"))).where(
        ~F.col("doc_id").eqNullSafe(F.col("keeper")))
    words = gone.groupBy("doc_id", "text_hash", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def _dense(dropped: Column) -> Column:
    """Sorted sparse words as an array of longs in which word w stands at w."""

    def padded(entry: Column, at: Column) -> Column:
        before = F.coalesce(F.get(dropped, at - 1)["word"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0).cast("long"), entry["word"] - before - 1),
                        F.array(entry["bits"]))

    return F.flatten(F.transform(dropped, padded))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with ``__n_lines``, ``__n_dropped`` and ``__kept`` (the text that stays).

    The three names get further underscores where ``docs`` has them already (``own_names``).
    """
    own, hashed, marked = own_names(docs, "marked_id", "marked_hash", "marked")
    marks = bitmaps.select(F.col("doc_id").alias(own), F.col("text_hash").alias(hashed),
                           F.col("dropped").alias(marked))
    joined = docs.join(marks, F.col(id_col).eqNullSafe(F.col(own))
                       & (F.xxhash64(text_col) == F.col(hashed)), "left")
    text, dropped = F.coalesce(F.col(text_col), F.lit("")), F.col(marked)

    def kept(words: Column, at: Column) -> Column:
        word = F.coalesce(F.get(words, F.floor(at / 64).cast("int")), F.lit(0))
        return F.getbit(word, at % 64) == 0

    rest = let(_dense(dropped), lambda words: F.array_join(
        F.filter(_lines(F.col(text_col)), lambda _, at: kept(words, at)), "\n"))
    count = F.aggregate(dropped, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["bits"]))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    n_lines, n_dropped, left = own_names(docs, "__n_lines", "__n_dropped", "__kept")
    return joined.select(
        *docs.columns, (breaks + 1).cast("long").alias(n_lines),
        F.coalesce(count, F.lit(0)).alias(n_dropped),
        F.when(dropped.isNull(), text).otherwise(rest).alias(left))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` as given by ``apply_bitmaps`` on ``drop_bitmaps`` of the same rows.

    A line's key is the line without outer blanks, A-Z in lower case. Keys of ``min_chars`` code
    points or more found in ``min_docs`` documents or more lose all their lines except in the
    document with the largest id. Null and empty texts are one empty line. Rows repeated under one
    id are one document, on both sides of the count. Rows with a null id are together one document
    that never keeps a common line. An empty table gives no rows.
    """
    return apply_bitmaps(docs, drop_bitmaps(docs, id_col, text_col, min_chars, min_docs),
                         id_col, text_col)
