"""Exact distinct counts through dictionaries and bitmaps, and bounded lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordered import row_numbers


def extend_dictionary(existing: DataFrame, keys: DataFrame, key: str, id_col: str) -> DataFrame:
    """``(key, id)`` with dense new ids after the largest old one; old ids are kept.

    Only unseen keys are numbered. They are ordered by a 4-digit hash prefix and
    the key, so numbering runs inside 65536 hash chunks and only the chunk counts
    meet in one place.
    """
    unseen = keys.select(key).filter(F.col(key).isNotNull()).distinct().join(
        existing.select(key), key, "left_anti"
    )
    prefix = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 4)
    start = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    fresh = row_numbers(
        unseen.withColumn("__p", prefix), [], [F.col("__p"), F.col(key)], [F.col("__p")], "__n"
    ).select(key, (F.col("__n") + start).cast("bigint").alias(id_col))
    return existing.select(key, F.col(id_col).cast("bigint").alias(id_col)).unionByName(fresh)


#: A bitmap of fewer ids than this is stored as sorted offsets of two bytes, else as bits.
SPARSE_IDS = 2048
_BITS, _WORD = 32_768, 64
_DENSE_BYTES = _BITS // 8
#: Bit of a word for the offset ``__at``: the word's bytes then read in the order of a bitmap's.
_BIT = "shiftleft(1L, CAST(56 - 8 * ((__at % 64) div 8) + __at % 8 AS INT))"


def _place(offset: Column) -> Column:
    """Bit of a word that stands for an offset, so that the word's bytes read in bitmap order."""
    return F.lit(56) - 8 * F.floor(offset % _WORD / 8).cast("int") + (offset % 8).cast("int")


def _word_offsets(entry: Column) -> Column:
    within = F.filter(F.sequence(F.lit(0), F.lit(_WORD - 1)),
                      lambda o: F.getbit(entry["word_bits"], _place(o)) == 1)
    return F.transform(within, lambda o: entry["word"] * _WORD + o)


def _stored(words: Column, n: Column) -> Column:
    """Bytes of a bitmap from its sorted ``(word, word_bits)`` list of ``n`` ids."""
    offsets = F.flatten(F.transform(words, _word_offsets))
    sparse = F.transform(offsets, lambda o: F.lpad(F.hex(o), 4, "0"))
    by_word = F.map_from_entries(words)
    every = F.sequence(F.lit(0), F.lit(_BITS // _WORD - 1))
    dense = F.when(F.size(words) == _BITS // _WORD, F.transform(words, lambda w: w["word_bits"])) \
        .otherwise(F.transform(every, lambda w: F.coalesce(by_word[w], F.lit(0).cast("long"))))
    dense = F.transform(dense, lambda w: F.lpad(F.hex(w), 16, "0"))
    return F.unhex(F.array_join(F.when(n < SPARSE_IDS, sparse).otherwise(dense), ""))


def _containers(words: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One bitmap per key and bucket of rows ``(keys, bucket, word, word_bits)``."""
    listed = words.groupBy(*keys, "bucket").agg(
        F.array_sort(F.collect_list(F.struct("word", "word_bits"))).alias("__words"),
        F.sum(F.bit_count("word_bits")).alias("__n"))
    return listed.select(*keys, "bucket", _stored(F.col("__words"), F.col("__n")).alias(name))


def _part(bits: Column, first: Column, size: int) -> Column:
    """``size`` bytes from byte ``first`` (from 1) as a number."""
    return F.conv(F.hex(F.substring(bits, first, F.lit(size))), 16, 10)


def _offsets(bits: Column) -> Column:
    """Offsets of a bitmap stored as such."""
    at = F.sequence(F.lit(1), F.octet_length(bits) - 1, F.lit(2))
    return F.when(F.octet_length(bits) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(at, lambda i: _part(bits, i, 2).cast("int")))


def _is_dense(bits: Column) -> Column:
    return F.octet_length(bits) == _DENSE_BYTES


def _sparse_words(df: DataFrame, keep: list[str], name: str) -> DataFrame:
    """``(keep, word, word_bits)`` of bitmaps stored as offsets: a row per id."""
    rows = df.where(~_is_dense(F.col(name))).select(
        *keep, F.explode(_offsets(F.col(name))).alias("__at"))
    return rows.select(*keep, F.floor(F.col("__at") / _WORD).cast("int").alias("word"),
                       F.expr(_BIT).alias("word_bits"))


def _dense_words(df: DataFrame, keep: list[str], name: str) -> DataFrame:
    """``(keep, word, word_bits)`` of bitmaps stored as bits: a row per word that holds an id."""
    bits = F.col(name)
    every = F.explode(F.sequence(F.lit(0), F.lit(_BITS // _WORD - 1)))
    # conv reads 64 bits unsigned; as text that may pass a long, so two halves are put together
    high, low = (_part(bits, F.col("word") * 8 + k, 4).cast("long") for k in (1, 5))
    return df.where(_is_dense(bits)).select(*keep, name, every.alias("word")).select(
        *keep, "word", F.shiftleft(high, 32).bitwiseOR(low).alias("word_bits")).where(
            "word_bits <> 0")


def _words(df: DataFrame, keep: list[str], name: str) -> DataFrame:
    """Words of 64 ids of every bitmap; the rows of a word are still to be put together."""
    return _sparse_words(df, keep, name).unionByName(_dense_words(df, keep, name))


def bitmap_rows(df: DataFrame, keys: list[str], id_col: str, name: str = "bits") -> DataFrame:
    """One bitmap per key and bucket of 32768 ids, as small as its ids allow.

    Ids meet in words of 64, with map-side combine, before they meet in a bitmap; a key of few ids
    costs two bytes an id.
    """
    words = (
        df.filter(F.col(id_col).isNotNull())
        .select(*keys, F.bitmap_bucket_number(id_col).alias("bucket"),
                F.bitmap_bit_position(id_col).cast("int").alias("__at"))
        .groupBy(*keys, "bucket", F.expr("__at div 64").cast("int").alias("word"))
        .agg(F.expr(f"bit_or({_BIT})").alias("word_bits"))
    )
    return _containers(words, keys, name)


def bitmap_union(df: DataFrame, keys: list[str], name: str = "bits") -> DataFrame:
    """One bitmap per key and bucket of what any input row holds; bitmaps of bits meet as such."""
    group = [*keys, "bucket"]
    dense = df.where(_is_dense(F.col(name))).groupBy(*group).agg(
        F.bitmap_or_agg(name).alias(name))
    words = _sparse_words(df, group, name).unionByName(_dense_words(dense, group, name))
    return _containers(words.groupBy(*group, "word").agg(
        F.bit_or("word_bits").alias("word_bits")), keys, name)


def bitmap_intersect(df: DataFrame, keys: list[str], name: str = "bits") -> DataFrame:
    """Ids present in every input row of a bucket; missing buckets must be absent ids.

    ``groups`` counts the bitmaps that met, so that callers can drop buckets
    some input does not have.
    """
    group = [*keys, "bucket"]
    # word -1 stands for the bitmap itself, so that its count is that of the bitmaps
    itself = df.select(*group, F.lit(-1).alias("word"), F.lit(0).cast("long").alias("word_bits"))
    own = df.withColumn("__row", F.monotonically_increasing_id())
    words = _words(own, [*group, "__row"], name).groupBy(*group, "__row", "word").agg(
        F.bit_or("word_bits").alias("word_bits")).drop("__row")
    met = words.unionByName(itself).groupBy(*group, "word").agg(
        F.bit_and("word_bits").alias("word_bits"), F.count(F.lit(1)).alias("__met"))
    listed = met.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("word", "word_bits", "__met"))).alias("__all"))
    groups = F.get("__all", F.lit(0))["__met"]
    kept = F.transform(
        F.filter("__all", lambda w: (w["word"] >= 0) & (w["__met"] == F.col("groups"))
                 & (w["word_bits"] != 0)),
        lambda w: F.struct(w["word"].alias("word"), w["word_bits"].alias("word_bits")))
    n = F.aggregate("__kept", F.lit(0).cast("long"),
                    lambda a, w: a + F.bit_count(w["word_bits"]))
    return listed.withColumn("groups", groups).withColumn("__kept", kept).select(
        *group, _stored(F.col("__kept"), n).alias(name), "groups")


def bitmap_counts(df: DataFrame, keys: list[str], out: str, name: str = "bits") -> DataFrame:
    bits = F.col(name)
    n = F.when(_is_dense(bits), F.bitmap_count(bits)).otherwise(
        F.floor(F.octet_length(bits) / 2).cast("long"))
    return df.groupBy(*keys).agg(F.sum(n).alias(out))


def bitmap_ids(df: DataFrame, keys: list[str], out: str, name: str = "bits") -> DataFrame:
    """The ids of every bitmap, one row each."""
    rows = _words(df, [*keys, "bucket"], name).select(
        *keys, "bucket", F.explode(_word_offsets(F.struct("word", "word_bits"))).alias("__at"))
    above = (F.col("bucket") - 1) * _BITS + F.col("__at") + 1
    return rows.select(*keys, F.when(F.col("bucket") > 0, above).otherwise(
        F.col("bucket") * _BITS - F.col("__at")).alias(out))


def distinct_list(df: DataFrame, keys: list[str], value: Column, name: str,
                  sep: str = ",") -> DataFrame:
    """Sorted distinct values of each group as one text, deduplicated before grouping.

    For values of a bounded domain; see :func:`list_parts` for open ones.
    """
    pairs = df.select(*keys, value.alias("__v")).filter(F.col("__v").isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(F.col("__v").cast("string"))), sep).alias(name)
    )


def list_parts(
    df: DataFrame,
    keys: list[str],
    value: str,
    order: list[Column],
    chunk: list[Column],
    name: str,
    size: int = 1000,
    sep: str = ",",
) -> DataFrame:
    """All values of each group in order, as texts of at most ``size`` values.

    Group lists have no bound, a row has one: part 1 holds values 1..size and so
    on, which keeps the list whole without a task or a row holding a hot group.
    """
    ranked = row_numbers(df, keys, order, chunk, "__pos")
    part = (F.floor((F.col("__pos") - 1) / size) + 1).cast("bigint")
    entry = F.struct(F.col("__pos").alias("p"), F.col(value).cast("string").alias("v"))
    return (
        ranked.groupBy(*keys, part.alias("part"))
        .agg(F.array_sort(F.collect_list(entry)).alias("__l"))
        .withColumn(name, F.array_join(F.col("__l.v"), sep))
        .withColumn("n", F.size("__l").cast("bigint"))
        .drop("__l")
    )
