"""Table functions, text aggregates and keyed lookups as column compositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.columns import round_up_decimal
from tidemill.operators.joining import dict_mapping


def explode_csv(text: Column) -> Column:
    """One row per comma part; blank text gives none."""
    return F.explode(F.when(F.trim(text) != "", F.split(text, ",")))


def length_words(df: DataFrame, col: str) -> Column:
    """``array<struct<word, length>>`` chosen by the type of ``col``.

    Whole numbers from 5 on give ``num:<n>``, text gives itself, a double gives
    ``nums sum:<x>``, anything else ``obj:<x>``; nulls give an empty array.
    """
    kind = df.schema[col].dataType
    value = F.col(col)
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        word = F.when(value >= 5, F.concat(F.lit("num:"), value.cast("string")))
    elif isinstance(kind, T.StringType):
        word = value
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        word = F.concat(F.lit("nums sum:"), value.cast("string"))
    else:
        word = F.concat(F.lit("obj:"), value.cast("string"))
    return _word_rows(word)


def length_words_sum(*values: Column) -> Column:
    """The many-doubles form: one row with the sum."""
    total = values[0]
    for v in values[1:]:
        total = total + v
    return _word_rows(F.concat(F.lit("nums sum:"), total.cast("string")))


def _word_rows(word: Column) -> Column:
    entry = F.struct(word.alias("word"), F.length(word).alias("length"))
    return F.when(word.isNotNull(), F.array(entry)).otherwise(
        F.array().cast("array<struct<word:string,length:int>>")
    )


def generate_rows(ids: Column, names: Column, params: dict[str, str]) -> Column:
    """Rows ``(id, name, param...)`` from two arrays; parameters are constants."""
    return F.transform(
        F.arrays_zip(ids.alias("id"), names.alias("name")),
        lambda x: F.struct(
            x["id"].alias("id"), x["name"].alias("name"),
            *[F.lit(v).alias(k) for k, v in params.items()],
        ),
    )


def generate_numbered(count: Column, prefix: Column, params: dict[str, str]) -> Column:
    """Rows ``(id, name, param...)`` numbered from 1 to ``count``, none for 0 or less.

    ``name`` is the prefix and the number; both forms without arrays are this one, the plain form
    with ten rows and no prefix.
    """
    count = F.greatest(F.coalesce(count, F.lit(0)), F.lit(0)).cast("int")
    ids = F.slice(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), F.lit(1), count)
    return F.transform(ids, lambda i: F.struct(
        i.alias("id"), F.concat(prefix, i.cast("string")).alias("name"),
        *[F.lit(v).alias(k) for k, v in params.items()]))


def numbered_rows(spark: SparkSession, rows: int, prefix: str, params: dict[str, str]) -> DataFrame:
    """``rows`` generated rows ``<prefix><n>`` with the parameters as columns."""
    return spark.range(1, rows + 1).select(
        F.col("id").cast("int").alias("id"),
        F.concat(F.lit(prefix), F.col("id").cast("string")).alias("name"),
        *[F.lit(v).alias(k) for k, v in params.items()],
    )


def _joined(parts: tuple[Column, ...]) -> Column:
    """One part as text, several joined by ``-``."""
    texts = [p.cast("string") for p in parts]
    return F.concat_ws("-", *texts) if len(texts) > 1 else texts[0]


def unique_strings(df: DataFrame, keys: list[str], *parts: Column, **more: tuple) -> DataFrame:
    """``uniq``: ``struct(joined, items)`` of the distinct texts of each group, sorted.

    ``more`` names further columns with their parts; all come from one grouping, after rows with
    the same texts have been made one. For texts of a bounded domain.
    """
    wanted = {**({"uniq": parts} if parts else {}), **more}
    rows = df.select(*keys, *[_joined(p).alias(n) for n, p in wanted.items()]).distinct()
    lists = [F.array_sort(F.collect_set(n)).alias(n) for n in wanted]
    return rows.groupBy(*keys).agg(*lists).select(
        *keys, *[F.struct(F.array_join(n, ",").alias("joined"), F.col(n).alias("items")).alias(n)
                 for n in wanted])


def unique_strings_with_retract(changes: DataFrame, keys: list[str], text: Column, op: str
                                ) -> DataFrame:
    """``unique_strings`` of what is left after ``-U`` and ``-D`` rows have taken texts back.

    A text is listed while more rows brought it than took it. One that two rows brought therefore
    outlives the first that takes it, which a plain set would already drop.
    """
    sign = F.when(F.col(op).isin("-U", "-D"), -1).otherwise(1)
    held = changes.groupBy(*keys, text.cast("string").alias("__s")).agg(F.sum(sign).alias("__n"))
    return unique_strings(held.filter("__n > 0"), keys, F.col("__s"))


def score_lookup(df: DataFrame, store: DataFrame, name: str, id_col: str) -> DataFrame:
    """Score by ``num_<name>``, else by ``num_byid_<id>``, from a key-value table.

    ``use_which`` says which key decided; values follow the two-digit rule.
    """
    rows = df.withColumns({
        "__k1": F.when(F.trim(name) != "", F.concat(F.lit("num_"), F.col(name))),
        "__k2": F.concat(F.lit("num_byid_"), F.col(id_col).cast("string")),
    })
    rows = dict_mapping(rows, store, [("__k1", "key")], "value", "__v1")
    rows = dict_mapping(rows, store, [("__k2", "key")], "value", "__v2")
    first, second = round_up_decimal("__v1"), round_up_decimal("__v2")
    return rows.withColumns({
        "use_which": F.when(first.isNotNull(), "useName").otherwise("useId"),
        "score": F.coalesce(first, second),
    }).drop("__k1", "__k2", "__v1", "__v2")


def alias_search(df: DataFrame, store: DataFrame, id_col: str, prefix: str = "alias_"
                 ) -> DataFrame:
    """Inner lookup of ``<prefix><id>``: rows without a non-blank value are dropped."""
    rows = df.withColumn("key", F.concat(F.lit(prefix), F.col(id_col).cast("string")))
    return rows.join(store.filter(F.trim("value") != ""), "key")
