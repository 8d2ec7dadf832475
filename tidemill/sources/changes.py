"""Decoding change records of databases into op rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _row(source: Column, schema: T.StructType, fallback: Column | None = None) -> Column:
    """Struct of typed columns from a text map; absent names come from ``fallback``."""
    cols = []
    for f in schema.fields:
        text = F.try_element_at(source, F.lit(f.name))
        if fallback is not None:
            text = F.when(F.map_contains_key(source, f.name), text).otherwise(
                F.try_element_at(fallback, F.lit(f.name))
            )
        cols.append(text.try_cast(f.dataType).alias(f.name))
    return F.struct(*cols)


def _op(kind: str, row: Column) -> Column:
    return F.struct(F.lit(kind).alias("op"), row.alias("row"))


def decode_row_images(df: DataFrame, text: str, schema: str, seq: str) -> DataFrame:
    """Records ``{type, data: [...], old: [...]}`` with several rows each.

    ``old`` lists only changed fields, so an update's old row is the new row
    overlaid with it. Result columns: ``op``, ``seq``, then those of ``schema``.
    """
    struct = T._parse_datatype_string(schema)
    parsed = df.withColumn("__m", F.from_json(
        text, "type STRING, data ARRAY<MAP<STRING,STRING>>, old ARRAY<MAP<STRING,STRING>>"
    ))
    pairs = parsed.select(
        F.col(seq).alias("seq"), F.col("__m.type").alias("type"),
        F.posexplode("__m.data").alias("i", "new"), F.col("__m.old").alias("olds"),
    ).withColumn("old", F.coalesce(F.get("olds", F.col("i")),
                                   F.create_map().cast("map<string,string>")))
    new = _row(F.col("new"), struct)
    old = _row(F.col("old"), struct, F.col("new"))
    ops = (
        F.when(F.col("type") == "INSERT", F.array(_op("+I", new)))
        .when(F.col("type") == "DELETE", F.array(_op("-D", new)))
        .when(F.col("type") == "UPDATE", F.array(_op("-U", old), _op("+U", new)))
    )
    return pairs.select("seq", F.explode(ops).alias("c")).select("c.op", "seq", "c.row.*")


def decode_before_after(df: DataFrame, text: str, schema: str, seq: str) -> DataFrame:
    """Records ``{op: c|r|u|d, before: {...}, after: {...}}``."""
    parsed = df.select(
        F.col(seq).alias("seq"),
        F.from_json(
            text, f"op STRING, before STRUCT<{schema}>, after STRUCT<{schema}>"
        ).alias("m"),
    )
    before, after = F.col("m.before"), F.col("m.after")
    ops = (
        F.when(F.col("m.op").isin("c", "r"), F.array(_op("+I", after)))
        .when(F.col("m.op") == "d", F.array(_op("-D", before)))
        .when(F.col("m.op") == "u", F.array(_op("-U", before), _op("+U", after)))
    )
    return parsed.select("seq", F.explode(ops).alias("c")).select("c.op", "seq", "c.row.*")
