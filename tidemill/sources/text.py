"""Delimited text, CSV and line readers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",",
              line_sep: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("sep", sep)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.csv(path)


def quoted_csv(spark: SparkSession, path: str, file_schema: str, columns: list[str],
               quote: str = '"') -> DataFrame:
    """Header skipped, blanks around values trimmed; the file may have more columns."""
    rows = (
        spark.read.schema(file_schema)
        .options(header=True, quote=quote, ignoreLeadingWhiteSpace=True,
                 ignoreTrailingWhiteSpace=True, enforceSchema=True)
        .csv(path).select(*columns)
    )
    return rows.select(*[
        F.trim(c).alias(c) if dtype == "string" else F.col(c) for c, dtype in rows.dtypes
    ])


def lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Lines of text files in at least ``min_partitions`` tasks; more if the files give more."""
    rows = spark.read.option("lineSep", "\n").text(path)
    if min_partitions and rows.rdd.getNumPartitions() < min_partitions:
        return rows.repartition(min_partitions)
    return rows


def parse_lines(df: DataFrame, text: str, fields: dict[str, str], sep: str = ",") -> DataFrame:
    """Records of at least ``len(fields)`` parts; blank and short lines are skipped.

    A part that does not fit its type becomes null.
    """
    parts = F.split(F.trim(F.col(text)), sep)
    good = df.filter((F.trim(F.col(text)) != "") & (F.size(parts) >= len(fields)))
    return good.select(*[
        F.trim(parts[i]).try_cast(dtype).alias(name)
        for i, (name, dtype) in enumerate(fields.items())
    ])


class PartitionOutOfRange(RuntimeError):
    """A row belongs to none of the partitions named in the load."""


def load_columns(df: DataFrame, derived: dict[str, Column], where: Column | None,
                 part: str, partitions: list[str]) -> DataFrame:
    """Derived columns, filter, then only the named partitions; others fail the load."""
    rows = df.withColumns(derived)
    if where is not None:
        rows = rows.filter(where)
    outside = F.raise_error(F.concat(F.lit("row outside the named partitions: "), F.col(part)))
    return rows.withColumn(
        part, F.when(F.col(part).isin(*partitions), F.col(part)).otherwise(outside)
    )


def sequence_values(spark: SparkSession, path: str) -> DataFrame:
    """Values of a SequenceFile of text as ``value``.

    Spark SQL reads this format only through Hive tables, so the Hadoop reader
    is used and the rows go straight back into a DataFrame.
    """
    rdd = spark.sparkContext.sequenceFile(path)
    return rdd.map(lambda kv: (kv[1],)).toDF("value string")


def write_sequence_values(df: DataFrame, path: str) -> None:
    (df.selectExpr("cast(value AS string) AS value").rdd
     .map(lambda r: ("", r["value"])).saveAsSequenceFile(path))
