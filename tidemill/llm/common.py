"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = "\t\n\x0b\x0c\r "


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` to a new folder below ``spark.checkpoint.dir`` and read it again.

    Cuts the lineage: what follows survives lost executors and sees fixed rows. ``options`` are
    the writer's.
    """
    path = work_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the quick path of ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def own_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), 0)
