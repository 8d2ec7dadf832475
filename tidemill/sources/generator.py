"""Seeded synthetic columns: every value is a function of the row id and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def number(row_id: Column, seed: str, low: int, high: int) -> Column:
    """Whole number in ``[low, high]``."""
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(seed), row_id.cast("string")).cast("binary")), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % (high - low + 1) + low).cast("bigint")


def text(row_id: Column, seed: str, length: int) -> Column:
    """Hex text of ``length`` (at most 32) characters."""
    return F.substring(
        F.md5(F.concat_ws(":", F.lit(seed), row_id.cast("string")).cast("binary")), 1, length
    )


def pick(row_id: Column, seed: str, values: list[str]) -> Column:
    return F.element_at(
        F.array(*[F.lit(v) for v in values]), number(row_id, seed, 1, len(values)).cast("int")
    )


def batch_rows(spark: SparkSession, rows: int, fields: dict[str, Column], start: int = 0
               ) -> DataFrame:
    """``rows`` rows whose ``fields`` are expressions over ``id``."""
    return spark.range(start, start + rows).select("id", *[c.alias(n) for n, c in fields.items()])


def stream_rows(spark: SparkSession, rows_per_second: int, fields: dict[str, Column],
                rows: int | None = None) -> DataFrame:
    """The same fields over a rate stream, ending after ``rows`` ids when given."""
    ids = (
        spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
        .withColumnRenamed("value", "id")
    )
    if rows is not None:
        ids = ids.filter(F.col("id") < rows)
    return ids.select("id", "timestamp", *[c.alias(n) for n, c in fields.items()])


def packages(waybills: DataFrame, code: str, per_waybill: int = 5) -> DataFrame:
    """``per_waybill`` package rows per waybill with generated state columns."""
    rows = waybills.select(
        F.col(code).alias("waybill_code"),
        F.explode(F.sequence(F.lit(1), F.lit(per_waybill))).alias("package_no"),
    )
    pid = F.concat_ws("-", F.col("waybill_code").cast("string"), F.col("package_no").cast("string"))
    return rows.select(
        "waybill_code", "package_no", pid.alias("package_code"),
        number(pid, "site", 1, 500).alias("site_code"),
        pick(pid, "state", ["sorted", "loaded", "sent", "delivered"]).alias("state"),
    )
