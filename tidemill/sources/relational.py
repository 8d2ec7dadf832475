"""Option builders for relational databases over JDBC (no server is contacted here)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_options(url: str, table: str, user: str, password: str, *,
                  split_on: str | None = None, low: int | None = None, high: int | None = None,
                  splits: int | None = None, fetch: int = 10000) -> dict[str, str]:
    """A bounded scan, read in ``splits`` ranges of ``split_on`` when given."""
    opts = {"url": url, "dbtable": table, "user": user, "password": password,
            "fetchsize": str(fetch)}
    if split_on is not None:
        if None in (low, high, splits):
            raise ValueError("split_on needs low, high and splits")
        opts |= {"partitionColumn": split_on, "lowerBound": str(low), "upperBound": str(high),
                 "numPartitions": str(splits)}
    return opts


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_table(df: DataFrame, options: dict[str, str], batch: int = 5000) -> None:
    df.write.format("jdbc").options(**options).option("batchsize", batch).mode("append").save()
