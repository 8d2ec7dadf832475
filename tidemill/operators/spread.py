"""Spreading rows over tasks: salting, two-phase aggregates, sorted layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted(df: DataFrame, keys: list[str], row_id: list[str], salts: int,
           partitions: int | None = None) -> DataFrame:
    """Hash-distribute on keys and a salt taken from ``row_id``.

    The salt is a function of the row, not ``rand()``, so a retried task after
    a lost executor sends every row to the same place again.
    """
    salt = F.pmod(F.xxhash64(*row_id), F.lit(salts))
    cols = [*[F.col(k) for k in keys], salt]
    return df.repartition(partitions, *cols) if partitions else df.repartition(*cols)


def two_phase(df: DataFrame, keys: list[str], row_id: list[str], salts: int,
              partial: list[Column], final: list[Column]) -> DataFrame:
    """Aggregate per (key, salt), then per key over the partial rows."""
    salt = F.pmod(F.xxhash64(*row_id), F.lit(salts)).alias("__salt")
    return df.groupBy(*keys, salt).agg(*partial).groupBy(*keys).agg(*final)


def distribute_sort(df: DataFrame, by: list[str], sort: list[Column],
                    partitions: int | None = None) -> DataFrame:
    """``DISTRIBUTE BY by SORT BY by, sort`` without a one-task-per-key limit.

    Range partitioning on the keys and the sort columns keeps the rows of a key
    in neighbouring partitions, sorted within and across them; a key larger
    than a partition spills into the next one.
    """
    cols = [*[F.col(c) for c in by], *sort]
    spread = (
        df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    )
    return spread.sortWithinPartitions(*cols)


def cluster_by(df: DataFrame, by: list[str], tie: list[str]) -> DataFrame:
    """``CLUSTER BY by``; ``tie`` columns decide where a large key is split."""
    return distribute_sort(df, by, [F.col(c) for c in tie])


def rebalanced(df: DataFrame, *cols: str) -> DataFrame:
    """Group rows for a partitioned write; adaptive execution splits hot values.

    One task then writes few partition folders, and a folder holding a third of
    the rows is written by several tasks of about the advisory size.
    """
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")
