"""Partition-level writes: staged swap and commit markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.refresh import overwrite_partitions


class RangeMismatch(RuntimeError):
    """Staged rows do not belong to the partition they should replace."""


def swap_partition(staged: DataFrame, table: str, part: str, value: str) -> None:
    """Replace one partition by staged rows, all of which must belong to it.

    No staged rows leave the partition empty.
    """
    outside = staged.filter(~F.col(part).eqNullSafe(F.lit(value)))
    if not outside.isEmpty():
        raise RangeMismatch(f"staged rows outside {part}={value}")
    overwrite_partitions(staged, table, touched=[{part: value}])


def committable(partitions: DataFrame, watermark: Column | None, delay: str,
                part_time: str, now: Column | None = None, created: str | None = None) -> DataFrame:
    """Partitions ready to be announced.

    By partition time: the watermark passed partition time plus ``delay``. By
    process time: ``now`` passed creation plus ``delay`` (none means at once).
    """
    if watermark is not None:
        return partitions.filter(watermark > F.col(part_time) + F.expr(delay))
    return partitions.filter(now >= F.col(created) + F.expr(delay))


def mark_success(spark: SparkSession, folder: str) -> None:
    """Write the ``_SUCCESS`` marker through the file system the folder lives on."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    path.getFileSystem(conf).create(path, True).close()


def commit_partitions(spark: SparkSession, table: str, specs: list[dict],
                      folders: list[str]) -> None:
    """Announce partitions: catalog entries, then the success files in ``folders``."""
    for i in range(0, len(specs), 200):
        parts = " ".join(
            "PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in spec.items()) + ")"
            for spec in specs[i:i + 200]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    for folder in folders:
        mark_success(spark, folder)
