"""Contiguous shards of near-equal bytes from global prefix sums.

Rows (id, size and checksum; no text) are range-sorted by id. The totals of the sorted partitions
give every partition the bytes that lie before it, and a task adds its rows to that while it reads
them. A row belongs to the shard in whose stretch of the total its middle byte falls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import stored

SHARDS = 8


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32``: bytes of the text plus one, and its CRC-32."""
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(data) + 1).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: shards follow the order of the ids.

    Null ids come first; equal ids follow checksum, size and the order read, so one id on very many
    rows is cut like any other stretch. A null text has size 1. With fewer rows than shards, some
    shards are empty. ``slot`` counts the rows of a shard from 0.
    """
    rows = stored(sizes(docs, id_col, text_col).withColumn(
        "at", F.monotonically_increasing_id()), "sizes")
    order = ["doc_id", "text_crc32", "size", "at"]
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size, count = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            ends = np.cumsum(batch.column(1).to_numpy()) + size
            before = ends - batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.full(n, part, np.int32)), pa.array(before),
                 pa.array(np.arange(count, count + n))],
                ["doc_id", "size", "text_crc32", "part", "bytes", "rows"])
            size, count = int(ends[-1]) if n else size, count + n

    ranged = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("doc_id", "size", "text_crc32").mapInArrow(
            run, f"doc_id {kind}, size bigint, text_crc32 bigint, part int, bytes bigint, "
                 "rows bigint"), "ranged")
    # one row per partition, added up on the driver
    totals = ranged.groupBy("part").agg(F.sum("size"), F.count("*")).collect()
    starts, total, count = [], 0, 0
    for part, size, n in sorted(totals):
        starts.append((part, total, count))
        total, count = total + size, count + n
    base = docs.sparkSession.createDataFrame(starts, "p int, bytes_before long, rows_before long")
    # the base has one row per partition of the sort, so it may be broadcast
    placed = ranged.join(F.broadcast(base), F.col("part") == F.col("p")).select(
        "doc_id", "size", "text_crc32", (F.col("rows") + F.col("rows_before")).alias("place"),
        F.expr(f"cast(least({shards - 1}, ((bytes + bytes_before) * 2 + size) * {shards} "
               f"div {2 * max(total, 1)}) as int)").alias("shard"))
    placed = stored(placed, "placed")
    firsts = dict(map(tuple, placed.groupBy("shard").agg(F.min("place")).collect()))
    first = F.coalesce(*[F.when(F.col("shard") == k, v) for k, v in firsts.items()], F.lit(0))
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("place") - first).cast(
        "long").alias("slot"))
