"""Message-log source: reader options, decoding, encoding and start positions.

Everything but :func:`read_messages` works on any frame with the columns
``key, value, topic, partition, offset, timestamp``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def reader_options(servers: str, topic: str | None = None, start: str = "earliest",
                   end: str | None = None, offsets: dict[int, int] | None = None,
                   since_ms: int | None = None, partitions: list[int] | None = None,
                   group: str | None = None) -> dict[str, str]:
    """Options of Spark's ``kafka`` source for the ways a topic can be opened."""
    opts = {"kafka.bootstrap.servers": servers}
    if partitions is not None:
        opts["assign"] = json.dumps({topic: partitions})
    else:
        opts["subscribe"] = topic
    if since_ms is not None:
        opts["startingTimestamp"] = str(since_ms)
    elif offsets is not None:
        opts["startingOffsets"] = json.dumps({topic: {str(k): v for k, v in offsets.items()}})
    else:
        opts["startingOffsets"] = start
    if end is not None:
        opts["endingOffsets"] = end
    if group is not None:
        opts["kafka.group.id"] = group
    return opts


def read_messages(spark: SparkSession, options: dict[str, str], stream: bool) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load()


def decode(messages: DataFrame, schema: str, fmt: str = "json",
           key_name: str | None = None) -> DataFrame:
    """Columns of ``schema`` from the value, plus key and metadata columns."""
    value = F.col("value").cast("string")
    meta = [F.col("topic"), F.col("partition").alias("event_partition"),
            F.col("offset").alias("event_offset"), F.col("timestamp").alias("event_time")]
    keys = [F.col("key").cast("string").alias(key_name)] if key_name else []
    if fmt == "raw":
        return messages.select(*keys, value.alias("doc"), *meta)
    parse = F.from_json if fmt == "json" else F.from_csv
    return messages.select(*keys, parse(value, schema).alias("v"), *meta).select(
        *[k for k in ([key_name] if key_name else [])], "v.*", "topic", "event_partition",
        "event_offset", "event_time",
    )


def encode(df: DataFrame, key: str | Column, columns: list[str] | None = None) -> DataFrame:
    """``key`` as text, the row as JSON ``value``."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(
        key.cast("string").alias("key"), F.to_json(F.struct(*(columns or df.columns))).alias("value")
    )


def first_offsets(messages: DataFrame, since: Column) -> DataFrame:
    """Per partition the first offset whose timestamp is not before ``since``."""
    return messages.filter(F.col("timestamp") >= since).groupBy("topic", "partition").agg(
        F.min("offset").alias("offset")
    )


def from_offsets(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """Messages at or after the start offset of their partition, up to the end."""
    s = starts.withColumnRenamed("offset", "__start")
    return messages.join(s, ["topic", "partition"]).filter(
        F.col("offset") >= F.col("__start")
    ).drop("__start")
