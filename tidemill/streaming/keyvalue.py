"""Key-value stream sink with a time to live per row (Python Data Source API).

Rows ``(key, value, ttl)`` are buffered and flushed after ``flush_rows`` rows or
``flush_seconds``. A batch becomes visible through one commit file naming the
part files of its successful tasks; retried or aborted tasks leave none.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

from tidemill.operators.tables import latest_per_key


def _system(path: str):
    from pyarrow import fs

    if "://" not in path:
        raise ValueError(f"{path} has no scheme; see tidemill.session.qualified")
    return fs.FileSystem.from_uri(path)


@dataclass
class PartWritten(WriterCommitMessage):
    file: str
    rows: int
    flushes: int


class KeyValueWriter(DataSourceStreamWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.flush_rows = int(options.get("flush_rows", "10"))
        self.flush_seconds = float(options.get("flush_seconds", "30"))
        self.now_ms = options.get("now_ms")

    def write(self, iterator):
        system, root = _system(self.path)
        system.create_dir(f"{root}/parts", recursive=True)
        name = f"{uuid.uuid4().hex}.json"
        buffer, rows, flushes, last = [], 0, 0, time.monotonic()
        with system.open_output_stream(f"{root}/parts/{name}") as out:
            def flush():
                out.write("".join(buffer).encode())
                buffer.clear()

            for row in iterator:
                now = int(self.now_ms) if self.now_ms else int(time.time() * 1000)
                expire = None if row["ttl"] is None else now + int(row["ttl"]) * 1000
                buffer.append(json.dumps({
                    "key": row["key"], "value": row["value"], "seq": row["seq"],
                    "expire_at": expire}) + "\n")
                rows += 1
                if (len(buffer) >= self.flush_rows
                        or time.monotonic() - last >= self.flush_seconds):
                    flush()
                    flushes += 1
                    last = time.monotonic()
            if buffer:
                flush()
                flushes += 1
        return PartWritten(name, rows, flushes)

    def commit(self, messages, batchId):
        system, root = _system(self.path)
        system.create_dir(f"{root}/commits", recursive=True)
        parts = [m.file for m in messages if m is not None and m.rows]
        with system.open_output_stream(f"{root}/commits/{batchId}.json") as out:
            out.write(json.dumps({"batch": batchId, "parts": parts}).encode())

    def abort(self, messages, batchId):
        """Uncommitted parts are never read."""


class KeyValueSink(DataSource):
    @classmethod
    def name(cls):
        return "tidemill_kv"

    def streamWriter(self, schema, overwrite):
        return KeyValueWriter(dict(self.options))


def committed_entries(spark: SparkSession, path: str) -> DataFrame:
    """All committed entries with the batch they came in."""
    commits = spark.read.schema("batch long, parts array<string>").json(f"{path}/commits")
    listed = commits.select("batch", F.explode("parts").alias("part"))
    rows = spark.read.schema("key string, value string, seq long, expire_at long").json(
        f"{path}/parts").withColumn("part", F.col("_metadata.file_name"))
    return rows.join(listed, "part").drop("part")


def live_values(spark: SparkSession, path: str, now_ms: int) -> DataFrame:
    """Latest value per key that has not expired at ``now_ms``."""
    rows = latest_per_key(committed_entries(spark, path), ["key"], ["seq", "batch"])
    alive = F.col("expire_at").isNull() | (F.col("expire_at") > now_ms)
    return rows.filter(alive).select("key", "value", "expire_at")
