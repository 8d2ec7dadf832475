"""Exact deduplication as a stateful stream over the files of a table.

The keyed state lives in RocksDB on the executors' disks with its changes in the shared checkpoint
folder, and never expires. For each digest it holds the row that stays (largest id, then place)
with the place of its bytes (file and row) and the number of rows. Rows are combined before they
reach the state, so a text that makes up a third of the input is a few rows per batch. A stream
that starts again on the same checkpoint folder reads only new files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import ascii_lower, stored
from tidemill.session import work_dir

#: Input bytes of one micro-batch; the state is asked once a batch for every digest in it.
BATCH_BYTES = 4 << 30
#: State on disk; only changes go to the shared folder; no disk is set aside for logs to come, which
#: would be megabytes for each state partition.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normal_text(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def _rows(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm, place = normal_text(F.col(text_col)), table.metadataColumn("_metadata")
    return table.select(
        F.col(id_col).alias("doc_id"), norm.alias("norm"), F.sha2(norm, 256).alias("digest"),
        place["file_path"].alias("file"), place["row_index"].alias("row"))


def _stream_path(spark: SparkSession, path: str) -> str:
    """A file stream takes a folder or a pattern; a single file becomes a pattern of itself."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return f"{path[:-1]}[{path[-1]}]" if system.getFileStatus(place).isFile() else path


def digest_stream(spark: SparkSession, path: str, log: str, checkpoint: str,
                  id_col: str = "doc_id", text_col: str = "text",
                  batch_bytes: int = BATCH_BYTES, files_per_batch: int | None = None) -> None:
    """Read all files of ``path`` not yet seen and append the changed states to ``log``."""
    source = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    else:
        source = source.option("maxBytesPerTrigger", batch_bytes)
    state = _rows(source.parquet(_stream_path(spark, path)), id_col, text_col).groupBy("digest").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("stays"), F.count("*").alias("size"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        query = (state.writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def states(spark: SparkSession, log: str) -> DataFrame:
    """``digest, stays, size``: the last state of each digest (both values only grow)."""
    return spark.read.parquet(log).groupBy("digest").agg(
        F.max("stays").alias("stays"), F.max("size").alias("size"))


def dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
          files_per_batch: int | None = None, batch_bytes: int = BATCH_BYTES,
          work: str | None = None) -> DataFrame:
    """One row per row of the Parquet table at ``path``:
    ``doc_id, keep_id, group_size, kept, digest``.

    Texts are equal when their bytes are after lower-casing A-Z; a null text is empty. Of equal
    texts the row with the largest id stays; rows that share it are told apart by file and row,
    so exactly one of each group is kept. Null ids are smaller than all others. Every hit's bytes
    are compared with those of the row that stays; a digest shared by different texts is then
    grouped by the texts themselves. An empty table gives no rows.

    ``work`` is a durable folder for the state's checkpoint and log: a later call on the same folder
    streams only files that came since, and meets the state of the earlier ones. Without it the
    stream starts on a new folder. Files are streamed ``batch_bytes`` (or ``files_per_batch``) at a
    time, and each batch after the first is looked up in the state of those before.
    """
    work = work or work_dir(spark, "dedup")
    table = _rows(spark.read.parquet(path), id_col, text_col)
    base = stored(table.drop("norm"), "digests")
    place = F.struct("doc_id", "file", "row")
    columns = ["doc_id", "keep_id", "group_size", "kept", "digest"]
    if base.isEmpty():
        return base.select("doc_id", F.col("doc_id").alias("keep_id"),
                           F.lit(0).cast("long").alias("group_size"),
                           F.lit(True).alias("kept"), "digest")
    digest_stream(spark, path, f"{work}/log", f"{work}/checkpoint", id_col, text_col,
                  batch_bytes, files_per_batch)
    known = stored(states(spark, f"{work}/log").select(
        F.col("digest").alias("key"), "stays", "size"), "states")
    out = base.join(known, base.digest == known.key).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        place.eqNullSafe(F.col("stays")).alias("kept"), "digest")

    # bytes of the hits against the bytes of the row that stays
    hits = stored(
        table.join(known.where("size > 1"), F.col("digest") == F.col("key"))
        .select("doc_id", "file", "row", "digest", "norm",
                place.eqNullSafe(F.col("stays")).alias("stays_here")), "hits")
    models = hits.where("stays_here").select(F.col("digest").alias("key"),
                                             F.col("norm").alias("model"))
    # stored as they are: made distinct at once, the copies of one text could not be split
    odd = stored(hits.join(models, F.col("digest") == F.col("key")).where(
        "norm <> model").select("digest"), "odd")
    if odd.isEmpty():
        return out
    odd = odd.distinct()
    exact = hits.join(odd, "digest", "left_semi")
    classes = exact.groupBy("digest", "norm").agg(
        F.max(place).alias("stays"), F.count("*").alias("size"))
    split = exact.join(classes, ["digest", "norm"]).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        place.eqNullSafe(F.col("stays")).alias("kept"), "digest")
    return out.join(odd, "digest", "left_anti").select(*columns).union(split.select(*columns))
