"""Starting streams: settings, bounded runs, and reading back what they wrote."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemill.session import use_rocksdb_state, work_dir

_PARTITIONS = "spark.sql.shuffle.partitions"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def stream_settings(spark: SparkSession, rocksdb: bool = False,
                    state_partitions: int | None = None, **extra: str):
    """Settings a query keeps from its start; the session gets its own back.

    State has one store per shuffle partition for the life of the query. The session's number is
    taken unless ``state_partitions`` names one.
    """
    wanted = {} if state_partitions is None else {_PARTITIONS: str(state_partitions)}
    wanted |= {k.replace("__", "."): v for k, v in extra.items()}
    keys = [*wanted, _PROVIDER]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    if rocksdb:
        use_rocksdb_state(spark)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_to_files(df: DataFrame, label: str, checkpoint: str | None = None,
                 out: str | None = None, rocksdb: bool = False, **settings: str) -> DataFrame:
    """Append all available input to Parquet files and return them as a batch frame."""
    spark = df.sparkSession
    root = work_dir(spark, label)
    out = out or f"{root}/data"
    with stream_settings(spark, rocksdb, **settings):
        query = (
            df.writeStream.outputMode("append").format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint or f"{root}/checkpoint")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def run_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], label: str,
                mode: str = "append", checkpoint: str | None = None,
                rocksdb: bool = False, **settings: str) -> None:
    """Give every micro-batch of the available input to ``handle(batch, batch_id)``."""
    spark = df.sparkSession
    with stream_settings(spark, rocksdb, **settings):
        query = (
            df.writeStream.outputMode(mode).foreachBatch(handle)
            .option("checkpointLocation", checkpoint or f"{work_dir(spark, label)}/checkpoint")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()


def run_until_quiet(df: DataFrame, label: str, checkpoint: str | None = None,
                    out: str | None = None, **settings: str) -> DataFrame:
    """As :func:`run_to_files`, for sources that end a batch themselves.

    An available-now trigger asks a source for its end once and stops there; here batches follow
    each other until one finds nothing new.
    """
    spark = df.sparkSession
    root = work_dir(spark, label)
    out = out or f"{root}/data"
    with stream_settings(spark, **settings):
        query = (
            df.writeStream.outputMode("append").format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint or f"{root}/checkpoint").start()
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return spark.read.schema(df.schema).parquet(out)
