"""Read a table's state first and its changes from there on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.tables import as_of, between_commits
from tidemill.streaming.runner import run_batches
from tidemill.streaming.sinks import BatchLog


def snapshot_then_follow(changes: DataFrame, stream: DataFrame, keys: list[str], op: str,
                         commit: str, seq: list[str], at: Column, columns: list[str],
                         log: BatchLog, label: str) -> DataFrame:
    """The state after commit ``at`` as ``+I`` rows, then every change of later commits.

    ``at`` is the latest commit, a chosen one, or the last compacted one. The state is batch 0 of
    ``log`` and the commit it was taken at lies beside it; a restart goes on from that commit,
    whatever ``at`` it is given, so no change between two runs is lost. ``stream`` is the change
    log as a stream.
    """
    shown = [*keys, op, *columns]
    start = BatchLog(log.spark, f"{log.root}-start")
    if start.only(0) is None:
        start.write(log.spark.range(1).select(at.cast("long").alias("at")).coalesce(1), 0)
    at = F.lit(start.only(0).first()["at"])
    if log.only(0) is None:
        state = as_of(changes, keys, op, commit, seq, at, columns)
        log.write(state.select(*keys, F.lit("+I").alias(op), *columns), 0)
    later = between_commits(stream, commit, at).select(*shown)
    run_batches(later, lambda batch, n: log.write(batch, n + 1), label,
                checkpoint=f"{log.root}-checkpoint")
    return log.rows()
