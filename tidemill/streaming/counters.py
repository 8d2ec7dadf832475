"""Load jobs on running streams: counters by batch, pause and resume."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Paused(RuntimeError):
    """The job was paused before this batch."""


class _Listener(StreamingQueryListener):
    def __init__(self, job: "LoadJob"):
        self.job = job

    def onQueryStarted(self, event) -> None:
        if event.name == self.job.name:
            self.job.query_id = str(event.id)

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.job.query_id:
            self.job.take(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.job.query_id:
            self.job.ended(event.exception)


class LoadJob:
    """A stream that can be paused and resumed, with its counters.

    ``counts`` maps names to aggregates, observed while ``handle(batch, batch_id)`` runs its one
    action on the batch. A batch's counters come with its progress event and stand under its
    number, so a replayed batch counts once. Each batch waits for the counters of the one before:
    if ``pause_when(counters)`` holds for those, or :meth:`pause` was called, the job stops there
    and a resumed one begins with the batch that was held up. A batch that fails pauses the job the
    same way. Counters live with this object; the rows' own place is the checkpoint.
    """

    def __init__(self, spark: SparkSession, name: str, rows: DataFrame, counts: dict[str, Column],
                 handle: Callable[[DataFrame, int], None], checkpoint: str,
                 pause_when: Callable[[dict], bool] | None = None, wait_s: float = 60):
        self.spark, self.name, self.handle, self.checkpoint = spark, name, handle, checkpoint
        self.rows = rows.observe(name, *[c.alias(n) for n, c in counts.items()])
        self.names, self.pause_when, self.wait_s = list(counts), pause_when, wait_s
        self.state, self.reason, self.query_id = "NEED_SCHEDULE", "", None
        self.batches: dict[int, dict] = {}
        self._seen = threading.Condition()
        self._arrived: set[int] = set()
        self._before: int | None = None
        self._over = threading.Event()

    def run(self) -> str:
        """Load what is there from the checkpoint on; the state the job ends in."""
        self.state, self.reason, self._before = "RUNNING", "", None
        self._arrived.clear()
        self._over.clear()
        listener = _Listener(self)
        self.spark.streams.addListener(listener)
        try:
            query = (self.rows.writeStream.queryName(self.name).foreachBatch(self._gated)
                     .option("checkpointLocation", self.checkpoint)
                     .trigger(availableNow=True).start())
            if not self._over.wait() or query.isActive:
                query.awaitTermination()
        finally:
            self.spark.streams.removeListener(listener)
        return self.state

    def pause(self, reason: str = "by the user") -> None:
        """Hold up the next batch; the one that runs is finished."""
        self.state, self.reason = "PAUSED", reason

    def _gated(self, batch: DataFrame, batch_id: int) -> None:
        before = self._before
        with self._seen:
            if before is not None and not self._seen.wait_for(
                    lambda: before in self._arrived, self.wait_s):
                raise TimeoutError(f"no counters of batch {before} after {self.wait_s} s")
        if self.state == "PAUSED":
            raise Paused(self.reason)
        self.handle(batch, batch_id)
        self._before = batch_id

    def take(self, progress) -> None:
        """A trigger that ran no batch reports no rows and is no batch."""
        with self._seen:
            seen = progress.observedMetrics.get(self.name)
            if seen is not None and progress.numInputRows:
                counts = {n: seen[n] for n in self.names}
                self.batches[progress.batchId] = counts
                if self.pause_when is not None and self.pause_when(counts):
                    self.pause(f"batch {progress.batchId}: {counts}")
            self._arrived.add(progress.batchId)
            self._seen.notify_all()

    def ended(self, exception: str | None) -> None:
        """An end by itself after the last batch is one even if that batch asked for a pause."""
        if exception is None:
            self.state = "FINISHED"
        elif self.state != "PAUSED":
            self.state, self.reason = "PAUSED", exception
        self._over.set()

    def report(self) -> DataFrame:
        """One row per batch: ``batch_id`` and the counters."""
        return self.spark.createDataFrame(
            [(i, *[c[n] for n in self.names]) for i, c in sorted(self.batches.items())],
            ", ".join(f"{n} long" for n in ["batch_id", *self.names]))
