"""Load labels: each label's rows and report are one unit, and a label succeeds once."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "label string, state string, scan_rows long, filtered_rows long, sink_rows long, reason string"
)


class LabelUsed(RuntimeError):
    """A load with this label succeeded already, or is running."""


class LoadLedger:
    """A successful label cannot be used again; a failed one can.

    Every attempt at a label has a number, claimed by creating its file exclusively: of callers
    that try the same number one gets it. An attempt may be claimed if the one before it failed or
    has shown no sign of life for ``stale_s``; a running load renews its sign. Nothing is deleted,
    so no caller can take away a claim it did not see. An attempt writes to a folder of its own
    (``data/label=<label>/attempt=<n>``) and counts only if it is still the newest when it ends, so
    a load that was given up for lost and wakes up again changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, stale_s: float = 86_400):
        self.spark, self.path, self.stale_s = spark, path.rstrip("/"), stale_s
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/entries"))

    def entries(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(
            f"{self.path}/entries")

    def _finished(self) -> dict[str, int]:
        """Attempt of each label that succeeded."""
        found = self._fs.globStatus(
            self._path(f"{self.path}/entries/FINISHED/label=*/attempt=*/_SUCCESS")) or []
        folders = [s.getPath().getParent() for s in found]
        return {f.getParent().getName().split("=", 1)[1]: int(f.getName().split("=")[1])
                for f in folders}

    def rows(self) -> DataFrame | None:
        """Rows of finished loads with their ``label``; None when there are none."""
        done = sorted(self._finished().items())
        if not done:
            return None
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/label={label}/attempt={n}" for label, n in done]).drop("attempt")

    def _record(self, label: str, attempt: int, state: str, report: dict,
                reason: str = "") -> None:
        row = (label, state, report.get("scan_rows", 0), report.get("filtered_rows", 0),
               report.get("sink_rows", 0), reason)
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/entries/{state}/label={label}/attempt={attempt}")

    def _attempts(self, label: str) -> dict[int, object]:
        """File status of each attempt claimed so far."""
        found = self._fs.globStatus(self._path(f"{self.path}/claims/{label}/attempt=*")) or []
        return {int(s.getPath().getName().split("=")[1]): s for s in found}

    def _claim(self, label: str) -> int:
        claims = self._attempts(label)
        newest = max(claims, default=0)
        if label in self._finished():
            raise LabelUsed(label)
        if newest and not self._fs.exists(self._path(f"{self.path}/claims/{label}/failed={newest}")):
            age = time.time() - claims[newest].getModificationTime() / 1000
            if age < self.stale_s:
                raise LabelUsed(label)
        try:
            self._fs.create(self._path(f"{self.path}/claims/{label}/attempt={newest + 1}"),
                            False).close()
        except Exception as exc:
            raise LabelUsed(label) from exc
        return newest + 1

    @contextmanager
    def _alive(self, label: str, attempt: int):
        """Renews the claim's time while the load runs."""
        claim, over = self._path(f"{self.path}/claims/{label}/attempt={attempt}"), threading.Event()

        def renew() -> None:
            while not over.wait(max(self.stale_s / 4, 0.2)):
                self._fs.setTimes(claim, int(time.time() * 1000), -1)

        thread = threading.Thread(target=renew, daemon=True)
        thread.start()
        try:
            yield
        finally:
            over.set()
            thread.join()

    def run(self, label: str, load: Callable[[str], dict]) -> dict:
        """``load(folder)`` overwrites ``folder`` and returns its report."""
        attempt = self._claim(label)
        with self._alive(label, attempt):
            try:
                report = load(f"{self.path}/data/label={label}/attempt={attempt}")
            except Exception as exc:
                self._record(label, attempt, "CANCELLED", {}, str(exc)[:200])
                self._fs.create(self._path(f"{self.path}/claims/{label}/failed={attempt}"),
                                True).close()
                raise
            if max(self._attempts(label)) != attempt:
                raise LabelUsed(label)
            self._record(label, attempt, "FINISHED", report)
        return report
