"""Stream sinks that stay correct when a micro-batch is replayed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.partitions import commit_partitions, committable
from tidemill.operators.spread import rebalanced
from tidemill.operators.tables import UPSERTS, latest_per_key


class BatchLog:
    """One folder per micro-batch.

    A replayed batch overwrites its own folder, and only folders with the
    writer's success marker are read, so every input row counts exactly once.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")

    def _finished(self, pattern: str) -> list[int]:
        """Numbers at the end of finished folder names matching ``pattern``."""
        path = self._jvm.org.apache.hadoop.fs.Path
        fs = path(self.root).getFileSystem(self._conf)
        found = fs.globStatus(path(f"{self.root}/{pattern}/_SUCCESS")) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)

    def committed(self) -> list[int]:
        return self._finished("batch_id=*")

    def rows(self, before: int | None = None) -> DataFrame | None:
        """Rows of finished batches with their ``batch_id``; None when there are none."""
        ids = [i for i in self.committed() if before is None or i < before]
        if not ids:
            return None
        paths = [f"{self.root}/batch_id={i}" for i in ids]
        return self.spark.read.option("basePath", self.root).parquet(*paths)


    def only(self, batch_id: int) -> DataFrame | None:
        """Rows of one finished batch, read without looking at the others."""
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch_id={batch_id}/_SUCCESS")
        if batch_id < 0 or not path.getFileSystem(self._conf).exists(path):
            return None
        return self.spark.read.parquet(f"{self.root}/batch_id={batch_id}")

    def forget(self, batch_id: int) -> None:
        """Drop one batch's folder, for logs of which only the newest batch counts."""
        if batch_id >= 0:
            path = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch_id={batch_id}")
            path.getFileSystem(self._conf).delete(path, True)


class UpsertLog(BatchLog):
    """Keyed table kept as change batches; reading merges them by key.

    With ``seq`` the largest ``seq`` of a key wins, whichever batch it came in, and equal ones by
    batch; without, the latest batch wins. ``schema`` is what an empty log is read as.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str],
                 seq: list[str] | None = None, op: str | None = None, schema=None):
        super().__init__(spark, root)
        self.keys, self.seq, self.op, self.schema = keys, seq or [], op, schema

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Only the last change per key of a batch is stored."""
        if self.op is not None:
            batch = batch.filter(F.col(self.op) != "-U")
        if self.seq:
            batch = latest_per_key(batch, self.keys, self.seq)
        self.write(batch, batch_id)

    def rows(self, before: int | None = None) -> DataFrame | None:
        """The newest finished compaction and the batches after it."""
        bases = [i for i in self._finished("upto=*") if before is None or i < before]
        if not bases:
            return super().rows(before)
        out = self.spark.read.parquet(f"{self.root}/upto={bases[-1]}").withColumnRenamed(
            "__batch", "batch_id")
        for i in self.committed():
            if i > bases[-1] and (before is None or i < before):
                part = self.spark.read.parquet(f"{self.root}/batch_id={i}")
                out = out.unionByName(part.withColumn("batch_id", F.lit(i)))
        return out

    def compact(self) -> None:
        """Merge all finished batches into one ``upto=N`` folder.

        Readers switch when its success marker appears, so a crash on the way
        changes nothing. Older folders are left for :meth:`purge`.
        """
        ids = self.committed()
        if ids and ids[-1] not in self._finished("upto=*"):
            merged = latest_per_key(self.rows(), self.keys, [*self.seq, "batch_id"])
            merged.withColumnRenamed("batch_id", "__batch").write.mode("overwrite").parquet(
                f"{self.root}/upto={ids[-1]}")

    def purge(self) -> None:
        """Drop batches and compactions the newest compaction already holds."""
        bases = self._finished("upto=*")
        if not bases:
            return
        path = self._jvm.org.apache.hadoop.fs.Path
        fs = path(self.root).getFileSystem(self._conf)
        old = [f"batch_id={i}" for i in self.committed() if i <= bases[-1]]
        for name in [*old, *[f"upto={i}" for i in bases[:-1]]]:
            fs.delete(path(f"{self.root}/{name}"), True)

    def current(self) -> DataFrame:
        rows = self.rows()
        if rows is None:
            if self.schema is None:
                raise ValueError(f"{self.root} has no finished batch and no schema was given")
            return self.spark.createDataFrame([], self.schema)
        rows = latest_per_key(rows, self.keys, [*self.seq, "batch_id"]).drop("batch_id")
        return rows if self.op is None else rows.filter(F.col(self.op).isin(*UPSERTS))


def fan_out(targets: list[Callable[[DataFrame, int], None]]):
    """One stream into several sinks; the batch is computed once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for target in targets:
                target(batch, batch_id)
        finally:
            batch.unpersist()

    return handle


class LateSplitter(BatchLog):
    """Rows whose window had closed when their batch began go to a late side.

    The watermark of a batch is the largest event time of all earlier batches
    minus ``delay`` (disorder plus allowed lateness). Both sides are written in
    one pass, which also yields the batch's largest event time.
    """

    def __init__(self, spark, root: str, ts: str, window: str, delay: str):
        super().__init__(spark, f"{root}/rows")
        self.progress = BatchLog(spark, f"{root}/progress")
        self.ts, self.window, self.delay = ts, window, delay

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The progress log holds the largest time so far; only the batch before is read."""
        before = self.progress.only(batch_id - 1)
        newest = None if before is None else before.first()["max_ts"]
        late = F.lit(False)
        if newest is not None:
            ends = F.window(self.ts, self.window)["end"]
            late = ends <= F.lit(newest) - F.expr(f"INTERVAL {self.delay}")
        stats = Observation()
        self.write_split(batch.observe(stats, F.max(self.ts).alias("max_ts")), late, batch_id)
        seen = [x for x in (newest, stats.get["max_ts"]) if x is not None]
        row = self.spark.createDataFrame([(max(seen, default=None),)], "max_ts timestamp")
        self.progress.write(row.coalesce(1), batch_id)
        self.progress.forget(batch_id - 2)

    def rows(self, before: int | None = None) -> DataFrame | None:
        out = super().rows(before)
        return None if out is None else out.withColumn("late", F.col("late").cast("boolean"))

    def write_split(self, batch: DataFrame, late: Column, batch_id: int) -> None:
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(
            f"{self.root}/batch_id={batch_id}")


class PartitionCommitter(BatchLog):
    """Writes by day and announces a day once the watermark is ``delay`` past its start.

    Data lies in ``<data>/<part>=<day>/batch_id=<n>``, which a replayed batch
    overwrites. Each batch carries on the folders not yet announced and the
    largest time so far, so a day is announced even when its own rows stopped
    long before, and a batch reads nothing but the one before it. Rows that
    come later still are added to the announced day.
    """

    def __init__(self, spark, table: str, data: str, log: str, part: str, ts: str,
                 disorder: str, delay: str):
        super().__init__(spark, log)
        self.table, self.data, self.part, self.ts = table, data, part, ts
        self.disorder, self.delay = disorder, delay

    def process(self, batch: DataFrame, batch_id: int) -> None:
        carried = self.only(batch_id - 1)
        pending, newest = ([], None) if carried is None else (
            [(r["day"], r["batch"]) for r in carried.where("day is not null").collect()],
            carried.agg(F.max("max_ts")).first()[0])
        stats = Observation()
        rows = batch.observe(
            stats, F.max(self.ts).alias("max_ts"), F.collect_set(self.part).alias("days")
        ).withColumn("batch_id", F.lit(batch_id))
        rebalanced(rows, self.part).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(self.part, "batch_id").parquet(self.data)
        newest = max((x for x in (newest, stats.get["max_ts"]) if x is not None), default=None)
        pending += [(day, batch_id) for day in stats.get["days"]]
        table = self.spark.createDataFrame(
            [(d, n, newest) for d, n in pending] or [(None, None, newest)],
            "day string, batch int, max_ts timestamp")
        ready = committable(
            table.where("day is not null").withColumn("start", F.to_timestamp("day")),
            F.col("max_ts") - F.expr(f"INTERVAL {self.disorder}"), f"INTERVAL {self.delay}",
            "start")
        fresh = [(r["day"], r["batch"]) for r in ready.collect()]
        commit_partitions(
            self.spark, self.table, [{self.part: day, "batch_id": n} for day, n in fresh],
            [f"{self.data}/{self.part}={day}" for day in sorted({day for day, _ in fresh})])
        left = [(d, n, newest) for d, n in pending if (d, n) not in set(fresh)]
        self.write(self.spark.createDataFrame(
            left or [(None, None, newest)], table.schema).coalesce(1), batch_id)
        self.forget(batch_id - 2)

    def announced(self) -> list[str]:
        """Days with a success marker."""
        path = self._jvm.org.apache.hadoop.fs.Path
        fs = path(self.data).getFileSystem(self._conf)
        found = fs.globStatus(path(f"{self.data}/{self.part}=*/_SUCCESS")) or []
        return sorted(s.getPath().getParent().getName().split("=")[1] for s in found)


class NotMoved(RuntimeError):
    """The store refused to move a folder."""


class BudgetExceeded(RuntimeError):
    """More bad rows than allowed; the load is paused."""


class BudgetedLoad(BatchLog):
    """Good rows are stored; too many bad rows pause the load.

    Running the stream again from the same checkpoint resumes at the batch
    that failed.
    """

    def __init__(self, spark, root: str, bad: Column, max_errors: int | None = None,
                 max_ratio: float | None = None):
        super().__init__(spark, f"{root}/rows")
        self.bad, self.max_errors, self.max_ratio = bad, max_errors, max_ratio
        self.report = BatchLog(spark, f"{root}/report")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Rows are counted while they are written aside; only within the budget they count.

        The report carries the sums so far, so only the batch before is read.
        """
        flag = F.coalesce(self.bad, F.lit(True))
        stats = Observation()
        aside = f"{self.root}/pending-{batch_id}"
        batch.observe(stats, F.count(F.lit(1)).alias("total"), F.count_if(flag).alias("bad")).filter(
            ~flag).write.mode("overwrite").parquet(aside)
        total, bad = stats.get["total"], stats.get["bad"]
        before = self.report.only(batch_id - 1)
        spent = 0 if before is None else before.first()["filtered_so_far"]
        if self.max_errors is not None and spent + bad > self.max_errors:
            raise BudgetExceeded(f"{spent + bad} bad rows, limit {self.max_errors}")
        if self.max_ratio is not None and total and bad / total > self.max_ratio:
            raise BudgetExceeded(f"{bad} of {total} rows are bad, limit {self.max_ratio}")
        self.forget(batch_id)
        self._publish(aside, f"{self.root}/batch_id={batch_id}")
        row = self.spark.createDataFrame(
            [(total, bad, total - bad, spent + bad)],
            "scan_rows long, filtered_rows long, sink_rows long, filtered_so_far long")
        self.report.write(row.coalesce(1), batch_id)

    def _publish(self, aside: str, place: str) -> None:
        """Move a written folder, its success marker last.

        Stores that move a folder file by file never show a marker beside missing files, and a
        store that answers no instead of raising does not pass for one that moved.
        """
        path = self._jvm.org.apache.hadoop.fs.Path
        fs = path(aside).getFileSystem(self._conf)
        fs.delete(path(f"{aside}/_SUCCESS"), False)
        if not fs.rename(path(aside), path(place)):
            raise NotMoved(f"{aside} to {place}")
        fs.create(path(f"{place}/_SUCCESS"), True).close()


def reloading_lookup(load: Callable[[], DataFrame], join: Callable[[DataFrame, DataFrame], DataFrame],
                     target: Callable[[DataFrame, int], None], ttl_s: float,
                     clock: Callable[[], float]):
    """Join each batch with a dimension that is read again when older than ``ttl_s``."""
    state: dict = {"at": None, "dim": None}

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = clock()
        if state["at"] is None or now - state["at"] > ttl_s:
            state.update(at=now, dim=load())
        target(join(batch, state["dim"]), batch_id)

    return handle
