"""Derived tables refreshed partition by partition."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.spread import rebalanced


#: The name of the partition of null values, and the schema of stored marks.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
MARKS = "part string, n long, x long, s long, dim string"


class InactiveView(RuntimeError):
    """The view cannot be refreshed; its stored rows can still be read."""


def fingerprints(df: DataFrame, part: Column) -> DataFrame:
    """Row count and two order-free hashes per partition value, with map-side combine."""
    h = F.xxhash64(*df.columns)
    return df.groupBy(part.cast("string").alias("part")).agg(
        F.count("*").alias("n"), F.bit_xor(h).alias("x"),
        F.sum((h % 1000003).cast("bigint")).alias("s"),
    )


def file_fingerprints(spark: SparkSession, root: str, part: Column) -> DataFrame:
    """The same from the files of each partition below ``root``; no file is opened.

    Spark lists the files with their partition columns; names, sizes and times are hashed.
    """
    files = spark.read.format("binaryFile").load(root)
    if len(files.columns) == 4:  # no partition folder yet
        return spark.createDataFrame([], "part string, n long, x long, s long")
    return files.groupBy(part.cast("string").alias("part")).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
        .alias("x"), F.sum("length").alias("s"),
    )


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def overwrite_mode(spark: SparkSession, mode: str):
    """``dynamic``: only partitions present in the data are replaced; ``static``: all."""
    return setting(spark, "spark.sql.sources.partitionOverwriteMode", mode)


def partition_spec(values: dict) -> str:
    shown = {k: "NULL" if v is None else "'" + str(v).replace("'", "\\'") + "'"
             for k, v in values.items()}
    return ", ".join(f"{k}={v}" for k, v in shown.items())


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def clear_partition(spark: SparkSession, table: str, values: dict) -> None:
    """``INSERT OVERWRITE ... PARTITION (part=value) SELECT ... WHERE false``."""
    fields = [f for f in spark.table(table).schema.fields if f.name not in values]
    nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in fields)
    spark.sql(f"INSERT OVERWRITE {table} PARTITION ({partition_spec(values)}) "
              f"SELECT {nulls} WHERE false")


def overwrite_partitions(df: DataFrame, table: str, touched: list[dict] | None = None) -> None:
    """Replace the partitions that ``df`` has rows of, and empty those of ``touched`` it lacks.

    A dynamic overwrite leaves partitions without new rows as they are, so whoever replaces
    partitions names them. Which ones got rows is observed while the data is written.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    seen = Observation()
    if touched:
        df = df.observe(seen, F.collect_set(F.struct(
            *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION)).alias(c)
              for c in parts])).alias("parts"))
    with overwrite_mode(spark, "dynamic"):
        df.write.mode("overwrite").insertInto(table)
    if touched:
        written = {tuple(r[c] for c in parts) for r in seen.get["parts"]}
        for values in touched:
            key = tuple(NULL_PARTITION if values[c] is None else str(values[c]) for c in parts)
            if key not in written:
                clear_partition(spark, table, values)
    spark.catalog.refreshTable(table)


@dataclass
class DerivedTable:
    """``build(base, dims)`` stored in ``table``, partitioned by ``part``.

    ``base_part`` maps base rows to the partition value of the derived table, e.g. the day itself,
    or its month for a roll-up. Every partition carries the mark of the base rows and of the
    dimensions it was made from; a partition is stale while its marks differ from the present
    ones, however often a ``limit`` left it out. A chosen partition that has no rows any more is
    dropped. Marks lie beside the table and are written after its rows, so another session goes
    on where this one stopped, and a crash in between only repeats work.

    With ``files`` (the folder of the base table) base changes are found from file names, sizes
    and times, so an unchanged day costs no read; otherwise rows are hashed. The values compared
    on the driver are table metadata, one entry per partition.
    """

    spark: SparkSession
    table: str
    part: str
    base_part: Column
    build: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]
    limit: int | None = None
    files: str | None = None
    active: bool = True
    history: list[dict] = field(default_factory=list)

    def _marks_folder(self) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}")
        return rows.where("col_name = 'Location'").first()["data_type"].rstrip("/") + "__marks"

    def _versions(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._marks_folder())
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in system.listStatus(path)] if system.exists(
            path) else []
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and system.exists(
            self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._marks_folder()}/{n}/_SUCCESS")))

    def marks(self) -> dict[str, tuple]:
        """Partition -> (row or file count, hash, sum, dimension mark) it was made from."""
        versions = self._versions()
        if not versions:
            return {}
        rows = self.spark.read.schema(MARKS).parquet(f"{self._marks_folder()}/v={versions[-1]}")
        return {r["part"]: (r["n"], r["x"], r["s"], r["dim"]) for r in rows.collect()}

    def _store(self, marks: dict[str, tuple]) -> None:
        versions = self._versions()
        folder = self._marks_folder()
        self.spark.createDataFrame(
            [(p, *m) for p, m in marks.items()], MARKS
        ).coalesce(1).write.mode("overwrite").parquet(f"{folder}/v={(versions or [0])[-1] + 1}")
        for old in versions[:-1]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v={old}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _present(self, base: DataFrame, dims: dict[str, DataFrame]) -> dict[str, tuple]:
        dim = "|".join(
            f"{k}:{tuple(fingerprints(d, F.lit('all')).first() or ())}" for k, d in sorted(
                dims.items()))
        if self.files:
            # whole folders per task: the files are listed, not read
            with setting(self.spark, "spark.sql.files.maxPartitionBytes", str(1 << 50)):
                rows = file_fingerprints(self.spark, self.files, self._value()).collect()
        else:
            rows = fingerprints(base, self._value()).collect()
        return {r["part"]: (r["n"], r["x"], r["s"], dim) for r in rows}

    def _value(self) -> Column:
        return F.coalesce(self.base_part.cast("string"), F.lit(NULL_PARTITION))

    def refresh(self, base: DataFrame, dims: dict[str, DataFrame] | None = None,
                force: bool = False) -> dict:
        if not self.active:
            raise InactiveView(self.table)
        dims = dims or {}
        exists = self.spark.catalog.tableExists(self.table)
        now, seen = self._present(base, dims), self.marks() if exists else {}
        stale = {p for p in now.keys() | seen.keys() if force or now.get(p) != seen.get(p)}
        chosen = sorted(stale, reverse=True)
        if self.limit is not None and exists and not force:
            chosen = chosen[: self.limit]
        if chosen or not exists:
            self._write(base, dims, chosen, exists)
            self._store({**{p: m for p, m in seen.items() if p not in chosen},
                         **{p: now[p] for p in chosen if p in now}})
        status = {
            "state": "refreshed" if chosen else "unchanged",
            "partitions": sorted(chosen), "skipped": sorted(stale - set(chosen)),
        }
        self.history.append(status)
        return status

    def _write(self, base, dims, chosen, exists) -> None:
        """Replace the chosen partitions; those without rows go."""
        out = self.build(base.filter(self._value().isin(*chosen)), dims)
        out = rebalanced(
            out.select(*[c for c in out.columns if c != self.part], self.part), self.part
        )
        if not exists:
            out.write.partitionBy(self.part).format("parquet").saveAsTable(self.table)
            return
        seen = Observation()
        out = out.observe(seen, F.collect_set(F.coalesce(
            F.col(self.part).cast("string"), F.lit(NULL_PARTITION))).alias("parts"))
        with overwrite_mode(self.spark, "dynamic"):
            out.write.mode("overwrite").insertInto(self.table)
        for p in set(chosen) - set(seen.get["parts"]):
            spec = partition_spec({self.part: None if p == NULL_PARTITION else p})
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({spec})")
        self.spark.catalog.refreshTable(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)
