"""Input tables by name, and the registry of queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import configure


class Tables:
    """``t.orders`` reads ``<folder>/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def stream(self, name: str) -> DataFrame:
        """The same table as a file stream with the same schema."""
        return (
            self.spark.readStream.schema(self.read(name).schema)
            .option("pathGlobFilter", f"{name}.parquet")
            .parquet(self.folder)
        )

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @property
    def events_ts(self) -> DataFrame:
        """Events with a zoned timestamp, which watermarks need."""
        return self.events.withColumn("ts", F.col("ts").cast("timestamp"))

    @property
    def events_stream(self) -> DataFrame:
        return self.stream("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @property
    def employees(self) -> DataFrame:
        """Employee rows: customers with their nation as department."""
        return self.customer.join(
            self.nation, F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("c_custkey").alias("emp_no"),
            F.col("c_name").alias("emp_name"),
            F.col("n_nationkey").alias("dept_no"),
            F.col("n_name").alias("dept_name"),
            F.col("c_mktsegment").alias("grp"),
            F.col("c_acctbal").alias("salary"),
        )


EMPLOYEES_SQL = """(SELECT c_custkey emp_no, c_name emp_name, n_nationkey dept_no,
  n_name dept_name, c_mktsegment grp, c_acctbal salary
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its check SQL."""

    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return add


def load_all() -> dict[str, Query]:
    from tidemill import plans

    plans.load()
    return REGISTRY
