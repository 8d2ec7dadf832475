"""Session helpers: time zone, shared scratch folder, state store."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; sizing settings stay with the caller."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # recursive queries end by their level; the row limit would cut large tables
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    make_active(spark)
    return spark


def make_active(spark: SparkSession) -> None:
    """Spark looks up Python sources by name in the thread's active session, not in the caller's."""
    spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)


def use_rocksdb_state(spark: SparkSession) -> None:
    """`transformWithState` keeps its state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tidemill-")
    return _local_roots[app]


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared root, grouped by application for clean-up."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tidemill-{app}/{label}-{uuid.uuid4().hex[:12]}"


def checkpointed(df):
    """Cut lineage through the shared checkpoint folder (survives lost executors)."""
    shared = shared_root(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def managed_database(spark: SparkSession, label: str) -> str:
    """Create a database whose managed tables live in a new shared folder."""
    path = work_dir(spark, label)
    name = f"{label}_{path[-12:]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark gives it, for code on executors that opens files itself."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(place).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not (
        uri.startswith("file://")) else uri
