"""Session builder and shared scratch tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Joins stay splittable under AQE even when a later aggregate would like to
# reuse their partitioning: a hot key costs more than one extra exchange.
DEFAULTS = {
    "spark.scheduler.mode": "FAIR",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Lets Spark delete the shuffle files of a query when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows that go to a Python worker at a time.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_local_root: str | None = None
_setting = threading.Lock()
_inside, _setting_before = 0, None
# Per thread: loads of several tables run side by side.
_scopes = threading.local()


def _open_scopes() -> list[list[str]]:
    if not hasattr(_scopes, "stack"):
        _scopes.stack = []
    return _scopes.stack


def build_session(app: str = "lakemart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets one temporary
    folder per Python process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="lakemart-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/lakemart/{label}-{uuid.uuid4().hex}"
    if _open_scopes():
        _open_scopes()[-1].append(path)
    return path


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared scratch folder and read it back.

    Cuts the lineage and pins the rows: a lost executor re-reads files instead
    of re-running (and possibly re-ordering) the plan above.
    """
    return _written(df, scratch_path(df.sparkSession, label), partition_by)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, written as by :func:`materialize`; the scratch tables that it wrote on the way are deleted."""
    path = scratch_path(spark, label)
    with scratch_scope(spark):
        return _written(make(), path)


def write_scratch(df: DataFrame, path: str) -> DataFrame:
    """As :func:`materialize`, to a path that :func:`scratch_path` gave earlier: the table lives as long as that scope."""
    return _written(df, path)


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """The setting is on while any thread is inside, and as it was afterwards."""
    global _inside, _setting_before
    with _setting:
        if _inside == 0:
            _setting_before = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _inside += 1
    try:
        yield
    finally:
        with _setting:
            _inside -= 1
            if _inside == 0 and _setting_before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            elif _inside == 0:
                spark.conf.set(SHUFFLE_CLEANUP, _setting_before)


@contextmanager
def smaller_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Queries that run inside hand Python at most ``rows`` rows at a time; the setting is as it was afterwards."""
    before = spark.conf.get(ARROW_ROWS, None)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_ROWS)
        else:
            spark.conf.set(ARROW_ROWS, before)


def _written(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    spark = df.sparkSession
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    # Once the table is written nothing reads the shuffles behind it any more.
    with _shuffles_deleted(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def delete_path(spark: SparkSession, path: str) -> bool:
    """Whether there was something to delete."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside the block are deleted when it ends.

    Wrap a load and its final write; results that are still lazy must be
    consumed inside.
    """
    _open_scopes().append([])
    try:
        yield
    finally:
        for path in _open_scopes().pop():
            delete_path(spark, path)
