"""Scans and sinks over folders of parquet tables."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

# Rows that a curated file holds at most, at every table size.
ROWS_PER_FILE = 5_000_000
# Tables that are archived at the same time.
ARCHIVE_WORKERS = 4


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet read that rebases dates written by the old hybrid calendar."""
    return (
        spark.read.option("datetimeRebaseMode", "LEGACY").option("int96RebaseMode", "LEGACY").parquet(path)
    )


def read_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def is_missing_path(error: AnalysisException) -> bool:
    """Whether a read failed because there is nothing at the path; anything else is an error."""
    return error.getCondition() == "PATH_NOT_FOUND"


def path_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_parquet(spark, path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return None


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """``(table, path, length)`` of every data file under ``root/<table>/``.

    Listed by the executors; contents are not read. Marker and hidden files
    (leading ``_`` or ``.``) are not listed.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    )
    tail = F.substring_index("path", root.rstrip("/") + "/", -1)
    return files.select(F.substring_index(tail, "/", 1).alias("table"), "path", "length")


def table_folders(spark: SparkSession, root: str, only: Collection[str] | None = None) -> list[str]:
    """Names of the child folders of ``root`` that hold files, optionally restricted."""
    names = [r[0] for r in file_listing(spark, root).select("table").distinct().collect()]
    return sorted(n for n in names if only is None or n in only)


def catalogue_tables(spark: SparkSession, database: str, exclude: Collection[str] = ()) -> list[str]:
    """Tables of a database without views and without the excluded names (any case)."""
    skip = {e.lower() for e in exclude}
    return [
        t.name
        for t in spark.catalog.listTables(database)
        if t.tableType not in ("VIEW", "TEMPORARY") and t.name.lower() not in skip
    ]


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def write_curated(df: DataFrame, path: str) -> None:
    """Snappy parquet, overwritten.

    One rule at every size: ``rebalance`` evens the rows out over as many tasks
    as the session's advisory partition size asks for, small tables into one
    file, and ``maxRecordsPerFile`` bounds the files.
    """
    (
        df.hint("rebalance")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .parquet(path)
    )


def write_raw(df: DataFrame, path: str) -> None:
    """Landing write of an extract: parquet without compression."""
    df.write.mode("overwrite").option("compression", "none").parquet(path)


def archive(spark: SparkSession, raw_root: str, archive_root: str, tables: Sequence[str]) -> DataFrame:
    """Copy raw tables to an archive folder, several at once, leaving the source in place.

    Returns ``(table, n_rows, n_archived)``; no tables is a no-op with no rows.
    All tables are tried; if any failed, one error names them after the rest is done.
    """

    def one(table: str) -> DataFrame | Exception:
        source, target = f"{raw_root}/{table}", f"{archive_root}/{table}"
        try:
            spark.read.parquet(source).write.mode("errorifexists").parquet(target)
            return row_counts(spark, table, source, target)
        except Exception as error:  # reported below, with the table's name
            return error

    with ThreadPoolExecutor(max_workers=ARCHIVE_WORKERS) as pool:
        done = dict(zip(tables, pool.map(inheritable_thread_target(spark)(one), tables)))
    failed = {t: e for t, e in done.items() if isinstance(e, Exception)}
    if failed:
        raise RuntimeError("not archived: " + "; ".join(f"{t}: {str(e).splitlines()[0]}" for t, e in failed.items()))
    if not done:
        return spark.createDataFrame([], "table string, n_rows bigint, n_archived bigint")
    return reduce(DataFrame.unionByName, done.values())


def row_counts(spark: SparkSession, table: str, source: str, target: str) -> DataFrame:
    both = spark.read.parquet(source).select(F.lit(1).alias("_side")).unionByName(
        spark.read.parquet(target).select(F.lit(2).alias("_side"))
    )
    return both.agg(
        F.count_if(F.col("_side") == 1).alias("n_rows"), F.count_if(F.col("_side") == 2).alias("n_archived")
    ).select(F.lit(table).alias("table"), "n_rows", "n_archived")


def schema_rows(spark: SparkSession, schemas: dict[str, T.StructType]) -> DataFrame:
    """Schemas as rows ``(table, column, type)``."""
    rows = [(t, f.name, f.dataType.simpleString()) for t, s in schemas.items() for f in s]
    return spark.createDataFrame(rows, "table string, column string, type string")
