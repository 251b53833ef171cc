"""Schemas of landed folders, catalogue sync and raw-load validation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.sources.tables import schema_rows

# Whole numbers by width; a floating number holds any of them, text holds everything.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text where there is no other."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = type(a), type(b)
    if all(k in _WHOLE for k in kinds):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if all(k in _WHOLE + _FLOATING for k in kinds):
        return T.DoubleType()
    if all(isinstance(t, (T.DecimalType, *_WHOLE)) for t in (a, b)):
        digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (digits[type(t)], 0) for t in (a, b)]
        whole, scale = max(w for w, _ in sizes), max(s for _, s in sizes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    moments = {T.DateType, T.TimestampNTZType, T.TimestampType}
    if set(kinds) <= moments and T.DateType in kinds:
        return a if isinstance(b, T.DateType) else b
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schemas([a, b])
    return T.StringType()


def merged_schemas(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns in order of first appearance, each in the least type that holds it."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            found[f.name] = widened(found[f.name], f.dataType) if f.name in found else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in found.items()])


def unmerged(error: Exception) -> bool:
    return "CANNOT_MERGE_SCHEMAS" in str(error)


def files_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType:
    """The schema of parquet files of one table, read from their footers by the executors.

    Spark merges what is compatible in one job. Files it cannot merge are halved
    until each part is, so a table with one odd file takes a few jobs more.
    """
    try:
        found = spark.read.option("mergeSchema", True).parquet(*paths).schema
    except Exception as error:  # Spark raises this one as it comes from the tasks, without a class of its own
        if len(paths) == 1 or not unmerged(error):
            raise
        half = len(paths) // 2
        return merged_schemas([files_schema(spark, paths[:half]), files_schema(spark, paths[half:])])
    return T.StructType([T.StructField(f.name, f.dataType) for f in found])


def child_folders(spark: SparkSession, root: str) -> list[str]:
    """Names one level below ``root`` that hold something not hidden; files further down are not listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def holds(folder) -> bool:
        return any(s.getPath().getName()[:1] not in "_." for s in system.listStatus(folder))

    found = [s.getPath() for s in system.listStatus(path) if s.isDirectory() and s.getPath().getName()[:1] not in "_."]
    return sorted(p.getName() for p in found if holds(p))


def landed_schemas(spark: SparkSession, root: str) -> DataFrame:
    """``(table, column, type)`` of every folder below ``root``, from the files that are there."""
    found = {}
    for name in child_folders(spark, root):
        try:
            found[name] = files_schema(spark, [f"{root}/{name}"])
        except Exception as error:
            if not unmerged(error):
                raise
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/{name}").select("path")
            found[name] = files_schema(spark, sorted(r[0] for r in files.collect()))
    return schema_rows(spark, found)


def sync_diff(found: DataFrame, catalogue: DataFrame) -> DataFrame:
    """What a sync would do: ``(table, column, action, old_type, new_type)``.

    Both inputs are ``(table, column, type)``. Actions: create_table,
    drop_table (one row each, column NULL), add_column, drop_column,
    change_type.
    """
    new = found.select("table", "column", F.col("type").alias("new_type"))
    old = catalogue.select("table", "column", F.col("type").alias("old_type"))
    seen = (
        found.select("table", F.lit(1).alias("s"))
        .unionByName(catalogue.select("table", F.lit(2).alias("s")))
        .groupBy("table")
        .agg(F.max(F.col("s") == 1).alias("in_found"), F.max(F.col("s") == 2).alias("in_catalogue"))
    )
    columns = new.join(old, ["table", "column"], "full").join(seen, "table")
    action = (
        F.when(F.col("old_type").isNull(), "add_column")
        .when(F.col("new_type").isNull(), "drop_column")
        .when(F.col("old_type") != F.col("new_type"), "change_type")
    )
    changed = (
        columns.where("in_found AND in_catalogue")
        .select("table", "column", action.alias("action"), "old_type", "new_type")
        .where(F.col("action").isNotNull())
    )
    null = F.lit(None).cast("string")
    whole = (
        seen.where("NOT (in_found AND in_catalogue)")
        .select(
            "table",
            null.alias("column"),
            F.when(F.col("in_found"), "create_table").otherwise("drop_table").alias("action"),
            null.alias("old_type"),
            null.alias("new_type"),
        )
    )
    return changed.unionByName(whole)


def apply_sync(spark: SparkSession, database: str, root: str, diff: DataFrame) -> list[tuple[str, str]]:
    """Register new folders, re-register changed tables, drop vanished ones.

    One diff row per changed column reaches the driver. The tables are
    external: dropping an entry leaves its files.
    """
    actions: dict[str, str] = {}
    for row in diff.select("table", "action").distinct().collect():
        whole = row["action"] if row["action"].endswith("_table") else "update_table"
        actions[row["table"]] = whole
    for table, action in sorted(actions.items()):
        if action != "create_table":
            spark.sql(f"DROP TABLE IF EXISTS {database}.`{table}`")
        if action != "drop_table":
            spark.catalog.createTable(f"{database}.`{table}`", path=f"{root}/{table}", source="parquet")
    return sorted(actions.items())


def validate_load(files: DataFrame, catalogue: DataFrame, expected: DataFrame) -> DataFrame:
    """``(table, check, ok, detail)`` for every expected table.

    ``files`` is ``(table, path, length)``, ``catalogue`` is ``(table, column,
    type)``, ``expected`` is ``(table)``. Checks: has_files, in_catalogue.
    """
    n_files = files.groupBy("table").agg(F.count("*").alias("n_files"))
    n_columns = catalogue.groupBy("table").agg(F.count("*").alias("n_columns"))
    counted = expected.select("table").distinct().join(n_files, "table", "left").join(n_columns, "table", "left")
    zero = F.lit(0).cast("bigint")
    files_n, columns_n = F.coalesce("n_files", zero), F.coalesce("n_columns", zero)
    checks = F.array(
        F.struct(F.lit("has_files").alias("check"), (files_n > 0).alias("ok"), F.concat(files_n.cast("string"), F.lit(" files")).alias("detail")),
        F.struct(F.lit("in_catalogue").alias("check"), (columns_n > 0).alias("ok"), F.concat(columns_n.cast("string"), F.lit(" columns")).alias("detail")),
    )
    return counted.select("table", F.explode(checks).alias("_c")).select("table", "_c.*")


def require_valid(report: DataFrame) -> int:
    """Number of tables checked; raises with every failure listed."""
    if report.isEmpty():
        raise ValueError("no table folders found")
    failures = report.where("NOT ok").orderBy("table", "check").collect()
    if failures:
        raise ValueError(
            "load validation failed:\n" + "\n".join(f"{r['table']}: {r['check']} ({r['detail']})" for r in failures)
        )
    return report.select("table").distinct().count()
