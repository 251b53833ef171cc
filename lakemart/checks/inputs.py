"""Inputs of the registered queries, derived from the given tables.

A derived input is written once, as a table and column expressions that read
the same in Spark SQL and in ANSI SQL; ``frame`` and ``cte`` give both forms.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.calendar import calendar


_schemas: dict[str, T.StructType] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table; its schema is inferred once per process, not per read."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


@dataclass(frozen=True)
class Derived:
    table: str
    columns: Mapping[str, str]
    where: str = "TRUE"
    current: str = "TRUE"

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """All rows, with the current flag as a column."""
        exprs = [f"{e} AS {c}" for c, e in self.columns.items()]
        return (
            read(spark, sf_dir, self.table).where(self.where).selectExpr(*exprs, f"{self.current} AS current_flag")
        )

    def sql(self) -> str:
        """Current rows only."""
        exprs = ", ".join(f"{e} AS {c}" for c, e in self.columns.items())
        return f"SELECT {exprs} FROM {self.table} WHERE ({self.where}) AND ({self.current})"


def entity(table: str, source: str, key: str, where: str = "TRUE", current: str = "TRUE", **columns: str) -> Derived:
    """A dimension over ``table``: id, surrogate key id + 1, further columns."""
    return Derived(table, {"id": key, f"{source}_sk": f"{key} + 1", **columns}, where, current)


def child(table: str, source: str, sk: str, where: str = "TRUE", current: str = "TRUE", **columns: str) -> Derived:
    """A child table known by its surrogate key and foreign keys only."""
    return Derived(table, {f"{source}_sk": sk, **columns}, where, current)


def calendar_sql(first: str, last: str) -> str:
    return (
        "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS date_actual "
        f"FROM range(DATE '{first}', DATE '{last}' + INTERVAL 1 DAY, INTERVAL 1 DAY) AS r(d)"
    )


@dataclass(frozen=True)
class Star:
    """The tables one fact reads, over the given tables."""

    days: tuple[str, str]
    dims: Mapping[str, Derived]

    def tables(self, spark: SparkSession, sf_dir: str, **more: DataFrame):
        def t(name: str) -> DataFrame:
            if name in more:
                return more[name]
            if name == "dim_date":
                return calendar(spark, *self.days)
            return self.dims[name].frame(spark, sf_dir)

        return t

    def ctes(self) -> str:
        parts = [f"dim_date AS ({calendar_sql(*self.days)})"]
        parts += [f"{name} AS ({d.sql()})" for name, d in self.dims.items()]
        return "WITH " + ",\n".join(parts)


def as_text(column: str) -> Column:
    """Array of keys as comma-separated text, for comparison."""
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",")


def arrays_as_text(df: DataFrame) -> DataFrame:
    return df.select(
        *[as_text(c).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    )


def moment(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def moment_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def list_text(expr: str) -> str:
    """DuckDB text of a list column, '' for an empty or missing one."""
    return f"coalesce(array_to_string({expr}, ','), '')"


def sk_dim(df: DataFrame, source: str, key: str) -> DataFrame:
    """``df`` as a dimension: ``id`` and ``<source>_sk`` = id + 1."""
    return df.withColumn("id", F.col(key)).withColumn(f"{source}_sk", F.col(key).cast("bigint") + 1)


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, current when they are not in debt."""
    return sk_dim(read(spark, sf_dir, "customer"), "customer", "c_custkey").withColumn(
        "current_flag", F.col("c_acctbal") > 0
    )


def nation_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk_dim(read(spark, sf_dir, "nation"), "nation", "n_nationkey")
