"""Relational sources and targets over Spark's JDBC data source.

Rows travel through Spark tasks. Statements that only the database can run
(DDL, the final swap or merge) go over one driver-side connection, in one
transaction; they are built by pure functions so they can be read and tested
without a database.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.names import safe_name
from lakemart.operators.mirror import MirrorTable
from lakemart.operators.quality import orphans

# Rows per JDBC batch, tables extracted at once.
BATCH_ROWS = 50_000
EXTRACT_WORKERS = 8


@dataclass(frozen=True)
class Database:
    """Connection options; credentials come from the caller, as does the number of connections it may hold."""

    url: str
    schema: str
    driver: str = "org.postgresql.Driver"
    properties: Mapping[str, str] = field(default_factory=dict)
    writers: int = 4

    def options(self, **extra: object) -> dict[str, str]:
        base = {"url": self.url, "driver": self.driver, **self.properties}
        return {**base, **{k: str(v) for k, v in extra.items() if v is not None}}

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"


def read_query(spark: SparkSession, db: Database, sql: str) -> DataFrame:
    return spark.read.format("jdbc").options(**db.options(query=sql)).load()


def run_statements(spark: SparkSession, db: Database, statements: Iterable[str]) -> None:
    """Run statements in one transaction on a driver-side connection."""
    jvm = spark._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(db.driver)
    properties = jvm.java.util.Properties()
    for key, value in db.properties.items():
        properties.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(db.url, properties)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            with_statement = connection.createStatement()
            with_statement.execute(statement)
            with_statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


# ---- extract -------------------------------------------------------------


@dataclass(frozen=True)
class Split:
    """How a table is read in parallel: a numeric or date column and its range."""

    column: str
    low: object
    high: object
    partitions: int


def select_tables(tables: Sequence[str], rules: Sequence[tuple[str, str]] = (("include", "%"),)) -> list[str]:
    """Tables picked by ``(include|exclude, pattern)`` rules, ``%`` as wildcard."""

    def matches(table: str, action: str) -> bool:
        return any(a == action and fnmatch.fnmatchcase(table, p.replace("%", "*")) for a, p in rules)

    return [t for t in tables if matches(t, "include") and not matches(t, "exclude")]


def extract_options(db: Database, table: str, split: Split | None = None) -> dict[str, str]:
    if split is None:
        return db.options(dbtable=db.name(table))
    return db.options(
        dbtable=db.name(table),
        partitionColumn=split.column,
        lowerBound=split.low,
        upperBound=split.high,
        numPartitions=split.partitions,
    )


def extract(spark: SparkSession, db: Database, table: str, split: Split | None = None) -> DataFrame:
    """One source table; without a split it is read by a single task."""
    return spark.read.format("jdbc").options(**extract_options(db, table, split)).load()


def find_split(spark: SparkSession, db: Database, table: str, column: str, partitions: int) -> Split | None:
    """Range of ``column`` asked from the database; None for an empty table."""
    sql = f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {db.name(table)}"
    low, high = read_query(spark, db, sql).first()
    return None if low is None else Split(column, low, high, partitions)


# ---- target DDL ------------------------------------------------------------


def create_table(db: Database, table: MirrorTable) -> str:
    lines = [f"{c} {t}{' NOT NULL' if c == table.pk else ''}" for c, t in table.columns]
    if table.pk:
        lines.append(f"PRIMARY KEY ({table.pk})")
    return f"CREATE TABLE IF NOT EXISTS {db.name(table.name)} ({', '.join(lines)})"


def create_schema(db: Database) -> str:
    return f"CREATE SCHEMA IF NOT EXISTS {db.schema}"


def stage_name(table: MirrorTable) -> str:
    return safe_name(f"{table.name}__stg", "table")


def create_stage(db: Database, table: MirrorTable) -> list[str]:
    """A fresh, unlogged, unconstrained copy of the target's columns."""
    stage = db.name(stage_name(table))
    columns = ", ".join(f"{c} {t}" for c, t in table.columns)
    return [f"DROP TABLE IF EXISTS {stage}", f"CREATE UNLOGGED TABLE {stage} ({columns})"]


def drop_primary_key(db: Database, table: MirrorTable, constraint: str) -> str:
    return f"ALTER TABLE {db.name(table.name)} DROP CONSTRAINT IF EXISTS {constraint}"


def find_primary_key(db: Database, table: MirrorTable) -> str:
    return (
        "SELECT constraint_name FROM information_schema.table_constraints "
        f"WHERE constraint_schema = '{db.schema}' AND table_name = '{table.name}' "
        "AND constraint_type = 'PRIMARY KEY'"
    )


# ---- control table ----------------------------------------------------------

CONTROL_COLUMNS = {
    "_mirror_control": (
        "table_name TEXT PRIMARY KEY, last_max_sk BIGINT, last_max_effective_from TIMESTAMPTZ, "
        "last_run_ts TIMESTAMPTZ DEFAULT now()"
    ),
    "_mirror_control_facts": "table_name TEXT PRIMARY KEY, last_run_ts TIMESTAMPTZ DEFAULT now()",
}


def create_control(db: Database, control: str) -> str:
    return f"CREATE TABLE IF NOT EXISTS {db.name(control)} ({CONTROL_COLUMNS[control]})"


def sql_literal(value: object) -> str:
    """SQL text of a value; a moment is written in UTC with its offset, whatever the zones of driver and database."""
    if value is None:
        return "NULL"
    if isinstance(value, dt.datetime):
        # A collected timestamp without zone is in the driver's own zone, as astimezone() reads it.
        value = value.astimezone(dt.timezone.utc).isoformat(sep=" ")
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def upsert_control(db: Database, control: str, table: str, values: Mapping[str, object]) -> str:
    """Set control values of one table; NULL leaves the stored one."""
    columns = ["table_name", *values, "last_run_ts"]
    row = [sql_literal(table), *map(sql_literal, values.values()), "now()"]
    updates = [f"{c} = COALESCE(EXCLUDED.{c}, t.{c})" for c in columns[1:]]
    return (
        f"INSERT INTO {db.name(control)} AS t ({', '.join(columns)}) VALUES ({', '.join(row)}) "
        f"ON CONFLICT (table_name) DO UPDATE SET {', '.join(updates)}"
    )


# ---- full replace and upsert -----------------------------------------------


def replace_from_stage(db: Database, table: MirrorTable) -> list[str]:
    target, stage = db.name(table.name), db.name(stage_name(table))
    columns = ", ".join(table.column_names)
    return [
        f"TRUNCATE TABLE {target}",
        f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {stage}",
        f"DROP TABLE {stage}",
    ]


def upsert_from_stage(db: Database, table: MirrorTable) -> list[str]:
    target, stage = db.name(table.name), db.name(stage_name(table))
    columns = ", ".join(table.column_names)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in table.column_names if c != table.pk)
    action = f"UPDATE SET {updates}" if updates else "NOTHING"
    return [
        f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {stage} "
        f"ON CONFLICT ({table.pk}) DO {action}",
        f"DROP TABLE {stage}",
    ]


def write_stage(df: DataFrame, db: Database, table: MirrorTable) -> None:
    """Append to the stage over ``db.writers`` connections.

    The rows are dealt out anew, so only the write runs in that many tasks.
    """
    (
        df.repartition(db.writers)
        .write.format("jdbc")
        .options(**db.options(dbtable=db.name(stage_name(table)), batchsize=BATCH_ROWS))
        .mode("append")
        .save()
    )


def stage_rows(spark: SparkSession, db: Database, table: MirrorTable) -> int:
    return read_query(spark, db, f"SELECT COUNT(*) AS n FROM {db.name(stage_name(table))}").first()[0]


# ---- foreign keys ------------------------------------------------------------


def add_foreign_key(db: Database, table: MirrorTable, fk: str, ref_table: str, ref_column: str) -> str:
    constraint = safe_name(f"{table.name}_{fk}_fk", "constraint")
    return (
        f"ALTER TABLE {db.name(table.name)} ADD CONSTRAINT {constraint} "
        f"FOREIGN KEY ({fk}) REFERENCES {db.name(ref_table)}({ref_column})"
    )


def foreign_keys(
    db: Database,
    table: MirrorTable,
    fact: DataFrame,
    references: Sequence[tuple[str, str, str]],
    dims: Mapping[str, DataFrame],
    existing: Sequence[str] = (),
) -> tuple[list[str], list[tuple[str, str]]]:
    """Constraints that will hold, and ``(fk, reason)`` for those left out.

    References are ``(fk column, dimension, dimension column)``. Orphans are
    looked for in Spark first, so the database is not asked for a constraint
    that must fail.
    """
    statements, skipped = [], []
    target = dict(zip(table.source_columns, table.column_names))
    for fk, dim, dim_column in references:
        if fk not in fact.columns:
            skipped.append((fk, "column missing"))
        elif dim not in dims or dim_column not in dims[dim].columns:
            skipped.append((fk, f"{dim}({dim_column}) missing"))
        elif safe_name(f"{table.name}_{target[fk]}_fk", "constraint") in existing:
            skipped.append((fk, "constraint exists"))
        elif not orphans(fact, fk, dims[dim], dim_column, unknown=None).isEmpty():
            skipped.append((fk, "orphans"))
        else:
            statements.append(
                add_foreign_key(db, table, target[fk], safe_name(dim, "table"), safe_name(dim_column, "column"))
            )
    return statements, skipped


def existing_constraints(spark: SparkSession, db: Database, table: MirrorTable) -> list[str]:
    sql = (
        "SELECT constraint_name FROM information_schema.table_constraints "
        f"WHERE constraint_schema = '{db.schema}' AND table_name = '{table.name}'"
    )
    return [r[0] for r in read_query(spark, db, sql).select(F.col("constraint_name")).collect()]
