"""Identifiers and type names for a relational target (PostgreSQL rules)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import types as T

# Identifier length limit, kept head and hash tail of longer names.
MAX_LENGTH = 63
HEAD_LENGTH = 50
HASH_LENGTH = 7

# Reserved words of the target database.
RESERVED = (
    "all", "analyse", "analyze", "and", "any", "array", "as", "asc", "asymmetric", "authorization", "binary", "both",
    "case", "cast", "check", "collate", "collation", "column", "concurrently", "constraint", "create", "cross",
    "current_catalog", "current_date", "current_role", "current_schema", "current_time", "current_timestamp",
    "current_user", "default", "deferrable", "desc", "distinct", "do", "else", "end", "except", "false", "fetch",
    "for", "foreign", "freeze", "from", "full", "grant", "group", "having", "ilike", "in", "initially", "inner",
    "intersect", "into", "is", "isnull", "join", "lateral", "leading", "left", "like", "limit", "localtime",
    "localtimestamp", "natural", "not", "notnull", "null", "offset", "on", "only", "or", "order", "outer", "overlaps",
    "placing", "primary", "references", "returning", "right", "select", "session_user", "similar", "some",
    "symmetric", "table", "tablesample", "then", "to", "trailing", "true", "union", "unique", "user", "using",
    "variadic", "verbose", "when", "where", "window", "with",
)

# Suffix put on a reserved word, by kind of identifier.
RESERVED_SUFFIX = {"table": "_t", "column": "_col", "constraint": "_c"}


def safe_name(name: str, kind: str) -> str:
    cleaned = re.sub("_{2,}", "_", re.sub("[^a-z0-9_]+", "_", (name or "").strip().lower()))
    if not cleaned or cleaned[0].isdigit():
        cleaned = "_" + cleaned
    if cleaned in RESERVED:
        cleaned += RESERVED_SUFFIX[kind]
    if len(cleaned) <= MAX_LENGTH:
        return cleaned
    digest = hashlib.sha1(f"{name}|{kind}".encode()).hexdigest()
    return f"{cleaned[:HEAD_LENGTH]}_{digest[:HASH_LENGTH]}"


def safe_columns(columns: Sequence[str], renames: Mapping[str, str] | None = None) -> dict[str, str]:
    """Source column -> target column; a name already taken gets _1, _2, ..."""
    taken: dict[str, str] = {}
    for column in columns:
        wanted = safe_name((renames or {}).get(column, column), "column")
        name, n = wanted, 0
        while name in taken.values():
            n += 1
            name = f"{wanted}_{n}"
        taken[column] = name
    return taken


def pick_primary_key(columns: Sequence[str], hint: str | None = None) -> str | None:
    """The hint if present, else the first ``*_sk``, first ``*_id``, first column."""
    if hint in columns:
        return hint
    for suffix in ("_sk", "_id", ""):
        for column in columns:
            if column.endswith(suffix):
                return column
    return None


# Target type per Spark type; anything else is kept as text.
SQL_TYPES: dict[type[T.DataType], str] = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.ShortType: "SMALLINT",
    T.ByteType: "SMALLINT",
    T.BooleanType: "BOOLEAN",
    T.DoubleType: "DOUBLE PRECISION",
    T.FloatType: "REAL",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMPTZ",
    T.TimestampNTZType: "TIMESTAMP",
}


def sql_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.ArrayType):
        return sql_type(dtype.elementType) + "[]"
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    return SQL_TYPES.get(type(dtype), "TEXT")


def override_type(sql: str) -> T.DataType | None:
    """Spark type of a type that the target is told to use, if one holds its values; else the target converts."""
    name, _, arguments = sql.strip().upper().partition("(")
    numbers = [int(n) for n in arguments.rstrip(") ").split(",") if n.strip().isdigit()]
    name = name.strip()
    if name in ("NUMERIC", "DECIMAL"):
        return T.DecimalType(numbers[0], numbers[1] if len(numbers) > 1 else 0) if numbers and numbers[0] <= 38 else None
    if name in ("TEXT", "VARCHAR", "CHARACTER VARYING"):
        return T.StringType()
    return next((kind() for kind, known in SQL_TYPES.items() if known == name), None)


def mirror_type(dtype: T.DataType) -> T.DataType:
    """Spark type that travels over JDBC for ``sql_type``."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(mirror_type(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.ByteType):
        return T.ShortType()
    if isinstance(dtype, T.DecimalType) or type(dtype) in SQL_TYPES:
        return dtype
    return T.StringType()
