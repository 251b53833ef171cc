"""Column profile and the decision which columns hold file names or paths."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.columns import is_file_like, is_filled

# A column name containing one of these is suspicious.
FILE_KEYWORDS = (
    "letter", "document", "file", "pdf", "doc", "attachment", "upload",
    "certificate", "report", "form", "application", "submission",
    "acknowledgement", "approval", "receipt", "invoice", "contract", "path", "url",
)
# Smallest share of file-like values that drops a column.
DROP_SHARE = 0.05
DROP_SHARE_SUSPICIOUS = 0.005


def is_suspicious(column: str, force_drop: Collection[str] = ()) -> bool:
    name = column.lower()
    return name in {c.lower() for c in force_drop} or any(k in name for k in FILE_KEYWORDS)


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: type, total rows, filled values, file-like values.

    A single aggregate over one scan; only its one row is unpivoted.
    """
    aggregates = [F.count("*").alias("_rows")]
    for i, field in enumerate(df.schema):
        column = F.col(f"`{field.name}`")
        aggregates.append(F.count_if(is_filled(column, field.dataType)).alias(f"_filled{i}"))
        like = is_file_like(column) if isinstance(field.dataType, T.StringType) else F.lit(False)
        aggregates.append(F.count_if(like).alias(f"_files{i}"))
    entries = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("n_rows"),
            F.col(f"_filled{i}").alias("n_filled"),
            F.col(f"_files{i}").alias("n_file_like"),
        )
        for i, field in enumerate(df.schema)
    ]
    return df.agg(*aggregates).select(F.explode(F.array(*entries)).alias("_c")).select("_c.*")


def drop_decisions(profile: DataFrame, force_drop: Collection[str] = ()) -> DataFrame:
    """Add ``file_share``, ``suspicious`` and ``dropped`` to a profile."""
    name = F.lower("column")
    forced = name.isin([c.lower() for c in force_drop]) if force_drop else F.lit(False)
    keyword = name.rlike("|".join(FILE_KEYWORDS))
    share = F.when(F.col("n_filled") > 0, F.col("n_file_like") / F.col("n_filled"))
    limit = F.when(F.col("suspicious"), DROP_SHARE_SUSPICIOUS).otherwise(DROP_SHARE)
    over = F.coalesce(F.col("file_share") >= limit, F.lit(False)) & (F.col("type") == "string")
    return (
        profile.withColumn("file_share", share)
        .withColumn("suspicious", keyword | forced)
        .withColumn("dropped", forced | over)
    )


def split_columns(df: DataFrame, force_drop: Collection[str] = ()) -> tuple[list[str], list[str], int]:
    """Columns to keep, columns to drop, and the row count. Collects one row per column."""
    decided = drop_decisions(profile_columns(df), force_drop).collect()
    dropped = {r["column"] for r in decided if r["dropped"]}
    rows = decided[0]["n_rows"] if decided else 0
    return [c for c in df.columns if c not in dropped], [c for c in df.columns if c in dropped], rows


def without_file_columns(df: DataFrame, force_drop: Collection[str] = ()) -> DataFrame:
    return df.select(*[f"`{c}`" for c in split_columns(df, force_drop)[0]])
