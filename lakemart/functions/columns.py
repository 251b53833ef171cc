"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File extensions that mark a value as a file name or path.
FILE_EXTENSIONS = (
    "pdf", "doc", "docx", "xls", "xlsx", "jpg", "jpeg", "png", "gif",
    "txt", "csv", "zip", "rar", "ppt", "pptx", "mp4", "mp3", "wav",
)
FILE_VALUE_PATTERN = rf"\.({'|'.join(FILE_EXTENSIONS)})([?#].*)?$"

# First valid Gregorian day, first accepted timestamp, open end.
FIRST_DATE = "1582-10-15"
FIRST_TIMESTAMP = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 23:59:59"

NUMERIC = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)
TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def all_of(conditions: Iterable[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def any_of(conditions: Iterable[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def is_filled(column: Column, dtype: T.DataType) -> Column:
    """Value counts as data: not null, not blank text, not NaN."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return column.isNotNull() & (F.length(F.trim(column)) > 0)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def is_file_like(column: Column) -> Column:
    """Text ends in a known file extension, with an optional ?query or #fragment."""
    return F.coalesce(F.lower(column).rlike(FILE_VALUE_PATTERN), F.lit(False))


def clamp_ancient(column: Column, dtype: T.DataType) -> Column:
    """Dates and timestamps older than the accepted range become NULL."""
    if isinstance(dtype, T.DateType):
        floor = F.lit(FIRST_DATE)
    elif isinstance(dtype, TIMESTAMPS):
        floor = F.lit(FIRST_TIMESTAMP)
    else:
        return column
    return F.when(column >= floor.cast(dtype), column)


def null_default(dtype: T.DataType) -> Column | None:
    """What a NULL of this type turns into in a fact; None leaves it alone."""
    if isinstance(dtype, NUMERIC):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit("N/A")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.ArrayType):
        return F.array().cast(dtype)
    return None


def missing_column(name: str) -> Column:
    """Stand-in for a fact column that the input lacks, typed by its suffix."""
    if name.endswith("_date_id"):
        return F.lit(0).cast("int")
    if name.endswith("_sks"):
        return F.lit(None).cast("array<bigint>")
    return F.lit(None).cast("bigint")


def status_key(column: Column) -> Column:
    return F.lower(F.trim(column.cast("string")))


def day_number(column: Column) -> Column:
    """Calendar key of a date: yyyymmdd as int."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("int")


def signature(columns: Iterable[str]) -> Column:
    """xxhash64 over the columns as text, with NULL kept apart from any text.

    ``xxhash64`` alone skips NULLs, so each column also feeds a null marker.
    """
    parts: list[Column] = []
    for name in columns:
        text = F.col(f"`{name}`").cast("string")
        parts += [text.isNull(), F.coalesce(text, F.lit(""))]
    return F.xxhash64(*parts)


def row_digests(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit digests of the columns, NULL apart from any value; the second reads them in reverse.

    Rows that compare equal may differ here (0.0 and -0.0); rows that differ
    have equal pairs with a chance of 2^-128.
    """
    kinds = dict(df.dtypes)
    parts = [
        (F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string") if "map<" in kinds[c] or kinds[c] == "variant" else F.col(f"`{c}`"))
        for c in columns
    ]
    there = [x for pair in parts for x in pair]
    back = [x for pair in reversed(parts) for x in pair]
    return F.xxhash64(F.lit(1), *there), F.xxhash64(F.lit(2), *back)


def same_values(left: str, right: str, columns: Iterable[str]) -> Column:
    """Null-safe equality of two struct columns over ``columns``; TRUE for none."""
    return all_of(F.col(left)[c].eqNullSafe(F.col(right)[c]) for c in columns)
