"""Schema shaping: natural keys, staging, clamps, fact projection. One ``select`` each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions import columns as C

# The columns every type-2 dimension carries after its surrogate key.
HISTORY_FIELDS = T.StructType(
    [
        T.StructField("sig_hash", T.LongType()),
        T.StructField("effective_from", T.TimestampType()),
        T.StructField("effective_to", T.TimestampType()),
        T.StructField("current_flag", T.BooleanType()),
        T.StructField("version", T.LongType()),
    ]
)


def natural_key(columns: Sequence[str], source: str) -> str | None:
    """``id``, else ``<source>_id``, else nothing."""
    return next((c for c in ("id", f"{source}_id") if c in columns), None)


def surrogate_key(source: str) -> str:
    return f"{source}_sk"


def dim_name(source: str, overrides: Mapping[str, str] | None = None) -> str:
    return (overrides or {}).get(source, f"dim_{source}")


def reserved_columns(source: str) -> set[str]:
    return {surrogate_key(source), "surrogate_key", *HISTORY_FIELDS.names}


def dim_schema(source_schema: T.StructType, source: str) -> T.StructType:
    """Dimension schema: natural key, business columns, surrogate key, history columns.

    A source column that carries a reserved name gets the suffix ``_src``.
    """
    nk = natural_key(source_schema.names, source)
    if nk is None:
        raise ValueError(f"no_nk: {source} has neither 'id' nor '{source}_id'")
    reserved = reserved_columns(source)
    business = [
        T.StructField(f"{f.name}_src" if f.name in reserved else f.name, f.dataType)
        for f in source_schema
        if f.name != nk
    ]
    return T.StructType(
        [
            T.StructField(nk, source_schema[nk].dataType),
            *business,
            T.StructField(surrogate_key(source), T.LongType()),
            *HISTORY_FIELDS.fields,
        ]
    )


def business_columns(columns: Sequence[str], source: str) -> list[str]:
    skip = reserved_columns(source) | {natural_key(columns, source)}
    return [c for c in columns if c not in skip]


def clamp_ancient(df: DataFrame) -> DataFrame:
    return df.select(
        *[C.clamp_ancient(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema]
    )


def conform(
    raw: DataFrame,
    target: T.StructType,
    source: str,
    aliases: Mapping[str, str] | None = None,
    failed_out: str | None = None,
) -> DataFrame:
    """Natural key and business columns of ``target``, cast with ``try_cast``.

    ``aliases`` maps raw names to dimension names. Extra raw columns are left
    out, absent ones become typed NULLs. ``failed_out`` adds an array of
    ``(column, value)`` with the values as given that could not be cast.
    """
    raw_name = {dim: name for name, dim in (aliases or {}).items()}
    raw_name |= {f"{c}_src": c for c in raw.columns if f"{c}_src" in target.names}
    nk = natural_key(target.names, source)
    failed: list[Column] = []

    def value(name: str) -> Column:
        candidates = [raw_name.get(name, name)] + (["id"] if name == nk else [])
        found = next((c for c in candidates if c in raw.columns), None)
        column = F.col(f"`{found}`") if found else F.lit(None)
        dtype = target[name].dataType
        if found is None or raw.schema[found].dataType != dtype:
            given, column = column, column.try_cast(dtype) if found else column.cast(dtype)
            if found:
                entry = F.struct(F.lit(name).alias("column"), given.cast("string").alias("value"))
                failed.append(F.when(given.isNotNull() & column.isNull(), entry))
        return column.alias(name)

    wanted = ([nk] if nk else []) + business_columns(target.names, source)
    columns = [value(name) for name in wanted]
    if failed_out:
        none = F.array().cast("array<struct<column:string,value:string>>")
        columns.append((F.array_compact(F.array(*failed)) if failed else none).alias(failed_out))
    return raw.select(*columns)


def add_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(
        "*", *[C.missing_column(c).alias(c) for c in columns if c not in df.columns]
    )


def fill_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    def filled(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        default = C.null_default(field.dataType)
        if default is None or (columns is not None and field.name not in columns):
            return column
        return F.coalesce(column, default).alias(field.name)

    return df.select(*[filled(f) for f in df.schema])


def project_fact(df: DataFrame, fields: T.StructType | Sequence[str]) -> DataFrame:
    """Exactly the fact's columns in order: missing ones added, NULLs defaulted.

    With a ``StructType`` the columns are also cast to the declared types.
    """
    names = fields.names if isinstance(fields, T.StructType) else list(fields)
    shaped = fill_nulls(add_missing(df, names).select(*[f"`{n}`" for n in names]))
    if not isinstance(fields, T.StructType):
        return shaped
    return shaped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def scalar_to_array(df: DataFrame, scalar: str, array: str) -> DataFrame:
    """Schema migration: replace ``scalar`` by a one-element array column.

    With both present the scalar is dropped; with only the array nothing changes.
    """
    if scalar not in df.columns:
        return df
    if array in df.columns:
        return df.drop(scalar)
    return df.select(
        *[F.array(scalar).alias(array) if c == scalar else F.col(f"`{c}`") for c in df.columns]
    )
