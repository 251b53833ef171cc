"""Mirroring to a relational target: projection, slice, watermarks, resulting state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import names
from lakemart.functions.columns import OPEN_END


@dataclass(frozen=True)
class MirrorSettings:
    """Per-table settings: exclusion, primary key hint, type and name overrides."""

    exclude: bool = False
    pk: str | None = None
    casts: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_properties(cls, properties: Mapping[str, str], default: MirrorSettings | None = None) -> MirrorSettings:
        """Read ``mirror.exclude``, ``mirror.pk``, ``mirror.cast.*``, ``mirror.rename.*``."""
        base = default or cls()

        def under(prefix: str) -> dict[str, str]:
            return {k[len(prefix):]: v for k, v in properties.items() if k.startswith(prefix)}

        return cls(
            exclude=base.exclude or properties.get("mirror.exclude", "").lower() == "true",
            pk=properties.get("mirror.pk") or base.pk,
            casts={**base.casts, **under("mirror.cast.")},
            renames={**base.renames, **under("mirror.rename.")},
        )


# Primary keys of the conformed dimensions.
DEFAULT_SETTINGS = {
    "dim_date": MirrorSettings(pk="date_id"),
    "dim_status": MirrorSettings(pk="status_id"),
}


@dataclass(frozen=True)
class MirrorTable:
    """Target layout of one table: name, columns with types, primary key."""

    name: str
    source_columns: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    pk: str | None

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]


def layout(df: DataFrame, table: str, settings: MirrorSettings | None = None, with_pk: bool = True) -> MirrorTable:
    settings = settings or DEFAULT_SETTINGS.get(table, MirrorSettings())
    target = names.safe_columns(df.columns, settings.renames)
    columns = tuple(
        (target[f.name], settings.casts.get(target[f.name], names.sql_type(f.dataType))) for f in df.schema
    )
    pk = None
    if with_pk:
        # The hint may be given as a source name or as a target name.
        pk = settings.pk if settings.pk in target.values() else target[names.pick_primary_key(df.columns, settings.pk)]
    return MirrorTable(names.safe_name(table, "table"), tuple(df.columns), columns, pk)


def mirror_projection(df: DataFrame, table: MirrorTable) -> DataFrame:
    """Columns renamed and cast for the target; types it lacks travel as text.

    A column whose target type was overridden is cast to that type where Spark
    has it: a value that does not fit fails the load instead of the statement.
    """

    def shipped(source: str, target: str, sql: str) -> Column:
        own = df.schema[source].dataType
        told = names.override_type(sql) if sql != names.sql_type(own) else None
        return F.col(f"`{source}`").cast(told or names.mirror_type(own)).alias(target)

    return df.select(*[shipped(source, *column) for source, column in zip(table.source_columns, table.columns)])


def mirror_slice(df: DataFrame, pk: str, last_key=None, last_effective=None) -> DataFrame:
    """Rows to ship since the watermarks: new keys, new versions, rows closed since.

    Closing a row moves neither its key nor ``effective_from``; without the
    last condition the target would show it as current for ever. Without
    watermarks everything is shipped. The predicates reach the parquet scan.
    """
    conditions = []
    if last_key is not None:
        conditions.append(F.col(pk) > F.lit(last_key))
    if last_effective is not None and "effective_from" in df.columns:
        since = F.lit(last_effective).cast("timestamp")
        open_end = F.lit(OPEN_END).cast("timestamp")
        conditions.append(F.col("effective_from") > since)
        if "effective_to" in df.columns:
            conditions.append((F.col("effective_to") > since) & (F.col("effective_to") < open_end))
    if not conditions:
        return df
    predicate = conditions[0]
    for condition in conditions[1:]:
        predicate = predicate | condition
    return df.where(predicate)


def watermarks(slice_: DataFrame, pk: str, table: str, run_ts: str) -> DataFrame:
    """Control row of a shipped slice: table, largest key, latest ``effective_from``, rows.

    One aggregate over two narrow columns. A key that is not a number gives no
    key watermark.
    """
    numeric = dict(slice_.dtypes)[pk] in ("tinyint", "smallint", "int", "bigint")
    key = F.max(F.col(pk).cast("bigint")) if numeric else F.lit(None).cast("bigint")
    effective = (
        F.max("effective_from") if "effective_from" in slice_.columns else F.lit(None).cast("timestamp")
    )
    marks = slice_.agg(
        key.alias("last_max_sk"), effective.alias("last_max_effective_from"), F.count("*").alias("n_rows")
    )
    return marks.select(
        F.lit(table).alias("table_name"),
        "last_max_sk",
        "last_max_effective_from",
        "n_rows",
        F.lit(run_ts).cast("timestamp").alias("last_run_ts"),
    )


def merge_control(control: DataFrame, update: DataFrame) -> DataFrame:
    """Control table after ``update``: newest row per table, watermarks never fall back to NULL."""
    values = ["last_max_sk", "last_max_effective_from"]
    both = control.select("table_name", *values, "last_run_ts").unionByName(
        update.select("table_name", *values, "last_run_ts")
    )
    return both.groupBy("table_name").agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col("last_run_ts"))).alias(v) for v in values],
        F.max("last_run_ts").alias("last_run_ts"),
    )


def upsert_state(target: DataFrame, slice_: DataFrame, pk: str) -> DataFrame:
    """The target after upserting ``slice_`` on ``pk``.

    The slice is the small side of the anti join; AQE broadcasts it when its
    measured size allows.
    """
    kept = target.join(slice_.select(pk), pk, "left_anti")
    return kept.unionByName(slice_.select(*target.columns))


def unknown_member(df: DataFrame, key: str) -> DataFrame:
    """Add the row that key 0 of the facts refers to; its other columns are NULL."""
    row = df.sparkSession.range(1).select(
        *[
            (F.lit(0) if f.name == key else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in df.schema
        ]
    )
    return df.unionByName(row)


def mirrored_tables(tables: Sequence[str]) -> list[str]:
    """Tables the dimension mirror takes: all but facts and bridges."""
    return [t for t in tables if not t.startswith(("fact_", "bridge_"))]
