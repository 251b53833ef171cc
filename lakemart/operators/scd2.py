"""Type-2 dimensions: close, insert and number in one plan.

``scd2_changes`` is a single full outer join of the current rows with the
stage; every row it returns is either left alone, closed, or to be inserted.
History is touched only to look up the last version of keys that come back,
and only its two narrow columns are read for that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.columns import OPEN_END, signature
from lakemart.operators import compare
from lakemart.operators.keys import dense_keys, max_key
from lakemart.operators.shape import business_columns, natural_key, surrogate_key
from lakemart.session import materialize

KEPT, CLOSED, INSERT = "kept", "closed", "insert"


@dataclass(frozen=True)
class Dimension:
    """Names that shape one dimension."""

    source: str
    nk: str
    business: tuple[str, ...]
    # Columns refreshed in place without opening a version (e.g. a change number).
    carried: tuple[str, ...] = ()
    sig_hash: bool = False

    @property
    def sk(self) -> str:
        return surrogate_key(self.source)

    @classmethod
    def of(cls, columns: Sequence[str], source: str, carried: Sequence[str] = (), sig_hash: bool = False) -> Dimension:
        nk = natural_key(columns, source)
        if nk is None:
            raise ValueError(f"no_nk: {source}")
        business = tuple(c for c in business_columns(columns, source) if c not in carried)
        return cls(source, nk, business, tuple(carried), sig_hash)


def is_current() -> Column:
    return F.coalesce(F.col("current_flag"), F.lit(False))


def scd2_changes(
    current: DataFrame,
    stage: DataFrame,
    dim: Dimension,
    load_ts: str,
    close_missing: bool = True,
    delete_flag: str | None = None,
) -> DataFrame:
    """Rows of the dimension after the load, with ``_kind``; inserts have no key yet.

    Both sides must hold one row per natural key. ``close_missing`` closes keys
    absent from the stage (full loads); ``delete_flag`` names a boolean stage
    column that closes its key (change feeds). Keys the stage marks
    ``_repeated`` are in quarantine: their current row stays as it is. An insert
    that follows a current row continues its version; one without has version
    NULL until its history is looked up.
    """
    matched = compare.match_rows(current, stage, [dim.nk], dim.business)
    deletes = F.coalesce(F.col("r")[delete_flag], F.lit(False)) if delete_flag else F.lit(False)
    missing = F.lit(close_missing) & (F.col("kind") == compare.ONLY_LEFT)
    held = F.coalesce(F.col("r")["_repeated"], F.lit(False)) if "_repeated" in stage.columns else F.lit(False)
    had_row = F.col("kind") != compare.ONLY_RIGHT
    closes = had_row & ~held & (missing | deletes | (F.col("kind") == compare.DIFFERS))
    opens = F.col("kind").isin(compare.ONLY_RIGHT, compare.DIFFERS) & ~deletes & ~held
    now = F.lit(load_ts).cast("timestamp")

    def old_value(name: str) -> Column:
        column = F.col("l")[name]
        if name == "effective_to":
            return F.when(closes, now).otherwise(column)
        if name == "current_flag":
            return ~closes
        if name in dim.carried:
            # A superseded row keeps its own value; any other match is refreshed.
            return F.when(closes & ~deletes, column).otherwise(F.coalesce(F.col("r")[name], column))
        return column

    def new_value(name: str) -> Column:
        if name == dim.nk or name in dim.business or name in dim.carried:
            return F.col("r")[name]
        fixed = {
            "effective_from": now,
            "effective_to": F.lit(OPEN_END).cast("timestamp"),
            "current_flag": F.lit(True),
            "version": F.col("l")["version"] + 1,
        }
        return fixed.get(name, F.lit(None)).cast(current.schema[name].dataType)

    def row(kind: Column, value) -> Column:
        return F.struct(kind.alias("_kind"), *[value(c).alias(c) for c in current.columns])

    old = F.when(had_row, row(F.when(closes, CLOSED).otherwise(KEPT), old_value))
    new = F.when(opens, row(F.lit(INSERT), new_value))
    return matched.select(F.explode(F.array_compact(F.array(old, new))).alias("_r")).select("_r.*")


def number_inserts(
    inserts: DataFrame, history: DataFrame, dim: Dimension, last_key: int, few: bool = False
) -> DataFrame:
    """Give inserted rows their version and surrogate key; ``few``: the caller has counted that one task can sort them.

    ``history`` may hold any closed rows. Only keys without a previous current
    row look there, through a semi join, so its cost follows the delta.
    """
    returning = inserts.where("version IS NULL").select(dim.nk)
    past = (
        history.select(dim.nk, "version")
        .join(returning, dim.nk, "left_semi")
        .groupBy(dim.nk)
        .agg(F.max("version").alias("_past"))
    )
    version = F.coalesce("version", F.col("_past") + 1, F.lit(1)).cast("bigint")
    dated = inserts.join(past, dim.nk, "left").select(
        *[version.alias(c) if c == "version" else F.col(f"`{c}`") for c in inserts.columns]
    )
    if dim.sig_hash:
        dated = dated.withColumn("sig_hash", signature(dim.business))
    if few:
        place = F.row_number().over(Window.orderBy(F.col(dim.nk).asc_nulls_last()))
        keyed = dated.withColumn(dim.sk, F.lit(last_key).cast("bigint") + place)
    else:
        keyed = dense_keys(dated.drop(dim.sk), [dim.nk], dim.sk, offset=last_key)
    return keyed.select(*[f"`{c}`" for c in inserts.columns])


def scd2_apply(
    table: DataFrame,
    stage: DataFrame,
    dim: Dimension,
    load_ts: str,
    close_missing: bool = True,
    delete_flag: str | None = None,
    trusted_keys: bool = False,
) -> DataFrame:
    """The whole dimension after loading ``stage``.

    Stage rows with a NULL or repeated natural key are left out (see
    ``compare.bad_key_rows`` for them); ``trusted_keys`` skips that check.
    """
    columns = table.columns
    history = table.where(~is_current())
    rows = stage if trusted_keys else compare.one_row_per_key(stage, [dim.nk])
    changes = materialize(
        scd2_changes(table.where(is_current()), rows, dim, load_ts, close_missing, delete_flag),
        "scd2",
        partition_by="_kind",
    )
    inserts = changes.where(F.col("_kind") == INSERT).select(*columns)
    numbered = number_inserts(inserts, history, dim, max_key(table, dim.sk))
    old = changes.where(F.col("_kind") != INSERT).select(*columns)
    return history.unionByName(old).unionByName(numbered).select(*columns)


def change_kinds(current: DataFrame, stage: DataFrame, dim: Dimension) -> DataFrame:
    """``(natural key, kind)`` for a load: new, changed, deleted, same."""
    names = {
        compare.ONLY_RIGHT: "new",
        compare.DIFFERS: "changed",
        compare.ONLY_LEFT: "deleted",
        compare.SAME: "same",
    }
    labels = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    matched = compare.match_rows(current, stage, [dim.nk], dim.business, null_keys=True)
    key = F.coalesce(F.col("l")[dim.nk], F.col("r")[dim.nk])
    return matched.select(key.alias(dim.nk), labels[F.col("kind")].alias("kind"))


def repair_one_current(table: DataFrame, dim: Dimension, load_ts: str) -> DataFrame:
    """Leave one current row per key, the highest version; close the others.

    Ties on the version go to the larger surrogate key.
    """
    rank = F.struct("version", dim.sk)
    live = table.where(is_current())
    best = live.groupBy(dim.nk).agg(F.max(rank).alias("_best"))
    loses = F.coalesce(F.col("_best") > rank, F.lit(False))
    changed = {
        "current_flag": ~loses,
        "effective_to": F.when(loses, F.lit(load_ts).cast("timestamp")).otherwise(F.col("effective_to")),
    }
    repaired = live.join(best, dim.nk, "left").select(
        *[changed.get(c, F.col(f"`{c}`")).alias(c) for c in table.columns]
    )
    return table.where(~is_current()).unionByName(repaired)


def with_next(table: DataFrame, dim: Dimension) -> DataFrame:
    """Every row with the start of the next version of its key, ``_next_from`` (NULL for the last).

    Neighbours are rows whose dense positions by (key, version, surrogate key)
    differ by one: a range partitioning and a join on unique numbers, so no task
    has to hold the history of a key.
    """
    placed = dense_keys(table, [dim.nk, "version", dim.sk], "_at")
    ahead = placed.select((F.col("_at") - 1).alias("_at"), F.col(dim.nk).alias("_next_nk"), F.col("effective_from").alias("_next_from"))
    met = placed.join(ahead, "_at", "left")
    same = F.col(dim.nk) == F.col("_next_nk")
    return met.select(*[f"`{c}`" for c in table.columns], F.when(same, F.col("_next_from")).alias("_next_from"))


def interval_faults(table: DataFrame, dim: Dimension) -> DataFrame:
    """``(key, version, surrogate key, fault)`` of rows whose interval does not fit the next one of their key.

    not_last_current: current although a later version exists; overlap: ends
    after the next begins; empty: ends before it begins; closed_last: the last
    version is current but has an end, or is closed without one. A gap before
    the next version is none: the key was away.
    """
    later = F.col("_next_from").isNotNull()
    live = is_current()
    open_end = F.col("effective_to") == F.lit(OPEN_END).cast("timestamp")
    fault = (
        F.when(later & live, "not_last_current")
        .when(later & (F.col("effective_to") > F.col("_next_from")), "overlap")
        .when(F.col("effective_to") < F.col("effective_from"), "empty")
        .when(~later & (live != open_end), "closed_last")
    )
    found = with_next(table, dim).withColumn("fault", fault).where("fault IS NOT NULL")
    return found.select(dim.nk, "version", dim.sk, "fault")


def repair_intervals(table: DataFrame, dim: Dimension, load_ts: str) -> DataFrame:
    """The history with every interval ending where the next begins, at the latest; only the last version is current.

    A last version that is closed without an end gets ``load_ts``; one that is
    current with an end gets the open end. Rows without a fault stay as they are.
    """
    later, live, end = F.col("_next_from").isNotNull(), is_current(), F.col("effective_to")
    open_end = F.lit(OPEN_END).cast("timestamp")
    first_end = F.greatest(F.least(end, F.coalesce("_next_from", end)), F.col("effective_from"))
    changed = {
        "effective_to": F.when(later, first_end).when(live, open_end).when(end == open_end, F.lit(load_ts).cast("timestamp")).otherwise(first_end),
        "current_flag": F.when(later, F.lit(False)).otherwise(F.col("current_flag")),
    }
    return with_next(table, dim).select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in table.columns])
