"""Facts that are not rebuilt: versioned upsert and insert-only load."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import all_of
from lakemart.operators import compare
from lakemart.operators.keys import continue_keys, dense_keys, max_key
from lakemart.session import materialize

FLAG = "fact_current_flag"


def versioned_upsert(
    fact: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    compare_on: Sequence[str],
    pk: str,
    carried: Sequence[str] = (),
    number: Callable[..., DataFrame] = dense_keys,
) -> DataFrame:
    """The versioned fact after ``incoming``.

    A current row whose compared columns differ is closed and its new form
    added; unseen keys are added; unchanged and vanished keys stay as they are.
    ``carried`` columns (surrogate keys that move with the versions of their
    dimension) are pointed anew in a row that is otherwise unchanged.
    ``incoming`` must hold one row per key, whole in all its parts, and is
    refused otherwise: see ``compare.split_bad_keys``. ``number`` gives the
    keys; ``keys.unnumbered`` does where nobody reads them.
    """
    compare_on = [c for c in compare_on if c not in carried]
    keys = [k for k in keys if k in incoming.columns]
    names = [c for c in incoming.columns if c != pk]
    columns = [pk, *names, FLAG]
    shared = keys if fact is None else [k for k in keys if k in fact.columns]
    if not shared:
        # Nothing to match on: everything is new.
        last, kept = (0, None) if fact is None else (max_key(fact, pk), fact)
        added = number(incoming.drop(pk), names, pk, last).withColumn(FLAG, F.lit(True)).select(*columns)
        return added if kept is None else kept.select(*columns).unionByName(added)

    if not incoming.where(~all_of(F.col(k).isNotNull() for k in shared)).isEmpty():
        raise ValueError(f"versioned upsert needs every part of {list(shared)}")
    rows = compare.one_row_per_key(incoming.drop(pk), shared)
    if fact is None:
        fresh = materialize(rows, "versioned")
        require_unique(fresh, shared)
        return number(fresh.drop("_repeated"), shared, pk).withColumn(FLAG, F.lit(True)).select(*columns)

    live = F.coalesce(F.col(FLAG), F.lit(False))
    matched = compare.match_rows(
        fact.where(live), rows, shared, [c for c in compare_on if c in fact.columns]
    )
    kind = F.col("kind")
    repeated = F.coalesce(F.col("r")["_repeated"], F.lit(False))

    def pointed(side: str, name: str) -> Column:
        if side == "l" and name in carried:
            return F.when(kind == compare.SAME, F.col("r")[name]).otherwise(F.col("l")[name])
        return F.col(side)[name]

    def row(new: bool, side: str, key: Column, flag: Column) -> Column:
        return F.struct(
            F.lit(new).alias("_new"),
            repeated.alias("_repeated"),
            key.cast("bigint").alias(pk),
            *[pointed(side, c).alias(c) for c in names],
            flag.alias(FLAG),
        )

    old = F.when(kind != compare.ONLY_RIGHT, row(False, "l", F.col("l")[pk], kind != compare.DIFFERS))
    new = F.when(kind.isin(compare.ONLY_RIGHT, compare.DIFFERS), row(True, "r", F.lit(None), F.lit(True)))
    changes = materialize(
        matched.select(F.explode(F.array_compact(F.array(old, new))).alias("_r")).select("_r.*"),
        "versioned",
        partition_by="_new",
    )
    require_unique(changes, shared)
    kept = fact.where(~live).select(*columns).unionByName(changes.where("NOT _new").select(*columns))
    added = number(changes.where("_new").select(*names), shared, pk, offset=max_key(fact, pk))
    return kept.unionByName(added.withColumn(FLAG, F.lit(True)).select(*columns))


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a written set of rows has repeated keys."""
    if not rows.where("_repeated").isEmpty():
        raise ValueError(f"versioned upsert needs one row per {list(keys)}")


def needs_full_load(existing: DataFrame | None, pk: str) -> bool:
    """Target absent, without the key column, empty, or with no usable key."""
    if existing is None or pk not in existing.columns:
        return True
    low, high = existing.agg(F.min(pk), F.max(pk)).first()
    return high is None or (low == 0 and high == 0)


def unseen_rows(
    incoming: DataFrame, existing: DataFrame, business_id: str, pk: str
) -> DataFrame:
    """Rows whose business id is not loaded yet, numbered on from the last key.

    A row without an id cannot be told from one that is loaded: those are the
    caller's to reject (``nameless_rows``), and are not added.
    """
    fresh = incoming.drop(pk).where(F.col(business_id).isNotNull()).join(existing.select(business_id), business_id, "left_anti")
    ties = [c for c in fresh.columns if c != business_id]
    return continue_keys(fresh, existing, [business_id, *ties], pk).select(*incoming.columns)


def nameless_rows(incoming: DataFrame, business_id: str) -> DataFrame:
    """What ``unseen_rows`` leaves out, with its ``reason``."""
    return incoming.where(F.col(business_id).isNull()).withColumn("reason", F.lit("null_key"))


def insert_only(
    existing: DataFrame | None, incoming: DataFrame, business_id: str, pk: str
) -> DataFrame:
    """Target after an insert-only load, replacing it when it cannot be continued."""
    if needs_full_load(existing, pk):
        return incoming
    return existing.select(*incoming.columns).unionByName(
        unseen_rows(incoming, existing, business_id, pk)
    )
