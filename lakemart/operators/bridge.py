"""Many-to-one bridges: child keys folded into the parent row.

Arrays are a single cell per parent by definition. They are built with
partial aggregation, so only distinct members are shuffled. Where a parent may
own more members than a cell should hold, ``bridge_rows`` gives the same
content as rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import all_of
from lakemart.operators.keys import position_in_group


def members_per_parent(
    children: DataFrame, parent: str, member: str, out: str, count_out: str | None = None
) -> DataFrame:
    """Sorted set of non-null members per parent, and optionally their count.

    The count is of rows with a member, not of distinct members.
    """
    aggregates = [F.sort_array(F.collect_set(F.col(member).cast("bigint"))).alias(out)]
    if count_out:
        aggregates.append(F.count(member).cast("int").alias(count_out))
    return children.groupBy(parent).agg(*aggregates)


def ordered_members(
    children: DataFrame, parent: str, member: str, order_by: str | None, out: str
) -> DataFrame:
    """Members per parent by (order value, member), nulls first, pairs distinct."""
    order = F.col(order_by) if order_by in children.columns else F.lit(None).cast("timestamp")
    pair = F.struct(order.alias("o"), F.col(member).cast("bigint").alias("m"))
    return children.groupBy(parent).agg(
        F.transform(F.sort_array(F.collect_set(pair)), lambda x: x["m"]).alias(out)
    )


def linked_members(
    links: DataFrame, parent: str, fk: str, dim: DataFrame, sk: str, out: str
) -> DataFrame:
    """Members reached through a link table; parents with none known are absent."""
    pairs = dim.select(F.col("id").alias("__id"), F.col(sk).cast("bigint").alias("__sk"))
    # Distinct links first: a hot parent or member then costs one row per pair.
    resolved = links.select(parent, fk).distinct().join(pairs, F.col(fk) == F.col("__id"), "inner")
    return members_per_parent(resolved, parent, "__sk", out)


def bridge_rows(
    children: DataFrame, parent: str, member: str, order_by: Sequence[str], out: str = "position"
) -> DataFrame:
    """The bridge as rows ``(parent, member, order..., position)``.

    Exact for any number of members per parent: no group meets in one task.
    """
    columns = list(dict.fromkeys([parent, *order_by, member]))
    pairs = children.select(*columns).where(F.col(parent).isNotNull()).distinct()
    tail = [c for c in columns if c != parent]
    return position_in_group(pairs, [parent], tail, out)


#: Members of one cell of a chunked bridge.
CHUNK_MEMBERS = 10_000


def bridge_chunks(
    children: DataFrame, parent: str, member: str, order_by: Sequence[str] = (), out: str = "sks", size: int = CHUNK_MEMBERS
) -> DataFrame:
    """``(parent, chunk_no, n_members, out)``: a parent's ordered distinct members in cells of at most ``size``.

    Chunks count from 1 and follow each other, so a reader can go through any
    number of members in order; all but the last are full. Positions are dense
    numbers over the distinct pairs, so no task has to hold a parent. NULL
    members are left out.
    """
    rows = bridge_rows(children.where(F.col(member).isNotNull()), parent, member, order_by, "_position")
    chunked = rows.withColumn("chunk_no", F.floor((F.col("_position") - 1) / size).cast("bigint") + 1)
    pairs = F.sort_array(F.collect_list(F.struct("_position", F.col(member).alias("m"))))
    return chunked.groupBy(parent, "chunk_no").agg(
        F.count("*").alias("n_members"), F.transform(pairs, lambda p: p["m"]).alias(out)
    )


def role_array(
    df: DataFrame,
    keys: Sequence[str],
    role_columns: Sequence[str],
    dim: DataFrame,
    sk: str,
    out: str,
) -> DataFrame:
    """Several foreign keys of one row to one dimension, as an array of its keys.

    Role order is kept, misses are removed, repeats stay. One row of ``df``
    gives one row, also where ``keys`` repeat; an id with several dimension
    rows stands for the one with the largest key. Returns ``keys`` and ``out``.
    Each role is a left join, so Catalyst and AQE choose how each is run, and a
    hot id is split.
    """
    pairs = dim.groupBy(F.col("id").cast("bigint").alias("__id")).agg(F.max(F.col(sk).cast("bigint")).alias("__sk"))
    found = df.select(*keys, *[F.col(c).cast("bigint").alias(f"__fk{i}") for i, c in enumerate(role_columns)])
    for i in range(len(role_columns)):
        side = pairs.select(F.col("__id").alias("__key"), F.col("__sk").alias(f"__sk{i}"))
        found = found.join(side, F.col(f"__fk{i}") == F.col("__key"), "left").drop("__key", f"__fk{i}")
    members = F.array_compact(F.array(*[F.col(f"__sk{i}") for i in range(len(role_columns))]))
    return found.select(*keys, members.alias(out))


def max_member(children: DataFrame, parent: str, member: str, out: str) -> DataFrame:
    """One of many: the largest member key per parent."""
    return children.groupBy(parent).agg(F.max(F.col(member).cast("bigint")).alias(out))


def first_value_nulls_first(column: Column) -> Column:
    """Minimum that answers NULL as soon as one value is NULL (ascending order)."""
    return F.when(F.max(column.isNull()), F.lit(None)).otherwise(F.min(column))


def milestones(
    events: DataFrame,
    keys: Sequence[str],
    status: str,
    at: str,
    first: str,
    first_of: Mapping[str, str],
) -> DataFrame:
    """First event per key and the first event per ``{status: column}``, in one pass.

    A key with a NULL part has no status moments: such keys match nothing.
    """
    whole = all_of(F.col(k).isNotNull() for k in keys)
    moments = [
        F.min(F.when(whole & (F.col(status) == s), F.col(at))).alias(out) for s, out in first_of.items()
    ]
    return events.groupBy(*keys).agg(first_value_nulls_first(F.col(at)).alias(first), *moments)


def latest_per_status(
    events: DataFrame, keys: Sequence[str], status: str, at: str, latest_of: Mapping[str, str]
) -> DataFrame:
    """Latest event per ``{status: column}``; every key with any event is present."""
    moments = [F.max(F.when(F.col(status) == s, F.col(at))).alias(out) for s, out in latest_of.items()]
    return events.groupBy(*keys).agg(*moments)
