"""Dense surrogate keys: the answer of a global ``row_number()``, many tasks wide.

A window without partitions sorts every row in one task. Here the rows are
range-partitioned and sorted, written once to shared scratch together with
``monotonically_increasing_id`` (partition number in the upper bits, position
inside the partition in the lower 33), and each partition then gets the count
of the rows before it. The only unpartitioned window runs over one row per
range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import materialize

_POSITION_BITS = 33


def dense_keys(
    df: DataFrame,
    order_by: Sequence[str],
    out: str,
    offset: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = offset + 1..N following ``order_by`` ascending, nulls last.

    ``order_by`` should identify a row; rows tied on all of it are numbered in
    arbitrary order (fixed once written).
    """
    order = [F.col(f"`{c}`").asc_nulls_last() for c in order_by]
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    numbered = materialize(
        spread.sortWithinPartitions(*order).withColumn("_position", F.monotonically_increasing_id()),
        "keys",
    ).withColumn("_part", F.shiftright("_position", _POSITION_BITS))

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    within = F.col("_position").bitwiseAND((1 << _POSITION_BITS) - 1)
    # One row per range partition, so the broadcast is bounded by the task count.
    return numbered.join(F.broadcast(offsets), "_part").select(
        *[f"`{c}`" for c in df.columns],
        (F.lit(offset).cast("bigint") + F.col("_before") + within + 1).alias(out),
    )


def unnumbered(df: DataFrame, order_by: Sequence[str], out: str, offset: int = 0) -> DataFrame:
    """In place of :func:`dense_keys` where nobody reads ``out``: NULL in every row, nothing is sorted or written."""
    return df.withColumn(out, F.lit(None).cast("bigint"))


def max_key(df: DataFrame, column: str) -> int:
    """Largest key in use, 0 when there is none. A single number on the driver."""
    return df.agg(F.max(column).cast("bigint")).first()[0] or 0


def continue_keys(
    df: DataFrame, existing: DataFrame, order_by: Sequence[str], out: str
) -> DataFrame:
    """Number ``df`` on from the largest ``out`` in ``existing``."""
    return dense_keys(df, order_by, out, offset=max_key(existing, out))


def position_in_group(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str], out: str
) -> DataFrame:
    """Add ``out`` = 1..n inside each group without one task per group.

    Every row gets a global dense key ordered by (group, order); the position is
    the distance to the first key of its group. A group holding a third of the
    rows is spread over as many range partitions as its size asks for, and the
    join side per group is one row, which AQE can replicate to split the group.
    """
    keyed = dense_keys(df, [*group, *order_by], "_global")
    starts = keyed.groupBy(*group).agg(F.min("_global").alias("_start"))
    renamed = starts.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_start")
    on = [keyed[g].eqNullSafe(renamed[f"_g_{g}"]) for g in group]
    return keyed.join(renamed, on, "inner").select(
        *[f"`{c}`" for c in df.columns],
        (F.col("_global") - F.col("_start") + 1).alias(out),
    )
