"""Row matching: the one full outer join behind SCD2, versioned facts and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import all_of, same_values

ONLY_LEFT, ONLY_RIGHT, SAME, DIFFERS = "only_left", "only_right", "same", "differs"


def match_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    null_keys: bool = False,
) -> DataFrame:
    """Full outer join on ``keys``: columns ``l`` and ``r`` (whole rows) and ``kind``.

    Whether a side matched is told by a marker column of its own, so NULL keys
    count as unmatched rows. ``compare`` is null-safe, with NaN equal to NaN.
    AQE cannot split a full outer join, so keys should be unique per side;
    ``null_keys`` spreads rows with a NULL key, which match nothing, over all
    tasks instead of one.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        known = all_of(F.col(k).isNotNull() for k in keys)
        salt = [F.when(known, F.lit(0)).otherwise(F.xxhash64(*df.columns)).alias(f"_{name}_salt")] if null_keys else []
        return df.select(
            *[F.col(k).alias(f"_{name}_{k}") for k in keys],
            *salt,
            F.struct(*df.columns).alias(name),
            F.lit(True).alias(f"_in_{name}"),
        )

    l_side, r_side = side(left, "l"), side(right, "r")
    on = all_of(F.col(f"_l_{k}") == F.col(f"_r_{k}") for k in [*keys, *(["salt"] if null_keys else [])])
    kind = (
        F.when(F.col("_in_r").isNull(), ONLY_LEFT)
        .when(F.col("_in_l").isNull(), ONLY_RIGHT)
        .when(same_values("l", "r", compare), SAME)
        .otherwise(DIFFERS)
    )
    return l_side.join(r_side, on, "full").select("l", "r", kind.alias("kind"))


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per non-null key, with ``_repeated`` when the key had several.

    A partial aggregate: a hot repeated key shrinks before the shuffle, and the
    result is already partitioned on the key for the join that follows.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.where(all_of(F.col(k).isNotNull() for k in keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("_n"), F.any_value(F.struct(*rest) if rest else F.lit(1)).alias("_row"))
        .select(
            *[F.col(k) if k in keys else F.col("_row")[k].alias(k) for k in df.columns],
            (F.col("_n") > 1).alias("_repeated"),
        )
    )


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not null and occurs once."""
    return one_row_per_key(df, keys).where("NOT _repeated").drop("_repeated")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (NULL counts as a value), with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def bad_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole rows that ``unique_rows`` leaves out, with a ``reason``."""
    known = all_of(F.col(k).isNotNull() for k in keys)
    nulls = df.where(~known).withColumn("reason", F.lit("null_key"))
    repeated = duplicate_keys(df.where(known), keys).drop("n_rows")
    doubles = df.join(repeated, list(keys), "left_semi").withColumn("reason", F.lit("duplicate_key"))
    return nulls.unionByName(doubles)


def split_bad_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is whole and occurs once, and the others with their ``reason``.

    The keys are counted narrowly; whole rows meet that count once per side.
    """
    known = all_of(F.col(k).isNotNull() for k in keys)
    repeated = duplicate_keys(df.where(known).select(*keys), keys).drop("n_rows")
    return df.where(known).join(repeated, list(keys), "left_anti").select(*[f"`{c}`" for c in df.columns]), bad_key_rows(df, keys)


def latest_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order_by`` and then by the other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*order_by, *rest)).alias("_row"))
        .select(*[F.col(k) if k in keys else F.col("_row")[k].alias(k) for k in df.columns])
    )
