"""Key lookups: natural key to surrogate key, chains of hops, candidate columns.

No broadcast hints here: dimensions grow with the data, so the choice between
broadcast and sort-merge is left to Catalyst's size check and AQE, which also
splits hot foreign keys (NULL included) on the fact side of a left join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current(df: DataFrame) -> DataFrame:
    """Current rows of a dimension; tables without the flag pass unchanged."""
    return df.where("current_flag") if "current_flag" in df.columns else df


def attach(
    df: DataFrame, other: DataFrame, fk: str, take: Mapping[str, str], nk: str = "id"
) -> DataFrame:
    """Left join ``other`` on ``df.fk = other.nk`` and add ``{its column: new name}``.

    Existing columns of the same new name are replaced.
    """
    side = other.select(
        F.col(nk).alias("__nk"), *[F.col(c).alias(f"__take_{name}") for c, name in take.items()]
    )
    keep = [F.col(f"`{c}`") for c in df.columns if c not in take.values()]
    taken = [F.col(f"__take_{name}").alias(name) for name in take.values()]
    return df.join(side, F.col(f"`{fk}`") == F.col("__nk"), "left").select(*keep, *taken)


def lookup_sk(
    df: DataFrame, dim: DataFrame, fk: str, sk: str, out: str, nk: str = "id"
) -> DataFrame:
    """Add the surrogate key of the current ``dim`` row; NULL on a miss.

    A missing foreign-key column gives NULL as well; facts turn that into 0.
    """
    if fk not in df.columns:
        return df.withColumn(out, F.lit(None).cast("bigint"))
    pairs = current(dim).select(F.col(nk).alias(nk), F.col(sk).cast("bigint").alias(sk))
    return attach(df, pairs, fk, {sk: out}, nk)


def first_present(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in columns), None)


def lookup_by_candidates(
    df: DataFrame, dim: DataFrame, candidates: Sequence[str], sk: str, out: str
) -> DataFrame:
    """Use ``sk`` if ``df`` carries it, else the first candidate FK present, else 0."""
    if sk in df.columns:
        return df.withColumn(out, F.col(sk).cast("bigint"))
    fk = first_present(df.columns, candidates)
    if fk is None:
        return df.withColumn(out, F.lit(0).cast("bigint"))
    return lookup_sk(df, dim, fk, sk, out)
