"""Load validation: reconciliation, keys, references, casts, large objects."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.columns import any_of, row_digests
from lakemart.session import materialize


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every difference as ``(keys, kind)``: missing_target, missing_source, mismatch, duplicate_key.

    Rows are compared as counted sets, so a repeated key is never paired with
    itself: both sides are counted per (key, values) by one partial aggregate,
    and per key what differs decides. A key with the same rows on both sides,
    repeated or not, is no finding; one that repeats on a side and differs is
    ``duplicate_key``. NULL keys are compared as rows: each difference is a
    missing row. All findings are kept; ``reconcile_verdict`` holds the limit.
    """
    shared = [c for c in source.columns if c in target.columns and c not in keys]
    both = source.select(*keys, *shared, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*keys, *shared, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    counted = both.groupBy(*keys, *shared).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = counted.where(whole).groupBy(*keys).agg(
        F.sum("_s").alias("_s"), F.sum("_t").alias("_t"), F.max(F.col("_s") != F.col("_t")).alias("_differs")
    )
    kind = (
        F.when(F.col("_t") == 0, "missing_target")
        .when(F.col("_s") == 0, "missing_source")
        .when((F.col("_s") > 1) | (F.col("_t") > 1), "duplicate_key")
        .otherwise("mismatch")
    )
    found = per_key.where("_differs").select(*keys, kind.alias("kind"))
    loose = counted.where(~whole & (F.col("_s") != F.col("_t")))
    side = F.when(F.col("_s") > F.col("_t"), "missing_target").otherwise("missing_source")
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs(F.col("_s") - F.col("_t"))))
    return found.unionByName(loose.select(*keys, side.alias("kind"), each.alias("_n")).drop("_n"))


#: Key buckets whose digests are compared before any row is.
DIGEST_BUCKETS = 4096


def bucket_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """Per key bucket: rows, and order-free sums and xors of two row digests. A task gives one row per bucket at most."""
    d1, d2 = row_digests(df, [*keys, *columns])
    digested = df.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"), d1.alias("d1"), d2.alias("d2"))
    # Sums of half words stay exact and below 64 bits for 2^31 rows of a bucket.
    return digested.groupBy("bucket").agg(
        F.count("*").alias("n"),
        *[F.sum(F.shiftright(d, 32)).alias(f"{d}_high") for d in ("d1", "d2")],
        *[F.sum(F.col(d).bitwiseAND(0xFFFFFFFF)).alias(f"{d}_low") for d in ("d1", "d2")],
        *[F.bit_xor(d).alias(f"{d}_xor") for d in ("d1", "d2")],
    )


def differing_buckets(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = DIGEST_BUCKETS
) -> DataFrame:
    """Buckets whose digests are not the same on both sides: at most ``buckets`` rows."""
    a, b = (bucket_digests(df, keys, columns, buckets) for df in (source, target))
    parts = [c for c in a.columns if c != "bucket"]
    other = b.select(F.col("bucket").alias("_bucket"), *[F.col(c).alias(f"_{c}") for c in parts])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in parts])
    return a.join(other, F.col("bucket") == F.col("_bucket"), "full").where(~same).select(F.coalesce("bucket", "_bucket").alias("bucket"))


def reconcile_by_digest(source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """The findings of ``reconcile``, comparing rows only in key buckets whose digests differ.

    Tables that agree move one row per bucket and task. Both sides are scanned
    once more where some differ; then the rows of those buckets alone are shuffled.
    """
    shared = [c for c in source.columns if c in target.columns and c not in keys]
    bad = materialize(differing_buckets(source, target, keys, shared, buckets), "digests")
    at = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def rows(df: DataFrame) -> DataFrame:
        found = df.select(*keys, *shared).withColumn("_bucket", at)
        # One narrow row per bucket at most.
        return found.join(F.broadcast(bad.withColumnRenamed("bucket", "_bucket")), "_bucket", "left_semi").drop("_bucket")

    return reconcile(rows(source), rows(target), keys)


# Findings after which a table is suspended from validation.
TABLE_FAILURE_LIMIT = 1000


def reconcile_verdict(findings: DataFrame, limit: int = TABLE_FAILURE_LIMIT) -> DataFrame:
    """Finding counts of one table and whether it is over the limit."""
    kinds = ("missing_target", "missing_source", "mismatch", "duplicate_key")
    return findings.agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in kinds],
        (F.count("*") > limit).alias("suspended"),
    )


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, unknown: int | None = 0) -> DataFrame:
    """Foreign keys without a parent: ``(fk, n_rows, is_unknown)``.

    Counted per key before the anti join, so a hot key is one row there. NULL
    is no reference; the unknown member is marked apart.
    """
    counts = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("n_rows"))
    keys = parent.select(F.col(pk).alias("_pk"))
    found = counts.join(keys, F.col(fk) == F.col("_pk"), "left_anti")
    is_unknown = F.lit(False) if unknown is None else F.col(fk) == F.lit(unknown)
    return found.withColumn("is_unknown", is_unknown)


def key_check(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """``(table, check, n_bad)`` for a primary key: repeated and null values."""
    known = [F.col(k).isNotNull() for k in keys]
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    null_key = ~reduce(lambda a, b: a & b, known)
    return counts.agg(
        F.coalesce(F.sum(F.when(~null_key & (F.col("_n") > 1), F.col("_n") - 1)), F.lit(0)).alias("dup"),
        F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("nul"),
    ).select(
        F.lit(table).alias("table"),
        F.explode(
            F.array(
                F.struct(F.lit("pk_duplicate").alias("check"), F.col("dup").alias("n_bad")),
                F.struct(F.lit("pk_null").alias("check"), F.col("nul").alias("n_bad")),
            )
        ).alias("_c"),
    ).select("table", "_c.*")


def reference_check(
    fact: DataFrame, table: str, references: Iterable[tuple[str, DataFrame, str]]
) -> DataFrame:
    """``(table, check, n_bad)`` per foreign key: orphan rows and unknown-member rows."""
    parts = []
    for fk, parent, pk in references:
        totals = orphans(fact, fk, parent, pk).agg(
            F.coalesce(F.sum(F.when(~F.col("is_unknown"), F.col("n_rows"))), F.lit(0)).alias("orphan"),
            F.coalesce(F.sum(F.when(F.col("is_unknown"), F.col("n_rows"))), F.lit(0)).alias("unknown"),
        )
        parts.append(
            totals.select(
                F.lit(table).alias("table"),
                F.explode(
                    F.array(
                        F.struct(F.lit(f"fk_orphan:{fk}").alias("check"), F.col("orphan").alias("n_bad")),
                        F.struct(F.lit(f"fk_unknown:{fk}").alias("check"), F.col("unknown").alias("n_bad")),
                    )
                ).alias("_c"),
            ).select("table", "_c.*")
        )
    return reduce(DataFrame.unionByName, parts)


def star_check(
    facts: Mapping[str, DataFrame],
    references: Mapping[str, Mapping[str, tuple[str, str]]],
    dims: Mapping[str, DataFrame],
    unknown: int = 0,
) -> DataFrame:
    """``(table, fk, n_rows, n_orphans, n_unknown)`` of every declared foreign key, one scan per fact.

    The foreign keys of all facts are stacked as (number of the referenced key,
    value) and counted per value by one partial aggregate, a count for each
    column that refers to that key; a hot value is a row per task. The counts
    meet the stacked dimension keys in one join on the same columns, so either
    side is shuffled once. NULL is no reference; ``unknown`` counts apart unless
    the dimension holds it. Columns that a fact lacks are left out.
    """
    refs: dict[tuple[str, str], list[tuple[str, str]]] = {}
    stacked = []
    for table, columns in references.items():
        if table not in facts:
            continue
        fact = facts[table]
        entries = []
        for c, ref in columns.items():
            if c in fact.columns and ref[0] in dims:
                holders = refs.setdefault(ref, [])
                place = (F.lit(list(refs).index(ref)).alias("ref"), F.lit(len(holders)).alias("slot"))
                entries.append(F.struct(*place, F.col(c).cast("bigint").alias("value")))
                holders.append((table, c))
        if entries:
            stacked.append(fact.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*"))
    slots = range(max(map(len, refs.values())))
    counts = [F.count_if(F.col("slot") == i).alias(f"n{i}") for i in slots]
    counted = reduce(DataFrame.unionByName, stacked).where("value IS NOT NULL").groupBy("ref", "value").agg(*counts)
    keys = [dims[dim].select(F.lit(i).alias("ref"), F.col(key).cast("bigint").alias("value")) for i, (dim, key) in enumerate(refs)]
    known = reduce(DataFrame.unionByName, keys).distinct().withColumn("_known", F.lit(True))
    bad, none = F.col("_known").isNull(), F.col("value") == unknown
    sums = [
        F.struct(
            F.lit(i).alias("slot"),
            F.sum(f"n{i}").alias("n_rows"),
            F.sum(F.when(bad & ~none, F.col(f"n{i}")).otherwise(0)).alias("n_orphans"),
            F.sum(F.when(bad & none, F.col(f"n{i}")).otherwise(0)).alias("n_unknown"),
        )
        for i in slots
    ]
    summed = counted.join(known, ["ref", "value"], "left").groupBy("ref").agg(F.array(*sums).alias("_s")).select("ref", F.explode("_s").alias("_s"))
    places = [(table, c, i, slot) for i, holders in enumerate(refs.values()) for slot, (table, c) in enumerate(holders)]
    declared = counted.sparkSession.createDataFrame(places, "table string, fk string, ref int, slot int")
    joined = declared.join(summed.select("ref", "_s.*"), ["ref", "slot"], "left").na.fill(0, ["n_rows", "n_orphans", "n_unknown"])
    return joined.select("table", "fk", "n_rows", "n_orphans", "n_unknown")


def split_casts(df: DataFrame, target: Mapping[str, T.DataType | str]) -> tuple[DataFrame, DataFrame]:
    """Cast columns; rows with a value that cannot be cast go to the second result.

    The quarantine keeps the original values and lists the failing columns.
    """
    failed = {
        c: F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull() for c, t in target.items()
    }
    bad = any_of(failed.values())
    good = df.where(~bad).select(
        *[F.col(f"`{c}`").try_cast(target[c]).alias(c) if c in target else F.col(f"`{c}`") for c in df.columns]
    )
    reasons = F.array_compact(F.array(*[F.when(f, F.lit(c)) for c, f in failed.items()]))
    return good, df.where(bad).withColumn("bad_columns", reasons)


def cast_failures(df: DataFrame, target: Mapping[str, T.DataType | str], limit: int = 0) -> DataFrame:
    """Failure count per column in one pass, and ``suspended`` when over the limit."""
    failed = {
        c: F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull() for c, t in target.items()
    }
    counted = df.agg(
        *[F.count_if(f).alias(f"_f{i}") for i, f in enumerate(failed.values())],
        F.count_if(any_of(failed.values())).alias("_rows"),
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_f{i}").alias("n_failed"),
            (F.col("_rows") > limit).alias("suspended"),
        )
        for i, c in enumerate(failed)
    ]
    return counted.select(F.explode(F.array(*entries)).alias("_c")).select("_c.*")


# Fixed value: largest large object taken over by the extract, in units of 1024.
LOB_LIMIT_KB = 32


def limit_lobs(df: DataFrame, columns: Sequence[str], limit_kb: int = LOB_LIMIT_KB) -> DataFrame:
    """Limited large objects: values stay whole; each listed column gains its size and an over-limit flag.

    ``<column>_size`` counts characters of text and bytes of binary (NULL for
    NULL); a target with the limit can then hold or divert flagged rows.
    """
    size = {c: F.length(f"`{c}`").cast("bigint") for c in columns}
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[x.alias(f"{c}_size") for c, x in size.items()],
        *[F.coalesce(x > limit_kb * 1024, F.lit(False)).alias(f"{c}_over_limit") for c, x in size.items()],
    )
