"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import materialize, settled

__all__ = ["materialize", "settled", "table", "map_batches", "on_workers", "small", "told_apart", "components", "WORD_BREAK"]

#: Bytes that end a word: space and 0x09 to 0x0D.
WORD_BREAK = r"[\x20\x09-\x0D]+"

#: Rows (of two longs) up to which a side may be broadcast; about 8 MB.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers that share the driver's file system import this package from where it lies.

    On a cluster without such a path the package is installed or sent with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def map_batches(
    df: DataFrame,
    schema: str | T.StructType,
    fn: Callable[[pa.RecordBatch], pa.Table | pa.RecordBatch],
    rows: int = 10_000,
) -> DataFrame:
    """``mapInArrow`` over at most ``rows`` rows at a time; an empty batch gives nothing.

    ``fn`` finds columns by position. Names with dots, which ``mapInArrow``
    cannot take, are replaced on the way in and put back on the way out.
    """
    on_workers(df.sparkSession)
    made = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    safe = [f"_{i}" for i in range(len(made))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows)).rename_columns(safe)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    kinds = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(safe, made)])
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))]).mapInArrow(run, kinds).toDF(*made.names)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows; else as it is, for a sorted join.

    ``df`` must be cheap to count (a written table).
    """
    n = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def told_apart(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows`` with ``_tie`` beside ``_key`` and ``_text``, and whether a key has several rows.

    ``_tie`` tells texts of one key apart: a hash of the text where a key has
    several rows, else 0. It depends on the rows only, not on their order.
    """
    counted = rows.where("_key IS NOT NULL").groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1")
    twice = materialize(counted.select("_key", F.lit(True).alias("_many")), "keys-twice")
    if twice.limit(1).count() == 0:
        return rows.withColumn("_tie", F.lit(0).cast("long")), False
    tie = F.when(F.col("_many"), F.xxhash64("_text")).otherwise(F.lit(0).cast("long"))
    return rows.join(small(twice), "_key", "left").withColumn("_tie", tie).drop("_many"), True


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(id, component)`` for every id in the links ``(a, b)``: the smallest id reachable.

    Labels start at the id. Each round takes the least label among the
    neighbours (a partial aggregate, so a hub costs one row per task), then the
    label of that label, which halves the depth. Every round is a written
    table; only a count of changes reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, label)
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), label)
    while True:
        told = (
            both.join(labels, both.b == labels.id)
            .groupBy("a")
            .agg(F.min("component").alias("_near"))
            .withColumnRenamed("a", "id")
        )
        near = labels.join(told, "id").select("id", "component", F.least("component", "_near").alias("_new"))
        up = labels.select(F.col("id").alias("_new"), F.col("component").alias("_up"))
        jumped = near.join(up, "_new").select(
            "id", F.least("_new", "_up").alias("component"), (F.least("_new", "_up") < F.col("component")).alias("_moved")
        )
        jumped = materialize(jumped, label)
        labels = jumped.select("id", "component")
        if jumped.where("_moved").limit(1).count() == 0:
            return labels


def select_keeping(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The named columns, quoted, so that names with dots work."""
    return df.select(*[F.col(f"`{k}`") for k in keys])
