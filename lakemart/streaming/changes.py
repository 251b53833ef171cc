"""Change feeds into type-2 dimensions with Structured Streaming.

A feed row is ``(op, seq, natural key, payload...)`` with op I, U or D. What was
last applied to each key is kept beside the dimension as ``(key, last_seq,
deleted)``, in the same buckets, so a batch reads the state of its own buckets
only and no watermark is needed: a change that is not newer than the last one of
its key is ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakemart.operators.compare import latest_rows
from lakemart.operators.scd2 import Dimension
from lakemart.session import materialize, scratch_scope
from lakemart.sources.runs import DimensionTable


def fit_changes(feed: DataFrame, nk: str, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Changes with a key and a sequence, and the others with their ``reason``."""
    reason = F.when(F.col(nk).isNull(), "null_key").when(F.col(seq).isNull(), "null_seq")
    marked = feed.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def latest_changes(feed: DataFrame, nk: str, op: str = "op", seq: str = "seq") -> DataFrame:
    """The last change per key, with ``_delete`` in place of the operation."""
    return latest_rows(feed, [nk], [seq, op]).withColumn("_delete", F.col(op) == "D").drop(op)


def state_schema(schema: T.StructType, nk: str, seq: str = "seq") -> T.StructType:
    return T.StructType(
        [T.StructField(nk, schema[nk].dataType), T.StructField("last_seq", schema[seq].dataType), T.StructField("deleted", T.BooleanType())]
    )


def apply_batch(
    table: DimensionTable,
    dim: Dimension,
    feed: DataFrame,
    batch_id: int,
    load_ts: str,
    seq: str = "seq",
    feed_id: str | None = None,
) -> int:
    """Apply one micro-batch; applying the same batch of the same ``feed_id`` again changes nothing.

    Changes without a key or a sequence are the rejects of the run. Deletes are
    remembered with their ``seq``, also those of keys not seen yet.
    """
    last = table.last()
    if table.applied(last, batch_id, feed_id):
        return last["run"]
    nk = dim.nk
    with scratch_scope(table.spark):
        fit, unfit = fit_changes(feed, nk, seq)
        latest = latest_changes(fit, nk, seq=seq)
        known = table.state_of(last, fit, nk, state_schema(latest.schema, nk, seq))
        newer = latest.join(known.select(nk, "last_seq"), nk, "left").where(F.col("last_seq").isNull() | (F.col(seq) > F.col("last_seq")))
        stage = materialize(newer.drop("last_seq"), "changes")
        # The whole state of the batch's buckets: what it had, and what is newer now.
        seen = stage.select(nk, F.col(seq).alias("last_seq"), F.col("_delete").alias("deleted"))
        state = known.join(seen, nk, "left_anti").unionByName(seen)
        return table.load(
            stage, dim, load_ts, close_missing=False, delete_flag="_delete", batch_id=batch_id, feed=feed_id, rejects=unfit, state=state
        )


def follow(
    feed: DataFrame,
    table: DimensionTable,
    dim: Dimension,
    checkpoint: str,
    clock: Callable[[], str],
    seq: str = "seq",
    available_now: bool = True,
) -> StreamingQuery:
    """Keep a dimension up to date from a streaming feed.

    ``clock`` gives the load timestamp of a micro-batch. ``checkpoint`` must be
    on shared storage. Batches are numbered per checkpoint, so the query id
    kept there tells feeds apart.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        query_id = table.spark.read.text(f"{checkpoint}/metadata").first()[0]
        apply_batch(table, dim, batch, batch_id, clock(), seq, query_id)

    writer = feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
