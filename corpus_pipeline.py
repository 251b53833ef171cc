"""A corpus cleaned in five stages; each stage's result is written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import decontaminate, line_dedup, ngram_join, sentencepiece_codec, toxicity
from lakemart.llm.common import table
from lakemart.llm.queries import piece_model, toxicity_model
from lakemart.session import settled, smaller_batches

#: Rows handed to Python at a time, on both sides of it: whole documents beside heaps that the stages before have
#: filled. It never changes a result.
BATCH_ROWS = 1_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; the classifier learns outside the held-out fold."""
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier one go; a document goes if all its lines with words did. ``n_chars`` follows."""
    kept = line_dedup.dedup_lines(docs).where(~F.coalesce("all_removed", F.lit(False)))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``piece_ids`` of every document kept, beside the columns of documents.

    Smaller blocks and fewer chunks remembered than the operator's own: the
    stages before have filled the executors' heaps, so less is left for Python
    workers.
    """
    return sentencepiece_codec.encode(docs, piece_model(), block=1 << 16, remembered=200_000)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote on the way goes when its result is written."""
    docs = table(spark, sf_dir, "documents")
    with smaller_batches(spark, BATCH_ROWS):
        for name, stage in STAGES[:-1]:
            docs = settled(spark, f"pipeline-{name}", lambda: stage(spark, docs, sf_dir))  # noqa: B023 (called at once)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Toxicity scores and piece encodings have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None
