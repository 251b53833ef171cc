"""Ranked lexical search by NRA: no random access, sequential reads of impact-sorted lists.

The corpus is indexed in segments of consecutive rows. A segment has a postings
list for each term of the items: which of its documents hold it, and how often.
With the corpus counts known, each posting has an impact; lists are read in
falling order of impact, all lists of an item to the same depth. A document's
score lies between what was read of it and that plus what its unread lists can
still give. Reading goes on until no other document can reach the k best,
ties included, and the scores of those are known in full.

Segments are searched in two waves: what the first finds bounds from below what
can still be among the k best of an item, so most segments of the second stop
after a few reads. Items are taken in blocks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches, materialize

#: Documents of a segment.
SEGMENT_ROWS = 4_096
#: Items searched for at once: bounds what the driver and the workers hold of the items.
ITEM_BLOCK = 1_000
#: Entries first read from each list; each further read goes so many times as deep.
FIRST_READ, DEEPER = 32, 4
#: One in so many segments is searched in the first wave; it never changes a result.
FIRST_WAVE = 16

# Lower-cases A to Z and turns every other ASCII character that is neither letter nor digit into a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

_INDEX = "segment string, n_docs bigint, n_terms bigint, terms array<int>, counts array<int>, ids binary, nulls binary, lengths binary, docs binary, tfs binary"
_FOUND = "item int, doc_id bigint, score bigint"


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Block:
    """Items of one block: their ids, the terms of all, and per item ``(term, repeats)``."""

    ids: list
    terms: dict[bytes, int]
    items: list[list[tuple[int, int]]]


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[Block]:
    """Blocks of items in order of id; rows of one id are one item, equal rows count once."""
    rows = items.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").cast("string").alias("t")).distinct().orderBy("k", "t")
    ids, bags = [], []

    def block() -> Block:
        terms: dict[bytes, int] = {}
        return Block(list(ids), terms, [[(terms.setdefault(t, len(terms)), n) for t, n in bag.items()] for bag in bags])

    for r in rows.toLocalIterator():
        if not ids or ids[-1] != r["k"]:
            if len(ids) == ITEM_BLOCK:
                yield block()
                ids, bags = [], []
            ids.append(r["k"])
            bags.append(Counter())
        bags[-1].update(terms_of((r["t"] or "").encode()))
    if ids:
        yield block()


def _raw(column: pa.Array) -> Iterator[bytes]:
    for v in column:
        buffer = v.as_buffer()
        yield b"" if buffer is None else buffer.to_pybytes()


def build_index(docs: DataFrame, key: str, text: str, terms: dict[bytes, int]) -> DataFrame:
    """Segments of the corpus with a list per term of ``terms``: documents by place in the segment, and counts."""

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, lengths = batch.column(0), np.zeros(batch.num_rows, np.int64)
        found, tfs, docs_at = [], [], []
        get = terms.get
        for i, raw in enumerate(_raw(batch.column(1))):
            words = terms_of(raw)
            lengths[i] = len(words)
            held = Counter(map(get, words))
            held.pop(None, None)
            found.append(np.fromiter(held.keys(), np.int32, len(held)))
            tfs.append(np.fromiter(held.values(), np.int32, len(held)))
            docs_at.append(np.full(len(held), i, np.int32))
        found, tfs, docs_at = (np.concatenate(x) for x in (found, tfs, docs_at))
        order = np.argsort(found, kind="stable")
        listed, counts = np.unique(found, return_counts=True)
        nulls = np.asarray(ids.is_null())
        cells = [
            f"{TaskContext.get().partitionId()}/{ids[0]}", int((lengths > 0).sum()), int(lengths.sum()),
            listed, counts.astype(np.int32), ids.fill_null(0).to_numpy().astype(np.int64).tobytes(), nulls.tobytes(), lengths.tobytes(),
            docs_at[order].astype(np.uint16).tobytes(), tfs[order].tobytes(),
        ]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], [f"c{i}" for i in range(len(cells))])

    rows = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`").cast("string"))
    return materialize(map_batches(rows, _INDEX, build, rows=SEGMENT_ROWS), "search-index")


def impacts(tf: np.ndarray, length: np.ndarray, weight: np.ndarray, n: int, total: int) -> np.ndarray:
    """What postings add to a score, in 64-bit integers."""
    m = 25 + 75 * length * n // total
    return weight * (1_000_000_000 * tf // (1_000 * tf + 8 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the k best, with their scores; ``lists``: documents and impacts, falling.

    ``least``: a score that k documents elsewhere reach, or 0. Scores of 0 do
    not count. Ties at the boundary are all returned.
    """
    lower = np.zeros(n_docs, np.int64)
    unread = np.ones((len(lists), n_docs), bool)
    ahead = np.array([imp[0] if len(imp) else 0 for _, imp in lists], np.int64)
    at, depth = 0, FIRST_READ
    while True:
        for t, (docs, imp) in enumerate(lists):
            part = docs[at:depth]
            lower[part] += imp[at:depth]
            unread[t, part] = False
            ahead[t] = imp[depth - 1] if depth < len(imp) else 0
        upper = lower + ahead @ unread
        bound = max(least, 1)
        if n_docs >= k:
            bound = max(bound, int(np.partition(lower, n_docs - k)[n_docs - k]))
        hopeful = np.flatnonzero(upper >= bound)
        if (lower[hopeful] == upper[hopeful]).all():
            return hopeful, lower[hopeful]
        at, depth = depth, depth * DEEPER


def _search(r: dict, block: Block, weights: np.ndarray, n: int, total: int, k: int, least: list[int]) -> Iterator[tuple]:
    """``(item, ids, null ids, scores)`` of one segment for every item, at most k each."""
    listed, counts = np.array(r["terms"], np.int32), np.array(r["counts"], np.int64)
    ids, nulls = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["nulls"], bool)
    lengths, docs = np.frombuffer(r["lengths"], np.int64), np.frombuffer(r["docs"], np.uint16)
    tfs = np.frombuffer(r["tfs"], np.int32).astype(np.int64)
    owner = np.repeat(np.arange(len(listed)), counts)
    imp = impacts(tfs, lengths[docs], weights[listed][owner], n, total)
    order = np.lexsort((-imp, owner))
    docs, imp = docs[order], imp[order]
    stop = np.cumsum(counts)
    where = {int(t): slice(int(b - c), int(b)) for t, b, c in zip(listed, stop, counts)}
    for i, bag in enumerate(block.items):
        lists = [(docs[where[t]], imp[where[t]] * q) for t, q in bag if t in where]
        if not lists:
            continue
        found, scores = nra(lists, len(ids), k, least[i])
        best = np.lexsort((ids[found], nulls[found], -scores))[:k]
        if len(best):
            yield i, ids[found][best], nulls[found][best], scores[best]


def rank_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = 10
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents with a score above 0 of every item.

    Keys are integers. Null and empty texts have no terms: such documents are
    not counted and such items have no rows. Rows that share a document id are
    documents of their own; null ids stand last among equal scores. Rows that
    share an item id are one item with the terms of all, equal rows counting
    once. Empty tables give an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    out = None
    for block in _blocks(items, item_key, item_text):
        ranked = _rank_block(docs, key, text, block, k)
        ids = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id bigint")
        # At most k rows for each of the items of a block.
        named = ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        out = named if out is None else out.unionByName(named)
    return out if out is not None else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")


def _rank_block(docs: DataFrame, key: str, text: str, block: Block, k: int) -> DataFrame:
    index = build_index(docs, key, text, block.terms)
    told = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    n, total = told["n"] or 0, told["total"] or 0
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p")).select("p.*")
    weights = np.zeros(len(block.terms), np.int64)
    for r in pairs.groupBy("terms").agg(F.sum("counts").alias("df")).collect():
        weights[r["terms"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1)))
    first = F.pmod(F.xxhash64("segment"), F.lit(FIRST_WAVE)) == 0

    def best(segments: DataFrame, least: list[int], label: str) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    found = list(_search(batch.slice(i, 1).to_pylist()[0], block, weights, n, total, k, least))
                    if found:
                        item = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int32)
                        ids, nulls, scores = (np.concatenate([f[c] for f in found]) for c in (1, 2, 3))
                        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=nulls), pa.array(scores)], ["item", "doc_id", "score"])

        found = segments.mapInArrow(search, _FOUND)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return materialize(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), label)

    home = best(index.where(first), [0] * len(block.items), "search-home")
    least = [0] * len(block.items)
    for r in home.where(F.col("rank") == k).select("item", "score").collect():
        least[r["item"]] = r["score"]
    rest = best(index.where(~first), least, "search-rest")
    both = home.drop("rank").unionByName(rest.drop("rank"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return both.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
