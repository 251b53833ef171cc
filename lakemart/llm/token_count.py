"""Token counts by byte-pair merging, without making identifiers.

A document's count is its initial symbols less the merges made. Merging runs
once per distinct chunk (a word with the spaces before it) that a worker has
not met; documents then only add up. No shuffle: one pass over the scan.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches
from lakemart.llm.pieces import SPACE, chunks, vocabulary

#: Chunks that a worker remembers; past it the memory starts anew. Never changes a count.
REMEMBERED = 400_000

_known: dict[str, dict[str, int]] = {}


def merged_count(symbols: str, rank: dict[str, float], pieces: dict[str, int]) -> int:
    """Tokens of one chunk: repeatedly pop the lowest-rank adjacent pair.

    Symbols form a linked list; the heap holds (rank, left symbol, length of
    the pair). A popped pair whose symbols have grown since has another length
    and is passed over. A character outside the vocabulary counts its UTF-8
    bytes and never merges.
    """
    n = len(symbols)
    count = n
    for c in symbols:
        if c not in pieces:
            count += len(c.encode()) - 1
    heap = [(rank[p], i, 2) for i in range(n - 1) if (p := symbols[i : i + 2]) in rank]
    heapq.heapify(heap)
    size = [1] * n
    before = list(range(-1, n - 1))
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, length = pop(heap)
        if not size[i]:
            continue
        j = i + size[i]
        if j >= n or size[i] + size[j] != length:
            continue
        size[j], size[i] = 0, length
        count -= 1
        k = i + length
        if k < n:
            before[k] = i
            new = symbols[i : k + size[k]]
            if new in rank:
                push(heap, (rank[new], i, len(new)))
        h = before[i]
        if h >= 0:
            new = symbols[h:k]
            if new in rank:
                push(heap, (rank[new], h, len(new)))
    return count


def text_tokens(text: str | None, model: str) -> int:
    if not text:
        return 0
    known = _known.setdefault(model, {})
    vocab = vocabulary(model)
    total = 0
    for chunk in chunks(text):
        n = known.get(chunk)
        if n is None:
            n = merged_count(SPACE + chunk.replace(" ", SPACE), vocab.rank, vocab.pieces)
            if len(known) >= REMEMBERED:
                known.clear()
            if len(chunk) <= 64:
                known[chunk] = n
        total += n
    return total


def count_tokens(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """One row per row of ``docs``: key, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``model`` is the path of a SentencePiece byte-pair model that every
    executor can open. A null or empty text has 0 tokens; repeated keys give
    repeated rows; other columns are not read.
    """
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).cast(pa.large_binary())
        n_bytes = pa.compute.binary_length(texts)
        n_tokens = pa.array([text_tokens(str(t.as_py(), "utf-8"), model) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n_tokens], ["_key", "n_bytes", "n_tokens"])

    counted = map_batches(rows, f"_key {kind}, n_bytes bigint, n_tokens bigint", count)
    return counted.select(
        F.col("_key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
