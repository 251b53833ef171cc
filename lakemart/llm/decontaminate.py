"""Benchmark decontamination by spaced seeds.

A mask names the positions of a window that count; the others are ignored, so
a seed survives a changed word there. The two masks are chosen such that any
13 aligned words with at most two substitutions hold a seed of one of them
(tests go through all cases). An item of 5 to 12 words is one window with one
substitution: its masks each ignore one of its words. Seeds of all documents pass a fixed-size bitmap
of the benchmark's seeds, then a join on the hash; each hit gives a document,
an item and a shift, and the overlap along that shift is verified word by
word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches, materialize, settled, small
from lakemart.llm.shingles import mix, word_hashes

#: Window in words, words of it that must be the same, and the counting positions of each mask.
WINDOW, SAME = 13, 11
#: Words from which an item shorter than the window forgives one substitution.
FORGIVING = 5
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
#: Bits of the bitmap that seeds pass first (2 MB); a full bitmap costs time, never a hit.
FILTER_BITS = 1 << 24


def _seeds(words: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    n = len(words) - mask[-1]
    if n <= 0:
        return words[:0]
    value = np.full(n, salt + 1, np.uint64)
    for p in mask:
        value = mix(value) * np.uint64(0x9E3779B97F4A7C15) + words[p : p + n]
    return mix(value)


def same_words(n: int) -> int:
    """Words of a window that must be the same, for an item of ``n`` words."""
    return SAME if n >= WINDOW else n - 1 if n >= FORGIVING else n


def masks_of(n: int) -> list[tuple[tuple[int, ...], int]]:
    """The masks of an item of ``n`` words, each with its salt: all words of a very short one, else see above."""
    if n >= WINDOW:
        return list(zip(MASKS, (0, 1)))
    if n < FORGIVING:
        return [(tuple(range(n)), 100 + WINDOW * n)]
    return [(tuple(p for p in range(n) if p != out), 100 + WINDOW * n + out) for out in range(n)]


def _masks(lengths: list[int]) -> list[tuple[tuple[int, ...], int]]:
    """The masks of the window and of the shorter items' lengths."""
    return [m for n in [WINDOW, *sorted(n for n in lengths if n < WINDOW)] for m in masks_of(n)]


def item_seeds(items: DataFrame, least: int) -> DataFrame:
    """``(seed, item, at, words)`` of every window of every item of ``least`` words or more."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        keys = batch.column(0).to_numpy()
        seed, item, at, size = [], [], [], []
        for row, words, counts in word_hashes(batch.column(1)):
            ends = np.cumsum(counts)
            for i, n in enumerate(counts.tolist()):
                if n < least:
                    continue
                own = words[ends[i] - n : ends[i]]
                for mask, salt in masks_of(n):
                    found = _seeds(own, mask, salt)
                    seed.append(found)
                    at.append(np.arange(len(found), dtype=np.int32))
                    item.append(np.full(len(found), keys[row + i]))
                    size.append(np.full(len(found), n, np.int32))
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        whole = np.concatenate(seed).view(np.int64) if seed else np.zeros(0, np.int64)
        return pa.table({"seed": whole, "item": join(item, np.int64), "at": join(at, np.int32), "words": join(size, np.int32)})

    return map_batches(items, "seed bigint, item bigint, at int, words int", run)


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Which low bits of seeds occur, as a bitmap of fixed size."""
    slot = F.pmod("seed", F.lit(FILTER_BITS))
    rows = (
        seeds.groupBy(F.floor(slot / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(seed, {FILTER_BITS}) % 64 AS INT))")).alias("bits"))
        .collect()
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in rows:
        out[r["word"]] = r["bits"]
    return out.view(np.uint64)


def seed_hits(docs: DataFrame, bits: np.ndarray, lengths: list[int]) -> DataFrame:
    """``(seed, _key, at)`` of the documents' windows that the bitmap lets through."""
    masks = _masks(lengths)

    def run(batch: pa.RecordBatch) -> pa.Table:
        keys = batch.column(0).to_numpy()
        seeds, docs_, at = [], [], []
        for row, words, counts in word_hashes(batch.column(1)):
            begin = np.cumsum(counts) - counts
            owner = np.repeat(np.arange(len(counts)), counts)
            for mask, salt in masks:
                found = _seeds(words, mask, salt)
                slot = found % np.uint64(FILTER_BITS)
                hit = np.flatnonzero((bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
                hit = hit[owner[hit] == owner[hit + mask[-1]]]
                seeds.append(found[hit])
                docs_.append(keys[row + owner[hit]])
                at.append((hit - begin[owner[hit]]).astype(np.int32))
        return pa.table({"seed": np.concatenate(seeds).view(np.int64), "_key": np.concatenate(docs_), "at": np.concatenate(at)})

    return map_batches(docs, "seed bigint, _key bigint, at int", run)


def _overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """(first word in the document, words, same) of the widest sound stretch along the shift, or None."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    width = min(WINDOW, len(item))
    if high - low < width:
        return None
    same = doc[shift + low : shift + high] == item[low:high]
    total = np.concatenate([[0], np.cumsum(same)])
    inside = total[width:] - total[:-width]
    sound = np.flatnonzero(inside >= same_words(len(item)))
    if not len(sound):
        return None
    first, last = int(sound[0]), int(sound[-1]) + width
    return shift + low + first, last - first, int(total[last] - total[first])


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", least: int = 5) -> DataFrame:
    """``key, item, doc_start, n_words, n_same``: one row per document and item that overlap.

    Words are runs without white space, A to Z lower-cased. An overlap is a
    stretch of 13 words along one shift with 11 the same (two substitutions);
    an item of 5 to 12 words must occur whole with at most one word changed, one
    of fewer words unchanged; items of fewer than ``least`` words are not searched. Null texts and keys take no part; repeated
    rows of a document or item give one row. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{text}`").alias("_text")).where("_key IS NOT NULL")
    tests = items.select(F.col(f"`{item}`").cast("long").alias("_item"), F.col(f"`{item_text}`").alias("_test")).where("_item IS NOT NULL")
    seeds = materialize(item_seeds(tests, least), "leak-seeds")
    lengths = [r[0] for r in seeds.where(F.col("words") < WINDOW).select("words").distinct().collect()]
    hits = seed_hits(rows, _bitmap(seeds), lengths)
    met = hits.join(small(seeds.select("seed", "item", F.col("at").alias("_at"))), "seed")
    found = met.groupBy("_key", "item", (F.col("at") - F.col("_at")).alias("shift")).count().drop("count")
    found = materialize(found, "leak-hits")
    near = rows.join(small(found.select("_key").distinct()), "_key", "left_semi")
    pairs = found.join(small(tests.withColumnRenamed("_item", "item")), "item").join(near, "_key")

    def verify(batch: pa.RecordBatch) -> pa.Table:
        keys, names, shifts = (batch.column(i).to_numpy() for i in range(3))
        sides = []
        for column in (3, 4):
            parts: list[np.ndarray] = []
            for _, words, counts in word_hashes(batch.column(column)):
                parts += np.split(words, np.cumsum(counts)[:-1])
            sides.append(parts)
        out = [(k, n, *o) for k, n, s, t, d in zip(keys, names, shifts, *sides) if (o := _overlap(d, t, int(s)))]
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["_key", "item", "start", "words", "same"])

    sound = map_batches(
        pairs.select("_key", "item", "shift", "_test", "_text"), "_key bigint, item bigint, start int, words int, same int", verify
    )
    best = sound.groupBy("_key", "item").agg(F.max(F.struct("same", "words", (-F.col("start")).alias("back"))).alias("b"))
    return best.select(
        F.col("_key").alias(key), F.col("item").alias(item), (-F.col("b.back")).alias("doc_start"),
        F.col("b.words").alias("n_words"), F.col("b.same").alias("n_same"),
    )


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without an overlap, all columns as they are; rows with a null key stay."""
    found = settled(docs.sparkSession, "leak-ids", lambda: leaks(docs, items, key, text).select(F.col(key).alias("_leak")).distinct())
    return docs.join(small(found), F.col(f"`{key}`") == F.col("_leak"), "left_anti")
