"""Exact top-k search by integer inner product over a bit-sliced index.

Vectors are quantised to integers. A segment of the index holds up to
``SEGMENT_ROWS`` vectors as bitmaps: one per attribute and binary digit, each
attribute less its least value in the segment. A query adds the bitmaps,
weighted by the digits of its own attributes, with full adders on whole
bitmaps; the sums are bitmaps again, one per digit of the score. The top rows
come from the most significant digit downwards; rows that tie at the boundary
are taken by smaller id. Query blocks meet segments through a keyed join, each
segment keeps its k best per query, and a window over those gives the result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import materialize

SEGMENT_ROWS = 65_536
#: Rows of a part of the index on average: less than a segment holds, so that few parts need a second one.
PART_ROWS = SEGMENT_ROWS * 7 // 8
QUERY_BLOCK = 64
#: Words of 64 rows times queries worked on at once: small enough for a core's cache.
_PLANE_WORDS = 8_192

_INDEX = "segment string, dims int, n int, width int, ids binary, base binary, slices binary"
_QUERIES = "dims int, block string, n int, ids binary, home string, rows binary, vectors binary"
_FOUND = "query_id bigint, home string, home_row int, vec_id bigint, score bigint"


def quantised(vectors: DataFrame, key: str, vector: str, scale: int = 64) -> DataFrame:
    """``vec_id, q``: floor(scale * x) of each component; vectors that are null or hold null or non-finite ones go."""
    x = F.transform(F.col(f"`{vector}`"), lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col(f"`{vector}`").isNotNull() & F.col(f"`{key}`").isNotNull()).where(sound)
    return rows.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("q")
    )


def _slices(values: np.ndarray, width: int) -> np.ndarray:
    """(dims, width, words) bitmaps of (rows, dims) non-negative integers."""
    rows, dims = values.shape
    words = -(-rows // 64)
    out = np.zeros((dims, width, words), np.uint64)
    bits = np.zeros((dims, words * 64), np.uint8)
    for b in range(width):
        bits[:, :rows] = ((values >> b) & 1).T
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    return out


def runs_of(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches cut where the column's value changes; empty ones go."""
    for batch in batches:
        values = batch.column(column).to_numpy()
        cuts = [*np.flatnonzero(np.diff(values, prepend=~values[:1])).tolist(), batch.num_rows]
        for at, to in zip(cuts, cuts[1:]):
            yield batch.slice(at, to - at)


def build_index(rows: DataFrame) -> DataFrame:
    """Segments of ``(vec_id, q)``, each in order of id; vectors of another length are in segments of their own.

    How many there are follows from the count of rows, not from partitions: a
    row's part is a hash of id and vector, and a segment ends with its part or
    when it is full. Rows equal in both lie in one part, of any number of segments.
    """
    parts = max(1, -(-rows.count() // PART_ROWS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[int, list] = defaultdict(lambda: [[], []])

        def flush(dims: int) -> pa.RecordBatch:
            nonlocal made
            ids, vectors = (np.concatenate(x) for x in held.pop(dims))
            vectors = vectors.reshape(len(ids), dims)
            base = vectors.min(0) if dims else np.zeros(0, np.int64)
            width = int((vectors - base).max()).bit_length() if dims else 0
            slices = _slices(vectors - base, width)
            made += 1
            row = [f"{task}-{made}", dims, len(ids), width, ids.tobytes(), base.tobytes(), slices.tobytes()]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = ["segment", "dims", "n", "width", "ids", "base", "slices"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        part = -1
        for batch in runs_of(batches, 2):
            if part != (part := batch.column(2)[0].as_py()):
                yield from map(flush, list(held))
            lists = batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            ids, values = batch.column(0).to_numpy(), lists.flatten().to_numpy()
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
            for dims in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dims)
                vectors = values[(first[at][:, None] + np.arange(dims)).ravel()].reshape(len(at), dims)
                while len(at):
                    room = SEGMENT_ROWS - sum(map(len, held[dims][0]))
                    held[dims][0].append(ids[at[:room]])
                    held[dims][1].append(vectors[:room])
                    at, vectors = at[room:], vectors[room:]
                    if len(at):
                        yield flush(dims)
        yield from map(flush, list(held))

    dealt = rows.withColumn("part", F.pmod(F.xxhash64("vec_id", "q"), F.lit(parts)))
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "vec_id")
    return materialize(ordered.mapInArrow(build, _INDEX), "topk-index")


def _vectors(n: int, dims: int, width: int, base: bytes, slices: bytes, rows: np.ndarray) -> np.ndarray:
    planes = np.frombuffer(slices, np.uint64).reshape(dims, width, -1 if dims * width else 0)
    out = np.tile(np.frombuffer(base, np.int64), (len(rows), 1)).reshape(len(rows), dims)
    for b in range(width):
        bit = (planes[:, b, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
        out = out + (bit.T.astype(np.int64) << b)
    return out


def query_blocks(index: DataFrame, every: int) -> DataFrame:
    """The vectors whose id is divisible by ``every``, read out of the index, in blocks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                rows = np.flatnonzero(ids % every == 0)
                if not len(rows):
                    continue
                found = _vectors(r["n"], r["dims"], r["width"], r["base"], r["slices"], rows)
                cells = []
                for i in range(0, len(rows), QUERY_BLOCK):
                    part = rows[i : i + QUERY_BLOCK]
                    cells.append(
                        {
                            "dims": r["dims"], "block": f"{r['segment']}/{i}", "n": len(part), "ids": ids[part].tobytes(),
                            "home": r["segment"], "rows": part.astype(np.int64).tobytes(),
                            "vectors": found[i : i + QUERY_BLOCK].tobytes(),
                        }
                    )
                yield pa.RecordBatch.from_pylist(
                    cells,
                    pa.schema(
                        [
                            ("dims", pa.int32()), ("block", pa.string()), ("n", pa.int32()), ("ids", pa.binary()),
                            ("home", pa.string()), ("rows", pa.binary()), ("vectors", pa.binary()),
                        ]
                    ),
                )

    return materialize(index.mapInArrow(read, _QUERIES), "topk-queries")


def _sums(planes: np.ndarray, queries: np.ndarray, words: int) -> list[np.ndarray]:
    """Digit bitmaps of sum(|q| * y), with y complemented where q is negative, for every query and row."""
    dims, width = planes.shape[:2]
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    size, negative = np.abs(queries), np.where(queries < 0, full, np.uint64(0))
    waiting: dict[int, list[np.ndarray]] = defaultdict(list)

    def add(p: int, x: np.ndarray) -> None:
        while True:
            at = waiting[p]
            at.append(x)
            if len(at) < 3:
                return
            a, b, c = at
            t = a ^ b
            at[:] = [t ^ c]
            np.bitwise_and(t, c, out=t)
            x = a & b
            np.bitwise_or(x, t, out=x)
            p += 1

    for d in range(dims):
        top = int(size[:, d].max()).bit_length()
        masks = [np.where((size[:, d] >> c) & 1, full, np.uint64(0))[:, None] for c in range(top)]
        for b in range(width):
            digit = planes[d, b][None, :] ^ negative[:, d][:, None]
            for c, mask in enumerate(masks):
                add(b + c, digit & mask)
    sums, p = [], 0
    while p <= max(waiting, default=-1):
        at = waiting[p]
        if len(at) == 2:
            a, b = at
            sums.append(a ^ b)
            add(p + 1, a & b)
        else:
            sums.append(at[0] if at else np.zeros((len(queries), words), np.uint64))
        p += 1
    return sums


def _best(sums: list[np.ndarray], allowed: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the chosen rows and their sums, from the most significant digit downwards."""
    sure, level = np.zeros_like(allowed), allowed.copy()
    for plane in reversed(sums):
        upper = sure | (level & plane)
        many = (np.bitwise_count(upper).sum(1) > k)[:, None]
        level = level & np.where(many, plane, ~plane)
        sure = np.where(many, sure, upper)
    out = []
    for q in range(len(allowed)):
        rows = np.flatnonzero(np.unpackbits(sure[q].view(np.uint8), bitorder="little"))
        if len(rows) < k:  # rows of equal score at the boundary: smaller ids, which stand first
            tied = np.flatnonzero(np.unpackbits(level[q].view(np.uint8), bitorder="little"))
            rows = np.concatenate([rows, tied[: k - len(rows)]])
        score = np.zeros(len(rows), np.int64)
        for p, plane in enumerate(sums):
            bit = (plane[q, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
            score += bit.astype(np.int64) << p
        out.append((rows, score))
    return out


def _search(r: dict, k: int) -> Iterator[tuple[np.ndarray, int, int, np.ndarray, np.ndarray]]:
    n, dims, width = r["n"], r["dims"], r["width"]
    words = -(-n // 64)
    planes = np.frombuffer(r["slices"], np.uint64).reshape(dims, width, words)
    base, ids = np.frombuffer(r["base"], np.int64), np.frombuffer(r["ids"], np.int64)
    queries = np.frombuffer(r["q_vectors"], np.int64).reshape(r["q_n"], dims)
    q_ids, q_rows = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["q_rows"], np.int64)
    valid = np.packbits(np.arange(words * 64) < n, bitorder="little").view(np.uint64)
    step = max(1, _PLANE_WORDS // words)
    for i in range(0, len(queries), step):
        part = queries[i : i + step]
        allowed = np.tile(valid, (len(part), 1))
        if r["q_home"] == r["segment"]:
            own = q_rows[i : i + step]
            allowed[np.arange(len(part)), own // 64] &= ~(np.uint64(1) << (own % 64).astype(np.uint64))
        rest = part @ base - np.where(part < 0, -part, 0).sum(1) * ((1 << width) - 1)
        for j, (rows, score) in enumerate(_best(_sums(planes, part, words), allowed, k)):
            yield q_ids[i + j], r["q_home"], q_rows[i + j], ids[rows], score + rest[j]


def top_k(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest scores of each query, ties to the smaller id.

    Queries are the rows whose key is divisible by ``every``; candidates are
    all other rows of the same length. Repeated keys are rows of their own:
    each is a query and a candidate for the other. Exact while sums stay below
    2^62. An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    index = build_index(quantised(vectors, key, vector, scale))
    blocks = query_blocks(index, every)
    # One number per segment: narrow, one row for each 65,536 vectors.
    numbers = index.select("segment").withColumn("seg", (F.row_number().over(Window.orderBy("segment")) - 1).cast("int"))
    n_segments = index.count()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    copies = max(1, -(-2 * tasks // max(n_segments, 1)))
    left = index.join(numbers, "segment").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    asked = blocks.select(
        F.col("dims"), F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int").alias("copy"),
        F.explode(F.sequence(F.lit(0), F.lit(max(n_segments - 1, 0)))).alias("seg"),
        F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("home").alias("q_home"),
        F.col("rows").alias("q_rows"), F.col("vectors").alias("q_vectors"),
    )
    parts = max(tasks, min(n_segments * copies, 8 * tasks))
    cells = left.repartition(parts, "seg", "copy").join(asked.repartition(parts, "seg", "copy"), ["seg", "copy", "dims"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for query, home, row, ids, scores in _search(batch.slice(i, 1).to_pylist()[0], k):
                    m = len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(m, query, np.int64)), pa.array([home] * m, pa.string()),
                            pa.array(np.full(m, row, np.int32)), pa.array(ids), pa.array(scores),
                        ],
                        ["query_id", "home", "home_row", "vec_id", "score"],
                    )

    columns = ["segment", "dims", "n", "width", "ids", "base", "slices", "q_n", "q_ids", "q_home", "q_rows", "q_vectors"]
    found = cells.select(*columns).mapInArrow(search, _FOUND)
    order = Window.partitionBy("query_id", "home", "home_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
