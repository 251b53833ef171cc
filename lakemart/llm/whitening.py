"""Whitening of vectors with exact integer cross-products from bit-sliced planes.

Components become integers. Over the fit list (each distinct vector once) every
dimension, less its least value, is packed into bit planes: one word holds a
binary digit of 64 rows. The sum over rows of a product of two dimensions is
the sum over their planes of 2^(a+b) times the number of set bits in the AND of
the two. A plane of ones gives sums and the count in the same way. Workers add
these up; what reaches the driver is one number per pair of dimensions. There
they are centred as integers, n * sum(xy) - sum(x) * sum(y), before the first
rounding, and decomposed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import materialize, on_workers

#: Rows packed into planes at a time.
PLANE_ROWS = 16_384
#: Products are added per group of so many binary places, so that no sum on the way leaves 64 bits.
LIMB = 16
#: Eigenvalues below this share of the largest are rounding, not variance.
LEAST_SHARE = 1e-12

_OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def integer_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``vec_id, x``: floor(scale * component) + shift as longs, in doubles before the floor.

    Vectors that are null, empty, or hold a null, non-finite or unrepresentable
    component (2^62 / scale and over) are left out; null keys stay.
    """
    c = F.transform(F.col(f"`{vector}`"), lambda v: v.cast("double"))
    sound = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 2.0**62 / scale))
    rows = vectors.where(F.size(F.col(f"`{vector}`")) > 0).where(sound)
    return rows.select(F.col(f"`{key}`").alias("vec_id"), F.transform(c, lambda v: F.floor(v * scale).cast("long") + shift).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def pack_planes(y: np.ndarray, widths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes (planes, words) of non-negative (rows, dims), with the dimension and the binary place of each.

    The last plane, of dimension ``dims``, is the plane of ones.
    """
    rows, dims = y.shape
    owner = np.array([d for d, w in enumerate(widths) for _ in range(w)] + [dims])
    place = np.array([b for w in widths for b in range(w)] + [0])
    bits = np.zeros((len(owner), -(-rows // 64) * 64), np.uint8)
    bits[:-1, :rows] = ((y[:, owner[:-1]] >> place[:-1]) & 1).T
    bits[-1, :rows] = 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64), owner, place


def add_products(total: np.ndarray, planes: np.ndarray, owner: np.ndarray, place: np.ndarray) -> None:
    """Add the weighted AND-popcounts to ``total[limb, i, j]``, i <= j; a limb counts from place ``LIMB * limb``."""
    for a in range(len(owner)):
        count = np.bitwise_count(planes[a] & planes[a:]).sum(1, dtype=np.int64)
        twice = (owner[a:] == owner[a]) & (np.arange(len(count)) > 0)  # two digits of one dimension meet in either order
        weight = place[a] + place[a:]
        np.add.at(total, (weight // LIMB, owner[a], owner[a:]), count << (weight % LIMB + twice))


@dataclass(frozen=True)
class Fit:
    """Exact sums over the fit list: ``n``, ``low`` (least x), ``sums`` of x - low, ``centred`` = n^2 times the covariance."""

    n: int
    low: list[int]
    sums: list[int]
    centred: list[list[int]]

    @property
    def dims(self) -> int:
        return len(self.low)

    def covariance(self) -> np.ndarray:
        return np.array([[v / self.n**2 for v in row] for row in self.centred])

    def components(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Eigenvalues in falling order, unit eigenvectors as rows, shares of the trace; without variance: none."""
        values, vectors = np.linalg.eigh(self.covariance())
        values, vectors = values[::-1], vectors[:, ::-1].T
        kept = [i for i in range(min(most, self.dims)) if values[i] > max(values[0], 0) * LEAST_SHARE]
        vectors = vectors[kept]
        at = np.abs(vectors).argmax(1)
        vectors = vectors * np.sign(vectors[np.arange(len(kept)), at])[:, None]
        trace = sum(self.centred[i][i] for i in range(self.dims)) / self.n**2
        return values[kept], vectors, values[kept] / trace if kept else values[kept]


def fit_products(fit: DataFrame, dims: int) -> Fit:
    """Exact sums of the integer vectors ``x`` of one length, by bit planes."""
    on_workers(fit.sparkSession)
    spans = fit.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("d").collect()
    low, widths = [r["lo"] for r in spans], [(r["hi"] - r["lo"]).bit_length() for r in spans]
    limbs = 2 * max(widths, default=0) // LIMB + 1
    base = np.array(low, np.int64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((limbs, dims + 1, dims + 1), np.int64)
        for batch in batches:
            y = _matrix(batch.column(0), dims) - base
            for i in range(0, len(y), PLANE_ROWS):
                add_products(total, *pack_planes(y[i : i + PLANE_ROWS], widths))
        at = np.nonzero(total)
        columns = [*(pa.array(x.astype(np.int32)) for x in at), pa.array(total[at])]
        yield pa.RecordBatch.from_arrays(columns, ["limb", "i", "j", "s"])

    added = fit.select("x").mapInArrow(products, "limb int, i int, j int, s bigint").groupBy("limb", "i", "j").agg(F.sum("s").alias("s"))
    cross = [[0] * (dims + 1) for _ in range(dims + 1)]
    for r in added.collect():
        cross[r["i"]][r["j"]] += r["s"] << (LIMB * r["limb"])
    n, sums = cross[dims][dims], [cross[i][dims] for i in range(dims)]
    centred = [[n * cross[min(i, j)][max(i, j)] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    return Fit(n, low, sums, centred)


def _projector(fit: Fit, values: np.ndarray, vectors: np.ndarray):
    """For a matrix of x: n * x - S, exact, and the whitened components."""
    base, sums = np.array(fit.low, np.int64), np.array(fit.sums, dtype=object)
    scaled = (vectors / np.sqrt(values)[:, None]).T
    n, safe = fit.n, max(fit.sums, default=0).bit_length() < 62

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = x - base
        if safe and n * int(y.max(initial=0)) < 1 << 62:
            off = y * n - sums.astype(np.int64)
        else:
            off = y.astype(object) * n - sums
        return off, (off / n).astype(np.float64) @ scaled

    return project


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 16, scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` (and ``deviation_exact``) of every vector.

    The fit list holds each distinct integer vector once. ``deviation`` is the
    sum over dimensions of (n*x - S)^2; where that leaves 64 bits it is null and
    ``deviation_exact`` has it. Components count from 1 by falling eigenvalue,
    each with its largest entry positive. Repeated rows and repeated or null
    keys are rows of their own. Vectors of another length than most distinct
    ones (the smaller on ties) are left out, as are those that
    ``integer_vectors`` leaves out. Components without variance have no rows;
    an empty table, one vector, or only copies of one give none.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, key, vector, scale, shift)
    fit = materialize(rows.select("x").distinct(), "whiten-fit")
    length = fit.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    kind = dict(rows.dtypes)["vec_id"]
    if length is None:
        return spark.createDataFrame([], f"vec_id {kind}, {_OUT}")
    dims = length["dims"]
    fit = fit.where(F.size("x") == dims)
    found = fit_products(fit, dims)
    values, axes, explained = found.components(most)
    project, k = _projector(found, values, axes), len(values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, white = project(_matrix(batch.column(0), dims))
            first += white.sum(0)
            second += white.T @ white
        whole = np.vstack([second, first])
        i, j = (x.ravel().astype(np.int32) for x in np.indices(whole.shape))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(whole.ravel())], ["i", "j", "s"])

    whole = np.zeros((k + 1, k))
    for r in fit.select("x").mapInArrow(moments, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        whole[r["i"], r["j"]] = r["s"] / found.n
    # x is centred exactly before it is projected, so the mean here is rounding.
    error = float(np.abs(whole[:k] - np.outer(whole[k], whole[k]) - np.eye(k)).max(initial=0.0))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, white = project(_matrix(batch.column(1), dims))
            if off.dtype != object and int(np.abs(off).max(initial=0)) ** 2 * dims >= 1 << 63:
                off = off.astype(object)
            squares = pa.array([Decimal(int(v)) for v in (off * off).sum(1)], pa.decimal128(38, 0))
            ends = np.arange(len(white) + 1, dtype=np.int32) * k
            lists = pa.ListArray.from_arrays(ends, white.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), squares, lists], ["vec_id", "deviation_exact", "white"])

    scored = rows.where(F.size("x") == dims).mapInArrow(score, f"vec_id {kind}, deviation_exact decimal(38,0), white array<double>")
    each = scored.select("vec_id", "deviation_exact", F.posexplode("white").alias("place", "whitened"))
    shares = F.array(*[F.lit(float(v)) for v in explained]) if k else F.array().cast("array<double>")
    return each.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"),
        F.col("deviation_exact").try_cast("long").alias("deviation"), "whitened", shares[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"), "deviation_exact",
    )

