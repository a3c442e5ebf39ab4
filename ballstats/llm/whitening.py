"""Whitening of embeddings by polarisation of variances.

The covariance of two dimensions is half of what the variance of their sum has over their own variances.
So only sums of squares are gathered: of every dimension and of the sum of every pair of dimensions, each
value times the number of rows less the sum over the rows, which centres it in whole numbers. These sums
are exact. Their differences give all covariances, put together on the driver for ``eigh``: a matrix of
dimensions by dimensions, however many rows there are.

Squares are added in pieces of ``BITS`` bits, so that 64 bits hold them; where a table's numbers are too
large for that, Python's own are used. Sums of tasks travel as pieces of ``LIMB`` bits, which Spark adds.

Edge cases: a vector that is null or holds a null or non-finite component, or one whose whole number is
beyond 64 bits, is left out; shorter vectors count as ending in zeros; null and repeated ids are rows like
others; ``deviation`` is null where it is beyond 64 bits, ``exact_deviation`` holds it in decimals; a
component without variance has null in ``whitened``, which then takes no part in ``identity_error``; a
table without a usable row gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballstats.llm import common

SCALE, SHIFT, COMPONENTS = 1024, 100000, 8
BITS, ROWS, LIMB, LIMBS = 26, 1024, 40, 8
_LOW = (1 << BITS) - 1
_LARGEST = float(1 << 62)
# Of the largest eigenvalue; what is below it is rounding.
_NO_VARIANCE = 1e-13


def whole_numbers(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, each component being floor(scale * c) + shift."""
    scaled = lambda e: e.cast("double") * F.lit(float(scale))
    # Null where it has no whole number: filters may be moved, so each component is looked at by itself.
    whole = F.transform(F.col(vector_col), lambda e: F.when(F.abs(scaled(e)) < _LARGEST, F.floor(scaled(e)) + shift))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"))
    return rows.where(F.col("x").isNotNull() & F.forall("x", lambda e: e.isNotNull()))


def _matrix(column: pa.Array, width: int, fill: int) -> np.ndarray:
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=int)
    out = np.full((len(sizes), width), fill, np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: as 64-bit numbers if they and their pairwise sums fit, else as Python's."""
    middle = [s // n for s in sums]
    least, most = min(middle), max(middle)
    if max(abs(least), abs(most)) < 1 << 62:
        near = x - np.array(middle, np.int64) if max(abs(least), abs(most), int(np.abs(x).max(initial=0))) < 1 << 61 else None
        if near is not None and (int(np.abs(near).max(initial=0)) + 1) * n < 1 << 61:
            return near * n - np.array([s - n * m for s, m in zip(sums, middle, strict=True)], np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(values: np.ndarray) -> list[int]:
    """Exact sums of the squares in each column."""
    if values.dtype == object:
        return [int(total) for total in (values * values).sum(axis=0)]
    totals = [0] * values.shape[1]
    for start in range(0, len(values), ROWS):
        size = np.abs(values[start : start + ROWS])
        pieces = [(size >> (k * BITS)) & _LOW for k in range(3)]
        for a, x in enumerate(pieces):
            for b, y in enumerate(pieces[: a + 1]):
                part = np.einsum("rc,rc->c", x, y)
                if part.any():
                    shift = (a + b) * BITS + (a != b)
                    totals = [total + (int(p) << shift) for total, p in zip(totals, part, strict=True)]
    return totals


def pair_squares(z: np.ndarray) -> list[list[int]]:
    """Row i: sums of squares of z_i, then of z_i + z_j for each j after i."""
    return [
        squares(np.concatenate([z[:, i : i + 1], z[:, i : i + 1] + z[:, i + 1 :]], axis=1)) for i in range(z.shape[1])
    ]


def _limbs(total: int) -> list[int]:
    return [(total >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS)]


def sums_of_squares(rows: DataFrame, n: int, sums: list[int], fill: int) -> list[list[int]]:
    """:func:`pair_squares` of all rows, centred; numbers of dimensions by dimensions reach the driver."""
    width = len(sums)

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [[0] * (width - i) for i in range(width)]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                z = centred(_matrix(batch.column("x").slice(start, ROWS), width, fill), n, sums)
                for total, more in zip(totals, pair_squares(z), strict=True):
                    total[:] = [a + b for a, b in zip(total, more, strict=True)]
        for i, total in enumerate(totals):
            limbs = pa.array([_limbs(t) for t in total], pa.list_(pa.int64()))
            places = [pa.array(np.full(len(total), i), pa.int32()), pa.array(range(i, width), pa.int32())]
            yield pa.RecordBatch.from_arrays([*places, limbs], ["i", "j", "limbs"])

    parts = rows.select("x").mapInArrow(gather, "i int, j int, limbs array<long>")
    added = parts.groupBy("i", "j").agg(*[F.sum(F.col("limbs")[k].cast("decimal(20,0)")).alias(f"l{k}") for k in range(LIMBS)])
    out = [[0] * (width - i) for i in range(width)]
    for i, j, *limbs in added.toLocalIterator():
        out[i][j - i] = sum(int(limb) << (LIMB * k) for k, limb in enumerate(limbs))
    return out


def covariance(totals: list[list[int]], n: int) -> np.ndarray:
    """Covariances (divisor n) out of exact sums of squares of n times the centred values."""
    width = len(totals)
    out = np.zeros((width, width))
    for i in range(width):
        out[i, i] = float(Fraction(totals[i][0], n**3))
        for j in range(i + 1, width):
            out[i, j] = out[j, i] = float(Fraction(totals[i][j - i] - totals[i][0] - totals[j][0], 2 * n**3))
    return out


class Whitening:
    """What a table's rows are whitened with."""

    def __init__(self, n: int, sums: list[int], v: np.ndarray, components: int):
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        self.n, self.sums = n, sums
        self.values, self.vectors = values[order], vectors[:, order]
        self.trace = float(np.trace(v))
        self.real = self.values > _NO_VARIANCE * max(values.max(initial=0.0), 0.0)
        self.scale = np.where(self.real, np.sqrt(np.where(self.real, self.values, 1.0)), np.nan)

    def of(self, z: np.ndarray) -> np.ndarray:
        """Rows centred and times n, projected on the components and scaled to variance 1."""
        return (z / self.n).astype(float) @ self.vectors / self.scale


def fit(rows: DataFrame, components: int = COMPONENTS, fill: int = SHIFT) -> Whitening | None:
    """From all rows of :func:`whole_numbers`; None if there are none."""
    n, width = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n:
        return None
    placed = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n"))
    sums = [n * fill] * width
    for i, s, there in placed.collect():  # one row per dimension
        sums[i] = int(s) + (n - there) * fill
    return Whitening(n, sums, covariance(sums_of_squares(rows, n, sums, fill), n), components)


def projected(rows: DataFrame, whitening: Whitening, fill: int = SHIFT) -> DataFrame:
    """Per row ``vec_id``, its exact ``deviation`` as text, and ``w``, one number per component."""
    n, sums, width = whitening.n, whitening.sums, len(whitening.sums)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                z = centred(_matrix(part.column("x"), width, fill), n, sums)
                deviation = [str(d) for d in squares(z.T.copy())]
                w = [[None if np.isnan(e) else e for e in row] for row in whitening.of(z).tolist()]
                arrays = [part.column("vec_id"), pa.array(deviation, pa.string()), pa.array(w, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "deviation", "w"])

    return rows.mapInArrow(project, "vec_id long, deviation string, w array<double>")


def identity_error(rows: DataFrame, whitening: Whitening) -> Column:
    """Largest absolute entry of the covariance of ``w`` less the identity, gathered from the whitened rows."""
    real = np.flatnonzero(whitening.real).tolist()
    pairs = [(i, j) for i in real for j in real if i <= j]
    if not pairs:
        return F.lit(0.0)
    found = rows.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return F.lit(max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs))


def whitened(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable vector and component; see the module for the columns' meaning."""
    rows = whole_numbers(vectors, scale, shift)
    found = fit(rows, components, shift)
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None:
        return vectors.sparkSession.createDataFrame([], f"{kinds}, exact_deviation decimal(38,0)")
    done = common.stored(projected(rows, found, shift), "whitened")
    explained = F.array(*[F.lit(float(e / found.trace) if found.trace else None).cast("double") for e in found.values])
    each = done.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
    return each.select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(explained, F.col("k")).alias("explained"),
        identity_error(done, found).alias("identity_error"),
        F.col("deviation").try_cast("decimal(38,0)").alias("exact_deviation"),
    )
