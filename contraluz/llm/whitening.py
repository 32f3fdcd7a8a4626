"""Embedding whitening by shifted Cholesky QR.

Vectors become whole numbers on a lattice; each distinct lattice vector is fitted
once, whatever the number of its copies.  Passes over the centred rows form Gram
matrices, whose Cholesky factors orthogonalise the rows again through triangular
solves: the first factor is shifted, so that it exists for any condition number,
the later ones bring orthogonality to working precision.  The factors compose to
the R of a QR decomposition that is never stored; its singular values and right
singular vectors are the scales and axes of the whitening.

Tasks send sums by matrix cell, so what reaches the driver depends on the
dimension alone.  Rows are read from a stored table of the distinct vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contraluz.llm.common import ship, stored, without

SCALE = 256
#: a product with the scale at or beyond this is no whole number of 64 bits
LARGEST = float(1 << 62)
ROUNDING = 2.0 ** -53
ORTHOGONAL = 1e-12
PASSES = 6
#: variances below this share of all variance are rounding
NOISE = 1e-20


class Model(NamedTuple):
    """A fitted whitening: `axes` are unit rows, `values` their variances, falling."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def dimension(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values


def lattice(vector: Column) -> Column:
    """floor(256 c) of each entry, or null for a vector that takes no part.

    That is one that is null or empty, or has an entry that is null, not finite,
    or too large for a whole number.
    """
    scaled = F.transform(vector, lambda c: c.cast("double") * SCALE)
    usable = F.forall(scaled, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    return F.when(usable & (F.size(vector) > 0), F.transform(scaled, lambda c: F.floor(c)))


def usual_size(df: DataFrame, column: str) -> int:
    """The most frequent length of the arrays, the smaller one on a tie; 0 without rows."""
    found = (df.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("size")).count()
             .orderBy(F.desc("count"), "size").limit(1).collect())
    return found[0]["size"] if found else 0


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def totals(rows: DataFrame, dimension: int) -> tuple[int, np.ndarray]:
    """The number of vectors and their exact sums by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # halves of 64-bit numbers, so that sums of any task fit
        upper = np.zeros(dimension + 1, np.int64)
        lower = np.zeros(dimension + 1, np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dimension)
            upper[1:] += (x >> 32).sum(axis=0)
            lower[1:] += (x & 0xFFFFFFFF).sum(axis=0)
            lower[0] += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimension + 1), pa.int32()), pa.array(upper), pa.array(lower)],
            names=["cell", "upper", "lower"])

    found = rows.mapInArrow(run, "cell int, upper long, lower long").groupBy("cell").agg(
        F.sum("upper").alias("upper"), F.sum("lower").alias("lower")).collect()
    whole = {r["cell"]: (r["upper"] << 32) + r["lower"] for r in found}
    return whole.get(0, 0), np.array([whole.get(i + 1, 0) for i in range(dimension)], object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less the mean in double precision, exact before the division where 64 bits hold it."""
    if len(x) and max(n * int(np.abs(x).max()), *(abs(int(s)) for s in sums)) < 1 << 61:
        return (n * x - sums.astype(np.int64)) / n
    return x - np.array([s / n for s in sums], np.float64)


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangle, column by column."""
    out = np.empty_like(rows)
    for j in range(upper.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def gram(rows: DataFrame, dimension: int, width: int,
         prepare: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of outer products of the prepared rows, `width` wide."""
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            q = prepare(matrix(batch.column(0), dimension))
            total += q.T @ q
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0])), pa.int32()), pa.array(total[upper])],
            names=["cell", "value"])

    found = rows.mapInArrow(run, "cell int, value double").groupBy("cell").agg(
        F.sum("value").alias("value")).collect()
    out, cells = np.zeros((width, width)), np.array([r["cell"] for r in found], np.int64)
    out[upper[0][cells], upper[1][cells]] = [r["value"] for r in found]
    return np.triu(out) + np.triu(out, 1).T


def factor(g: np.ndarray, shift: float) -> np.ndarray:
    """The upper Cholesky factor, with the least tenfold of the shift that lets it exist."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, ROUNDING * float(np.trace(g)))


def fit(df: DataFrame, vector: str, components: int = 4) -> Model:
    """The whitening of the distinct lattice vectors of a column.

    Vectors that take no part (see `lattice`), and those whose length is not the
    most frequent one, are left out.  Without two different vectors there is no
    component; where fewer than `components` axes have variance, only those are
    given.
    """
    x = df.select(lattice(F.col(f"`{vector}`")).alias("x"))
    dimension = usual_size(x, "x")
    if not dimension:
        return Model(0, np.zeros(0, object), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    rows = stored(x.where(F.size("x") == dimension).distinct())
    n, sums = totals(rows, dimension)
    factors: list[np.ndarray] = []

    def orthogonalised(x: np.ndarray) -> np.ndarray:
        q = centred(x, n, sums)
        for r in factors:
            q = solved(q, r)
        return q

    g = gram(rows, dimension, dimension, orthogonalised)
    total = float(np.trace(g))
    if not total > 0:
        return Model(n, sums, np.zeros((0, dimension)), np.zeros(0), 0.0, 0.0)
    shift = 11 * (n * dimension + dimension * (dimension + 1)) * ROUNDING * total
    while len(factors) < PASSES and np.abs(g - np.eye(dimension)).max() > ORTHOGONAL:
        factors.append(factor(g, shift if not factors else 0.0))
        g = gram(rows, dimension, dimension, orthogonalised)
    # what is left of the last Gram matrix beside the identity joins the factors
    left, turn = np.linalg.eigh(g)
    r = (turn * np.sqrt(left.clip(min=0))) @ turn.T
    for one in reversed(factors):
        r = r @ one
    _, singular, axes = np.linalg.svd(r)
    values = singular ** 2 / n
    kept = min(components, int((values > NOISE * values.sum()).sum()))
    axes, found = axes[:kept], values[:kept]
    scaled = axes.T / np.sqrt(found)
    spread = gram(rows, dimension, kept, lambda x: centred(x, n, sums) @ scaled) / n
    return Model(n, sums, axes, found, float(values.sum()),
                 float(np.abs(spread - np.eye(kept)).max()))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sums over the dimensions of (n x - S)^2, exact; null beyond 64 bits."""
    if not len(x):
        return []
    top = n * int(np.abs(x).max()) + max(abs(int(s)) for s in sums)
    if x.shape[1] * top * top < 1 << 62:
        return ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - sums) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whiten(df: DataFrame, vector: str, model: Model) -> DataFrame:
    """Adds `whitened array<double>`, an entry for each component, and `deviation long`.

    Rows whose vector takes no part, or is of another length than the fitted ones,
    are dropped; repeated rows and ids, and null ids, are kept.  `deviation` is the
    exact sum of (n x - S)^2, null where 64 bits do not hold it.  Other columns stay;
    those named as added ones are replaced.
    """
    added = StructType.fromDDL("whitened array<double>, deviation long").fields
    kept = without(df, [f.name for f in added])
    schema = StructType([df.schema[c] for c in kept] + added)
    names = [f.name for f in schema.fields]
    n, sums, dimension = model.n, model.sums, model.dimension
    width = len(model.values)
    scaled = model.axes.T / np.sqrt(model.values) if width else np.zeros((dimension, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.columns[-1], dimension)
            flat = (centred(x, n, sums) @ scaled).ravel()
            ends = pa.array(np.arange(len(x) + 1) * width, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(flat)),
                 pa.array(deviations(x, n, sums), pa.int64())], names=names)

    x = df.select(*(F.col(f"`{c}`") for c in kept),
                  lattice(F.col(f"`{vector}`")).alias("__x"))
    return x.where(F.size("__x") == dimension if dimension else F.lit(False)).mapInArrow(
        run, schema)


ship(__name__)
