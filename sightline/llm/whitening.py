"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without ever forming it. A
block of vectors goes through a Chebyshev polynomial of the covariance, each
term one distributed pass that sums XᵀXQ of the centred rows. The polynomial is
at most one over the unwanted part of the spectrum and grows fast above it, so
the block turns towards the wanted vectors. QR and Rayleigh-Ritz follow, until
the residuals of the wanted pairs are down at rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.sums import finite, summed, usual_length
from sightline.session import cut

COMPONENTS = 16
# Vectors in the block beyond the wanted ones; more make the filter steeper.
GUARD = 16
# Highest degree of the polynomial, and how much it may favour the first vector over the last.
DEGREE = 20
MOST_SPREAD = 1e8
# Residuals of so many times the largest eigenvalue count as rounding.
ROUNDING = 2e-15
# Without progress at rounding, residuals under this share of the largest eigenvalue certify too.
CERTIFIED = 1e-11
ROUNDS = 12
# Steps of the Lanczos process that finds the lower end of the spectrum.
STEPS = 8
# Entries in one partition of the fit list.
PARTITION = 1 << 20
# Whole parts of 64 times an entry stay exact up to here.
LARGEST = float(2**46)


def shifted(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, x): the rows that take part, entries as floor(64 * c) + 1000000.

    Left out are rows whose vector is null, empty, holds null, non-finite entries
    or some of 2^46 and more in magnitude, or has another length than most.
    """
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.where(finite("v") & (F.size("v") > 0)).where(F.forall("v", lambda c: F.abs(c) < LARGEST))
    rows = rows.where(F.size("v") == usual_length(rows, "v"))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * 64) + F.lit(1_000_000)).alias("x"))


class Centred:
    """The fit list as centred rows; knows products of its covariance with a block."""

    def __init__(self, fit: DataFrame, n: int, sums: np.ndarray, parts: int | None = None):
        self.fit, self.n, self.width, self.parts = fit, n, len(sums), parts
        self.rows = partial(centred, n=n, sums=sums)

    def times(self, block: np.ndarray) -> np.ndarray:
        """Covariance times ``block``, in one pass."""
        rows, shape = self.rows, block.shape

        def part(batch: pa.RecordBatch) -> np.ndarray:
            x = rows(batch.column("x"))
            return (x.T @ (x @ block)).reshape(-1)

        return summed(self.fit, part, block.size, self.parts).reshape(shape) / self.n

    def trace(self) -> float:
        rows = self.rows
        return float(summed(self.fit, lambda batch: np.array([np.square(rows(batch.column("x"))).sum()]), 1, self.parts)[0]) / self.n

    def identity_error(self, directions: np.ndarray) -> float:
        """Largest distance of the covariance of whitened rows from the identity."""
        rows, k = self.rows, directions.shape[1]

        def part(batch: pa.RecordBatch) -> np.ndarray:
            w = rows(batch.column("x")) @ directions
            return np.concatenate([(w.T @ w).reshape(-1), w.sum(axis=0)])

        found = summed(self.fit, part, k * k + k, self.parts) / self.n
        mean = found[k * k :]
        return float(np.abs(found[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def _whole(column: pa.Array, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S as exact whole numbers, as long integers where these hold them."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(sums))
    largest = max(int(np.abs(flat).max(initial=0)), 1) * n + max(map(abs, sums))
    kind = np.int64 if largest < 2**62 else object
    return flat.astype(kind) * n - np.array(sums, kind)


def centred(column: pa.Array, n: int, sums: np.ndarray) -> np.ndarray:
    return (_whole(column, n, sums) / n).astype(np.float64)


def deviations(column: pa.Array, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n * x - S)^2, exact; null where a long cannot hold it."""
    whole = _whole(column, n, sums)
    most = int(np.abs(whole).max(initial=0))
    if most**2 * len(sums) < 2**62:
        return np.square(whole).sum(axis=1).tolist()
    exact = [sum(v * v for v in map(int, row)) for row in whole]
    return [v if v < 2**63 else None for v in exact]


def lower_end(data: Centred, rng: np.random.Generator) -> float:
    """About the smallest eigenvalue, from a few Lanczos steps; never below zero."""
    basis = [v / np.linalg.norm(v) for v in [rng.normal(size=data.width)]]
    middle, beside = [], []
    for _ in range(min(STEPS, data.width)):
        product = data.times(basis[-1][:, None])[:, 0]
        middle.append(basis[-1] @ product)
        known = np.array(basis)
        for _ in range(2):
            product = product - known.T @ (known @ product)
        beside.append(np.linalg.norm(product))
        if beside[-1] <= 1e-12 * abs(middle[0]):
            break
        basis.append(product / beside[-1])
    values, vectors = np.linalg.eigh(np.diag(middle) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1))
    return max(0.0, values[0] - beside[-1] * abs(vectors[-1, 0]))


def filtered(data: Centred, block: np.ndarray, least: float, unwanted: float, largest: float) -> np.ndarray:
    """``block`` through the Chebyshev polynomial that is small on [least, unwanted]."""
    least = min(least, 0.9 * unwanted)
    centre, half = (unwanted + least) / 2, (unwanted - least) / 2
    steep = np.arccosh(max((largest - centre) / half, 1 + 1e-9))
    degree = int(np.clip(np.log(MOST_SPREAD) / steep, 2, DEGREE))
    # The recurrence, scaled so that the largest eigenvalue stays near one.
    sigma = first = half / (largest - centre)
    before, now = block, (data.times(block) - centre * block) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (data.times(now) - centre * now) * (2 * following / half) - before * (sigma * following)
        sigma = following
    return now


def eigenpairs(data: Centred, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues and their unit vectors, as certified by their residuals.

    Where ``ROUNDS`` filters do not certify the block, the filter goes down to zero
    and the block is doubled; one as wide as the vectors gives all pairs at once.
    """
    width = data.width
    size = min(width, wanted + GUARD)
    rng = np.random.default_rng(20_260_301)
    block = np.linalg.qr(rng.normal(size=(width, size)))[0]
    least = lower_end(data, rng) if size < width else 0.0
    while True:
        best = np.inf
        for _ in range(ROUNDS):
            product = data.times(block)
            values, turn = np.linalg.eigh(block.T @ product)
            values, turn = values[::-1], turn[:, ::-1]
            block, product = block @ turn, product @ turn
            largest = max(values[0], np.finfo(float).tiny)
            residual = np.linalg.norm(product - block * values, axis=0)[:wanted].max() / largest
            if residual <= ROUNDING or (best <= CERTIFIED and residual > best / 2) or values[-1] <= 1e-14 * largest:
                return values[:wanted], block[:, :wanted] / np.linalg.norm(block[:, :wanted], axis=0)
            if size == width:
                # All pairs: turn once more on the better basis, then it is as good as it gets.
                if best < np.inf:
                    return values[:wanted], block[:, :wanted]
                best = residual
                block = np.linalg.qr(block)[0]
                continue
            best = min(best, residual)
            block = np.linalg.qr(filtered(data, block, least, values[-1], largest))[0]
        grown, least = min(width, 2 * size), 0.0
        block = np.linalg.qr(np.column_stack([block, rng.normal(size=(width, grown - size))]))[0]
        size = grown


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    Every row that takes part gets one row for each component, repeated ids and
    equal vectors included; null ids stay null. Components without variance are
    left out, so one distinct vector, or none, gives no rows. ``deviation`` is
    null where it exceeds a long. Other columns of ``vectors`` do not matter.
    """
    spark = vectors.sparkSession
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = shifted(vectors, id_column, vector_column)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, {schema}"
    fit = cut(rows.select("x").distinct())
    width = usual_length(fit, "x")
    totals = fit.agg(F.count("*"), *[F.sum(F.get("x", F.lit(i)).cast("decimal(19,0)")) for i in range(width)]).first()
    n, sums = totals[0], [int(v) for v in totals[1:] if v is not None]
    if n < 2:
        return spark.createDataFrame([], schema)
    # The passes read tables whose partitions follow the data, not the width of the shuffle.
    parts = n * width // PARTITION + 1
    data = Centred(cut(fit.repartition(parts)), n, sums, parts)
    values, found = eigenpairs(data, min(components, width))
    real = values > 1e-13 * max(values[0], 0)
    values, found = values[real], found[:, real]
    if not len(values):
        return spark.createDataFrame([], schema)
    directions = found / np.sqrt(values)
    explained, error = values / data.trace(), data.identity_error(directions)
    k = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, x = batch.num_rows, batch.column("x")
            # Products row by row, so that a row's numbers do not depend on its batch.
            projected = np.einsum("ij,jk->ik", centred(x, n, sums), directions)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n), pa.int64()),
                    pa.array(deviations(x, n, sums), pa.int64()).take(each),
                    pa.array(projected.reshape(-1), pa.float64()),
                    pa.array(np.tile(explained, m), pa.float64()),
                    pa.array(np.full(m * k, error), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
