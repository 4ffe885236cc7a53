"""Whitening of vectors: each projected on the principal components, at variance one.

The scatter of the centred vectors is summed exactly, in whole numbers. Its
pivoted Cholesky factor L has as many columns as the scatter has rank, and
L L' is the scatter, so rotations of L's columns that make them orthogonal
(one-sided Jacobi) leave eigenvalues in their norms and components in their
directions. The scatter itself is never rotated, which keeps small eigenvalues
to full precision.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.centroids import is_finite
from tillsight.workspace import cut_lineage

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
#: Entries beyond this magnitude (before the shift) are refused.
MOST_ENTRY = 1 << 40

_LONG = (1 << 63) - 1
_EXACT_DOUBLE = 1 << 53


def whole_vectors(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): vectors without null or non-finite entries, as floor(scale * c) + shift.

    Shorter vectors are taken to end in zeros. Fails where an entry is too large.
    """
    given = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), given.alias("given")).filter(
        F.col("given").isNotNull() & F.forall("given", is_finite)
    )
    small = F.forall("given", lambda c: F.abs(c) * scale < MOST_ENTRY)
    scaled = F.transform("given", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift))
    rows = rows.select(
        "vec_id", F.when(small, scaled).otherwise(F.raise_error(F.lit("an entry is too large to be summed exactly"))).alias("x")
    )
    width = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if width.least == width.most:
        return rows
    zeros = F.array_repeat(F.lit(shift).cast("bigint"), F.lit(width.most) - F.size("x"))
    return rows.withColumn("x", F.concat("x", zeros))


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` vectors with sums ``sums``; columns of ``components`` are unit vectors."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def centre(self) -> list[int]:
        """The whole part of the mean, taken off before anything is multiplied."""
        return [total // self.n for total in self.sums]

    @property
    def rest(self) -> np.ndarray:
        """What is left of the mean, below one."""
        return np.array([float(Fraction(total % self.n, self.n)) for total in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.centre, dtype=np.int64)).astype(np.float64) - self.rest

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over places of (n x - S)^2, exact; None where 64 bits cannot hold it."""
        y = x - np.array(self.centre, dtype=np.int64)
        left = np.array([total % self.n for total in self.sums], dtype=object)
        most = int(np.abs(y).max(initial=0)) + 1
        if (self.n * most) ** 2 * max(1, x.shape[1]) <= _LONG:
            away = y * self.n - left.astype(np.int64)
            return (away * away).sum(axis=1).tolist()
        away = y.astype(object) * self.n - left
        return [total if total <= _LONG else None for total in (away * away).sum(axis=1).tolist()]


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with L L' = ``a``, a column per rank; its rows are in the order of ``a``.

    Each step takes the largest variance that is left, until none is above
    rounding error.
    """
    size = len(a)
    left = np.diag(a).astype(float).copy()
    least = size * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    columns = []
    for _ in range(size):
        pivot = int(left.argmax())
        if not left[pivot] > least:
            break
        column = a[:, pivot].astype(float)
        for before in columns:
            column = column - before * before[pivot]
        column = column / np.sqrt(left[pivot])
        columns.append(column)
        left -= column * column
        left[pivot] = 0.0
        # rows that were pivots before have nothing left in this column
    return np.stack(columns, axis=1) if columns else np.zeros((size, 0))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``factor`` times its transpose, falling, and their unit vectors as columns.

    Pairs of columns are rotated until all are orthogonal to working precision.
    """
    columns = factor.T.copy()
    tolerance = np.finfo(float).eps * 4
    for _ in range(sweeps):
        turned = False
        for p in range(len(columns) - 1):
            for q in range(p + 1, len(columns)):
                a, b = columns[p] @ columns[p], columns[q] @ columns[q]
                slant = columns[p] @ columns[q]
                if abs(slant) <= tolerance * np.sqrt(a * b):
                    continue
                turned = True
                zeta = (b - a) / (2 * slant)
                tangent = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.sqrt(1 + zeta * zeta))
                cosine = 1 / np.sqrt(1 + tangent * tangent)
                sine = cosine * tangent
                columns[p], columns[q] = cosine * columns[p] - sine * columns[q], sine * columns[p] + cosine * columns[q]
        if not turned:
            break
    values = (columns * columns).sum(axis=1)
    order = np.argsort(-values, kind="stable")
    values, columns = values[order], columns[order]
    unit = columns / np.sqrt(values)[:, None] if len(values) else columns
    largest = np.abs(unit).argmax(axis=1) if len(values) else np.zeros(0, int)
    signs = np.sign(unit[np.arange(len(unit)), largest])
    return values, (unit * signs[:, None]).T


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch["x"].flatten().to_numpy().reshape(batch.num_rows, -1)


def _scatter(centre: list[int]):
    """Per task: sums of products of centred entries, as (place of the product, value), all exact."""

    def exact_products(y: np.ndarray) -> np.ndarray:
        most = int(np.abs(y).max(initial=0))
        rows = _EXACT_DOUBLE // max(1, most * most)
        if rows < 1:
            y = y.astype(object)
            return y.T @ y
        total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
        for at in range(0, len(y), rows):
            part = y[at : at + rows].astype(np.float64)
            total += (part.T @ part).astype(np.int64).astype(object)
        return total

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                products = exact_products(_vectors(batch) - np.array(centre, dtype=np.int64))
                total = products if total is None else total + products
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size), pa.int32()), pa.array([str(value) for value in total.ravel()])],
                names=["place", "value"],
            )

    return run


def _exact_total(parts: DataFrame, size: int) -> list[int]:
    sums = parts.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    total = [0] * size
    for row in sums:
        total[row.place] = int(row.value)
    return total


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From distinct whole vectors (x) of one width; None without any.

    What the driver holds is the scatter, whose size is the square of the
    vectors' width and does not grow with their number.
    """
    # The sums of all entries, and of ones at the place behind them: the number of vectors.
    with_one = F.posexplode(F.concat("x", F.array(F.lit(1).cast("bigint")))).alias("place", "value")
    found = fit.select(with_one).groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    if not found:
        return None
    sums = [int(row.value) for row in sorted(found, key=lambda row: row.place)]
    n, sums, width = sums[-1], sums[:-1], len(sums) - 1
    parts = fit.mapInArrow(_scatter([total // n for total in sums]), "place int, value string")
    products = _exact_total(parts, width * width)
    left = [total % n for total in sums]
    covariance = np.array([
        float(Fraction(products[i * width + j] * n - left[i] * left[j], n * n)) for i in range(width) for j in range(width)
    ]).reshape(width, width)
    values, unit = one_sided_jacobi(pivoted_cholesky(covariance))
    return Whitening(n, sums, values[:components], unit[:, :components], float(np.trace(covariance)))


def _identity_error(fit: DataFrame, fitted: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                white = fitted.project(_vectors(batch))
                white = np.concatenate([white, np.ones((len(white), 1))], axis=1)
                total = white.T @ white + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["place", "value"]
            )

    size = len(fitted.eigenvalues)
    sums = fit.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    products = np.array([row.value for row in sorted(sums, key=lambda row: row.place)]).reshape(size + 1, size + 1)
    mean = products[:size, size] / fitted.n
    covariance = products[:size, :size] / fitted.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(size)).max(initial=0.0))


def _whitened(fitted: Whitening, identity_error: float):
    explained = fitted.eigenvalues / fitted.trace

    def run(batches):
        size = len(fitted.eigenvalues)
        for batch in batches:
            x = _vectors(batch)
            again = pa.array(np.repeat(np.arange(batch.num_rows), size))
            rows = batch.num_rows * size
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(again), pa.array(np.tile(np.arange(1, size + 1), batch.num_rows), pa.int32()),
                 pa.array(np.full(rows, fitted.n)), pa.array(fitted.deviations(x), pa.int64()).take(again),
                 pa.array(fitted.project(x).ravel()), pa.array(np.tile(explained, batch.num_rows)),
                 pa.array(np.full(rows, identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


_RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Vectors (vec_id, embedding) on up to ``components`` principal components, a row for each.

    Fitted on each distinct whole vector once; a vector on a third of all rows
    counts once and is combined before the shuffle. Vectors that are null or
    hold a null or non-finite entry are left out. Shorter vectors are taken to
    end in zeros. Rows without an id and repeated rows are whitened like any
    other. Components without variance cannot be whitened and are left out, so
    a table whose vectors are all equal, or an empty one, gives no rows. Each
    component's largest entry is positive.

    ``whitened`` is the projection over the root of the eigenvalue,
    ``explained`` the eigenvalue's part of the trace, ``deviation`` the
    vector's squared distance from the mean times n^2, exact, null where 64
    bits cannot hold it, and ``identity_error`` how far the whitened vectors'
    covariance is from the identity.
    """
    rows = whole_vectors(vectors)
    fit = cut_lineage(rows.select("x").distinct(), "distinct-vectors")
    fitted = fit_whitening(fit, components)
    if fitted is None or not len(fitted.eigenvalues):
        return vectors.sparkSession.createDataFrame([], _RESULT)
    return rows.mapInArrow(_whitened(fitted, _identity_error(fit, fitted)), _RESULT)
