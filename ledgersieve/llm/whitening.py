"""Whiten embeddings with shifted CholeskyQR.

The fit list (every distinct quantised vector once) is stored. Each pass over it solves the centred
rows against the triangular factors found so far and adds up one Gram matrix; the Cholesky factor of
that matrix joins the factors. The first pass shifts the diagonal, which makes the factor exist for
any input; later passes bring the columns to orthogonality. The product R of all factors has the
singular values and right singular vectors of the centred rows, so an SVD of R gives the components.
What passes through the driver are d x d numbers, and no group grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ledgersieve.sources.cut import cut

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
LARGEST = float(2**52)  # scaled entries beyond this count as this
ORTHOGONAL = 1e-12
MAX_PASSES = 12
_EPS = np.finfo(np.float64).eps / 2
_LOW = 26


def quantised(vectors: pa.Array, width: int, scale: float = SCALE, offset: int = OFFSET) -> tuple[np.ndarray, np.ndarray]:
    """The rows that hold `width` finite entries, and floor(scale * entry) + offset of each."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == width)
    entries = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
    entries = entries.to_numpy(zero_copy_only=False).reshape(-1, width)  # a NULL is not a number
    whole = np.isfinite(entries).all(axis=1)
    scaled = np.floor(np.clip(entries[whole] * scale, -LARGEST, LARGEST))
    return rows[whole], scaled.astype(np.int64) + offset


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))


@dataclass(frozen=True)
class Whitening:
    """`basis` has one unit column per component. `sums` are exact. Directions without variance have eigenvalue 0."""

    n: int
    sums: tuple[int, ...]
    basis: np.ndarray
    eigenvalues: np.ndarray
    total: float
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.total if self.total else np.zeros(len(self.eigenvalues))


@dataclass(frozen=True)
class _Centre:
    """The mean as whole + part / n, so that differences are taken in whole numbers first."""

    n: int
    whole: np.ndarray
    part: np.ndarray

    @staticmethod
    def of(n: int, sums: tuple[int, ...]) -> _Centre:
        return _Centre(n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 of each row; None where it needs more than 63 bits."""
        apart = x - self.whole
        largest = float(np.abs(apart).max(initial=0)) * self.n + self.n
        if largest**2 * x.shape[1] < 2.0**62:
            return ((apart * self.n - self.part) ** 2).sum(axis=1).tolist()
        n, part = self.n, self.part.tolist()
        exact = [sum((n * a - p) ** 2 for a, p in zip(row, part)) for row in apart.tolist()]
        return [v if v < 2**63 else None for v in exact]


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _gram(fit_list: DataFrame, width: int, change: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of the outer product of `change(row)`, a vector of `size` numbers.

    Each task sends size^2 numbers, which meet by place in the matrix and combine before and in the
    shuffle; only the finished matrix reaches the driver.
    """
    upper = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            changed = change(_rows(batch["x"], width))
            total += changed.T @ changed
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], names=["place", "value"])

    sums = fit_list.select("x").mapInArrow(add, "place bigint, value double")
    sums = sums.groupBy("place").agg(F.sum("value").alias("value")).collect()  # size * (size + 1) / 2 rows
    made = np.zeros((size, size))
    for place, value in sums:
        made[upper[0][place], upper[1][place]] = value
    return made + np.triu(made, 1).T


def _sums(fit_list: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """Rows and exact sums by dimension; halves of the numbers are added apart, so that nothing overflows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(width, np.int64), np.zeros(width, np.int64), 0
        for batch in batches:
            x = _rows(batch["x"], width)
            high += (x >> _LOW).sum(axis=0)
            low += (x & ((1 << _LOW) - 1)).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(high), pa.array(low), pa.array(np.full(width, n))],
            names=["place", "high", "low", "n"])

    found = fit_list.select("x").mapInArrow(add, "place bigint, high bigint, low bigint, n bigint")
    found = found.groupBy("place").agg(F.sum("high"), F.sum("low"), F.sum("n")).orderBy("place").collect()  # one row a dimension
    if not found:
        return 0, (0,) * width
    return found[0][3], tuple((high << _LOW) + low for _, high, low, _ in found)


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows * factors[0]^-1 * factors[1]^-1 * …, each by a triangular solve."""
    for factor in factors:
        rows = np.linalg.solve(factor.T, rows.T).T
    return rows


def fit(fit_list: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Fit on stored rows `x` (arrays of `width` whole numbers), each counted once."""
    n, sums = _sums(fit_list, width)
    kept = min(components, width)
    if n == 0:
        return Whitening(0, sums, np.eye(width, kept), np.zeros(kept), 0.0, 0.0)
    centre = _Centre.of(n, sums)
    factors: list[np.ndarray] = []

    def solved(x: np.ndarray) -> np.ndarray:
        return _solved(centre.centred(x), factors)

    first = gram = _gram(fit_list, width, solved, width)
    total = float(np.trace(first)) / n
    last = np.zeros((width, width))
    if total > 0:
        share = min(0.01, 11 * (n * width + width * (width + 1)) * _EPS)
        factors.append(np.linalg.cholesky(gram + share * np.trace(gram) * np.eye(width)).T)
        for _ in range(MAX_PASSES):
            gram = _gram(fit_list, width, solved, width)
            values, vectors = np.linalg.eigh(gram)
            # A direction without variance stays at 0 in every pass; a unit pivot keeps its factor invertible.
            lost = vectors[:, values < 1e-10]
            if np.abs(gram + lost @ lost.T - np.eye(width)).max() < ORTHOGONAL:
                break
            shift = 0.0 if values[values >= 1e-10].min(initial=1) > 1e-8 else share * np.trace(gram)
            factors.append(np.linalg.cholesky(gram + lost @ lost.T + shift * np.eye(width)).T)
        # The root of the last matrix closes the product: the identity but for directions without variance.
        last = (vectors * np.sqrt(np.where(values < 1e-10, 0, values))) @ vectors.T
    r = last
    for factor in reversed(factors):
        r = r @ factor
    _, singular, right = np.linalg.svd(r)
    singular = np.where(singular > singular[0] * width * _EPS, singular, 0) if singular[0] else singular
    basis = right[:kept].T.copy()
    basis *= np.where(basis[np.abs(basis).argmax(axis=0), np.arange(kept)] < 0, -1, 1)
    model = Whitening(n, sums, basis, singular[:kept] ** 2 / n, total, 0.0)
    varied = model.eigenvalues > 0
    error = 0.0
    if varied.any():
        project = _projector(model)
        whitened = _gram(fit_list, width, lambda x: project(x)[:, varied], int(varied.sum())) / n
        error = float(np.abs(whitened - np.eye(len(whitened))).max())
    return Whitening(n, sums, basis, model.eigenvalues, total, error)


def _projector(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    centre = _Centre.of(model.n, model.sums)
    with np.errstate(divide="ignore"):
        scaled = np.where(model.eigenvalues > 0, 1 / np.sqrt(model.eigenvalues), np.nan)

    def project(x: np.ndarray) -> np.ndarray:
        return (centre.centred(x) @ model.basis) * scaled

    return project


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE, offset: int = OFFSET,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, Whitening]:
    """One row per vector: id, deviation, whitened (an array, one number per component), and the model.

    Vectors that are NULL or empty or hold a NULL or an entry that is not finite have no row. The
    model is fitted on distinct quantised vectors. Where lengths differ, the commonest length among
    these counts (of equally common ones the longest) and other vectors have no row either. A
    component without variance is NULL in `whitened`; there are no more components than dimensions.
    `deviation` is NULL where it needs more than 63 bits. A NULL id stays, rows that share an id or a
    vector each have their row. Other columns are not read. An empty table gives an empty table.
    """
    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch["vector"]).drop_null().unique().to_pylist()
            for size in sorted(lengths):
                if size and len(x := quantised(batch["vector"], size, scale, offset)[1]):
                    yield pa.RecordBatch.from_arrays([_lists(x)], names=["x"])

    own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    # Equal vectors meet in a map-side aggregate first. Stored, because every pass reads it.
    fit_list = cut(own.select("vector").mapInArrow(quantise, "x array<bigint>").distinct(), "fit-list")
    widths = fit_list.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    commonest = widths.orderBy(F.desc("n"), F.desc("width")).first()
    width = commonest["width"] if commonest else 1
    model = fit(fit_list.where(F.size("x") == width), width, components)
    schema = StructType([
        StructField(id_col, vectors.schema[id_col].dataType), StructField("deviation", LongType()),
        StructField("whitened", ArrayType(DoubleType()))])
    names = [f.name for f in schema]

    def project_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not model.n:
            return
        centre, project = _Centre.of(model.n, model.sums), _projector(model)
        size = len(model.eigenvalues)
        for batch in batches:
            rows, x = quantised(batch["vector"], width, scale, offset)
            values = pa.array(project(x).ravel(), from_pandas=True)  # not a number: NULL
            yield pa.RecordBatch.from_arrays([
                batch["id"].take(pa.array(rows)), pa.array(centre.deviation(x), pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, size), pa.int32()), values)], names=names)

    return own.mapInArrow(project_split, schema), model
