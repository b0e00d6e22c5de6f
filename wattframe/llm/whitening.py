"""Embedding whitening by polarisation covariance, on exact integers.

Components become integers, ``floor(scale * c) + offset``. For every dimension, and for the sum of
every two dimensions, the squares of the centred values are summed exactly. As
``Var(a + b) - Var(a) - Var(b) = 2 Cov(a, b)``, differences of these sums are all covariances. They
are put together into one matrix, of which numpy finds the eigenvectors.

Values are centred on the whole number next to their mean before they are multiplied, so that the
squares stay small however many vectors there are; what is left of the mean is taken out of the sums
as integers. Nothing is rounded before the covariances become doubles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.llm.common import free_name

SCALE, OFFSET = 1024, 100_000
#: Integers that the sums of squares below hold: larger components are an error.
LARGEST = 1 << 50
_LIMB = 26
_ROWS = 1 << 10
_EXACT = T.DecimalType(38, 0)


@dataclass(frozen=True)
class Model:
    """What whitening needs: ``n`` vectors with ``sums`` by dimension, and the components by
    falling ``values`` (their variances), of which ``vectors`` has a column each."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


def usable(vector: str) -> F.Column:
    """The vector and all its components are there and finite."""
    finite = F.forall(
        vector,
        lambda c: c.isNotNull()
        & ~F.isnan(c.cast("double"))
        & (F.abs(c.cast("double")) != float("inf")),
    )
    return F.col(vector).isNotNull() & finite


def _integers(column: pa.Array, dims: int | None, scale: int, offset: int) -> np.ndarray:
    """The vectors of a batch as a matrix of integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = set(pc.list_value_length(column).to_pylist())
    if not lengths <= ({dims} if dims is not None else lengths) or len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(lengths | {dims or 0})}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(scale * flat) + offset
    if len(scaled) and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component's integer is beyond {LARGEST}")
    return scaled.astype(np.int64).reshape(len(column), -1)


def _total(values: np.ndarray) -> list[int]:
    """Exact column sums. Halves of the bits are summed apart, so no sum overflows."""
    high, low = values >> _LIMB, values & ((1 << _LIMB) - 1)
    pairs = zip(high.sum(0).tolist(), low.sum(0).tolist())
    return [(h << _LIMB) + x for h, x in pairs]


def _total_squares(values: np.ndarray) -> list[int]:
    """Exact column sums of squares, of at most ``_ROWS`` rows below 2^52."""
    high, low = values >> _LIMB, values & ((1 << _LIMB) - 1)
    out = np.einsum("rc,rc->c", low, low).tolist()
    if high.any():
        mixed = np.einsum("rc,rc->c", high, low).tolist()
        tops = np.einsum("rc,rc->c", high, high).tolist()
        out = [x + (m << _LIMB + 1) + (h << 2 * _LIMB) for x, m, h in zip(out, mixed, tops)]
    return out


def _dots(one: np.ndarray, two: np.ndarray) -> list[int]:
    """Exact products of the rows, as Python's integers where 64 bits may not hold them."""
    largest = [float(np.abs(x).max(initial=0)) for x in (one, two)]
    if largest[0] * largest[1] * one.shape[1] < 1 << 62:
        return np.einsum("rc,rc->r", one, two).tolist()
    return [sum(a * b for a, b in zip(*rows)) for rows in zip(one.tolist(), two.tolist())]


def _sums(rows: DataFrame, vector: str, scale: int, offset: int) -> tuple[int, list[int]]:
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _integers(batch.column(0), len(sums) if sums else None, scale, offset)
                some = _total(x)
                n, sums = n + len(x), [a + b for a, b in zip(sums, some)] if sums else some
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n] * len(sums), pa.int64()),
                    pa.array(range(len(sums)), pa.int32()),
                    pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)),
                ],
                names=["n", "dim", "total"],
            )

    parts = rows.select(vector).mapInArrow(add, "n long, dim int, total decimal(38,0)")
    # one row for each dimension
    found = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    by_dim = sorted((r["dim"], r["n"], int(r["total"])) for r in found.collect())
    if len({n for _, n, _ in by_dim}) > 1:
        raise ValueError("vectors of different lengths")
    return (by_dim[0][1] if by_dim else 0), [s for _, _, s in by_dim]


def _squares(
    rows: DataFrame, vector: str, centre: list[int], scale: int, offset: int
) -> dict[tuple[int, int], int]:
    """Sums of squares of centred values: of dimension i at (i, i), of the sum of dimensions i and j
    at (i, j) for i < j."""
    dims = len(centre)
    middle = np.array(centre, np.int64)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[0] * (dims - i) for i in range(dims)]
        seen = False
        for batch in batches:
            seen |= batch.num_rows > 0
            z = _integers(batch.column(0), dims, scale, offset) - middle if batch.num_rows else None
            for start in range(0, batch.num_rows, _ROWS):
                some = z[start : start + _ROWS]
                for i in range(dims):
                    both = some[:, i:] + some[:, i : i + 1]
                    both[:, 0] = some[:, i]
                    sums[i] = [a + b for a, b in zip(sums[i], _total_squares(both))]
        if seen:
            one = [i for i in range(dims) for _ in range(i, dims)]
            two = [j for i in range(dims) for j in range(i, dims)]
            flat = [Decimal(x) for row in sums for x in row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one, pa.int32()),
                    pa.array(two, pa.int32()),
                    pa.array(flat, pa.decimal128(38, 0)),
                ],
                names=["one", "two", "total"],
            )

    parts = rows.select(vector).mapInArrow(add, "one int, two int, total decimal(38,0)")
    # one row for each two dimensions
    found = parts.groupBy("one", "two").agg(F.sum("total").alias("total")).collect()
    return {(r["one"], r["two"]): int(r["total"]) for r in found}


def covariance(
    n: int, left: list[int], squares: dict[tuple[int, int], int]
) -> list[list[Fraction]]:
    """Exact covariances, divisor ``n``, from the sums of squares of values that were centred on
    whole numbers, and their plain sums ``left``."""

    def spread(i: int, j: int) -> int:
        """n^2 times the variance of dimension i, or of the sum of i and j."""
        rest = left[i] if i == j else left[i] + left[j]
        return n * squares[i, j] - rest * rest

    dims = len(left)
    out = [[Fraction(0)] * dims for _ in range(dims)]
    for i in range(dims):
        out[i][i] = Fraction(spread(i, i), n * n)
        for j in range(i + 1, dims):
            twice = spread(i, j) - spread(i, i) - spread(j, j)
            out[i][j] = out[j][i] = Fraction(twice, 2 * n * n)
    return out


def fit(
    rows: DataFrame,
    vector: str = "embedding",
    components: int = 8,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> Model:
    """The model of all usable vectors of ``rows``: at most ``components`` components.

    Two passes over the vectors. Sums for each two dimensions reach the driver, nothing that grows
    with the rows. Rows whose vector is null or has null or non-finite components are left out;
    repeated rows count as often as they occur. Vectors of different lengths and components whose
    integer is beyond 2^50 are errors. Components of no variance (as when all vectors are alike) are
    left out. Equal variances have their components in the order that numpy finds. Without usable
    vectors, or with empty ones only, there are no components.
    """
    rows = rows.filter(usable(vector))
    n, sums = _sums(rows, vector, scale, offset)
    if not n:
        return Model(0, (), 0.0, np.zeros(0), np.zeros((0, 0)))
    centre = [(2 * s + n) // (2 * n) for s in sums]
    squares = _squares(rows, vector, centre, scale, offset)
    exact = covariance(n, [s - n * c for s, c in zip(sums, centre)], squares)
    trace = float(sum(exact[i][i] for i in range(len(sums))))
    matrix = np.array([[float(x) for x in row] for row in exact])
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    least = len(sums) * np.finfo(float).eps * max(values.max(), 0.0)
    order = [k for k in order if values[k] > least]
    chosen = vectors[:, order]
    # either sign is right; the same one each time
    signs = np.sign(chosen[np.abs(chosen).argmax(0), range(len(order))])
    return Model(n, tuple(sums), trace, values[order], chosen * signs)


def whiten(
    rows: DataFrame,
    model: Model,
    vector: str = "embedding",
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """The usable rows with ``whitened`` (array of doubles, one for each component: the centred
    vector projected on it, over its standard deviation) and ``deviation`` (decimal: the sum over
    dimensions of the squares of n * x - sum, exact).

    Rows keep their other columns; those named like the new ones are replaced. Rows whose vector is
    not usable go. Without components the arrays are empty.
    """
    kept = rows.drop("whitened", "deviation").filter(usable(vector))
    n, dims = model.n, len(model.sums)
    centre = [(2 * s + n) // (2 * n) for s in model.sums] if n else []
    left = [s - n * c for s, c in zip(model.sums, centre)]
    middle, rest = np.array(centre, np.int64), np.array(left, np.int64)
    project = model.vectors / np.sqrt(model.values) if n else model.vectors
    squared, mixed = (free_name(kept.columns, c) for c in ("_squared", "_mixed"))
    own = kept.columns
    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
            T.StructField(squared, _EXACT),
            T.StructField(mixed, _EXACT),
        ]
    )

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(vector)
            if not batch.num_rows:
                continue
            z = np.zeros((batch.num_rows, 0), np.int64)
            if n:
                z = _integers(batch.column(at), dims, scale, offset) - middle
            points = (z - rest / max(n, 1)) @ project
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * points.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(points.ravel()))
            columns = [
                pa.array(list(map(Decimal, x)), pa.decimal128(38, 0))
                for x in (_dots(z, z), _dots(z, np.broadcast_to(rest, z.shape)))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists, *columns], names=[*own, "whitened", squared, mixed]
            )

    placed = kept.mapInArrow(place, schema)
    # n * x - sum is n * z - left, with z = x - centre
    whole = lambda x: F.lit(Decimal(x)).cast(_EXACT)
    deviation = (
        whole(n * n) * F.col(squared)
        - whole(2 * n) * F.col(mixed)
        + whole(sum(r * r for r in left))
    )
    return placed.withColumn("deviation", deviation.cast(_EXACT)).drop(squared, mixed)


def identity_error(whitened: DataFrame, column: str = "whitened") -> DataFrame:
    """One row, ``identity_error``: the largest absolute entry of the covariance (divisor n) of the
    whitened values minus the identity; 0 without rows or components."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            points = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            points = points.reshape(batch.num_rows, -1)
            if sums is None:
                sums, products = 0.0, 0.0
            n, sums = n + len(points), sums + points.sum(0)
            products = products + points.T @ points
        if n and len(sums):
            k = len(sums)
            one, two = np.divmod(np.arange(k * k), k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(k * k, n)),
                    pa.array(one),
                    pa.array(two),
                    pa.array(sums[one]),
                    pa.array(sums[two]),
                    pa.array(products.ravel()),
                ],
                names=["n", "one", "two", "first", "second", "both"],
            )

    schema = "n long, one long, two long, first double, second double, both double"
    parts = whitened.select(column).mapInArrow(add, schema)
    total = parts.groupBy("one", "two").agg(
        *(F.sum(c).alias(c) for c in ("n", "first", "second", "both"))
    )
    n = F.col("n")
    cov = F.col("both") / n - (F.col("first") / n) * (F.col("second") / n)
    apart = F.abs(cov - F.when(F.col("one") == F.col("two"), 1.0).otherwise(0.0))
    return total.agg(F.coalesce(F.max(apart), F.lit(0.0)).alias("identity_error"))
