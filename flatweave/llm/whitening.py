"""Whitening of vectors by the principal components of their exact integer scatter.

Entries become integers on a fixed grid.  Each task packs the bit planes of every dimension, shifted by the
dimension's least value, across rows into 64-bit words; the number of ones in the AND of two planes, weighted by
their powers of two, adds up to the exact sum of products of two dimensions.  The sums of all tasks are
added as integers, centred as integers (n times the products less the product of the sums) and only then turned into doubles for
the eigenvectors.  The driver holds matrices of the vectors' length squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import small_batches, staged

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Values of one chunk of rows, whatever the length of a vector.
CHUNK_VALUES = 1 << 19
_FARTHEST = 2.0**61
_LIMB_BITS, _LIMBS = 40, 5
_ID, _VECTOR = "__llm_id", "__llm_vector"
_COUNT, _SUM = -2, -1  # in place of a dimension


def on_grid(values: np.ndarray) -> np.ndarray:
    """floor(64 * c) + 1000000 as 64-bit integers; what lies beyond 2^61 on either side stays there."""
    return np.clip(np.floor(SCALE * values), -_FARTHEST, _FARTHEST).astype(np.int64) + SHIFT


def bit_planes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of non-negative numbers (rows, dimensions): the planes with a one, as words of 64 rows, their dimension and their bit."""
    rows, width = numbers.shape
    padded = np.zeros((-(-rows // 64) * 64, width), np.uint64)
    padded[:rows] = numbers
    planes, dimensions, bits = [], [], []
    for bit in range(int(padded.max(initial=0)).bit_length()):
        ones = (padded >> np.uint64(bit)).astype(np.uint8) & 1
        used = np.flatnonzero(ones.any(axis=0))
        packed = np.packbits(ones[:, used], axis=0)  # 8 rows a byte
        planes.append(np.ascontiguousarray(packed.T).view(np.uint64))
        dimensions.append(used)
        bits.append(np.full(len(used), bit))
    if not planes:
        return np.zeros((0, len(padded) // 64), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((np.concatenate(bits), np.concatenate(dimensions)))
    return np.concatenate(planes)[order], np.concatenate(dimensions)[order], np.concatenate(bits)[order]


def cross_products(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums over the rows of each dimension, and of the products of each two (the upper triangle), as Python integers."""
    rows, width = numbers.shape
    planes, dimensions, bits = bit_planes(numbers)
    largest = 2 * (int(bits.max(initial=0)) + 1) + rows.bit_length()
    kind = np.int64 if largest < 62 else object  # integers of any size where 64 bits could overflow
    sums, products = np.zeros(width, kind), np.zeros((width, width), kind)
    present, starts = np.unique(dimensions, return_index=True)
    if not len(present):
        return sums.astype(object), products.astype(object)
    weights = bits.astype(kind)
    ones = np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(kind)
    sums[present] = np.add.reduceat(ones << weights, starts)
    for at, (dimension, first) in enumerate(zip(present, starts)):
        last = starts[at + 1] if at + 1 < len(starts) else len(planes)
        total = np.zeros(len(planes) - first, kind)
        for plane, weight in zip(planes[first:last], weights[first:last]):
            both = np.bitwise_count(plane & planes[first:]).sum(axis=1, dtype=np.int64).astype(kind)
            total += both << (weights[first:] + weight)
        products[dimension, present[at:]] = np.add.reduceat(total, starts[at:] - first)
    return sums.astype(object), products.astype(object)


def shifted_cross_products(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`cross_products` of any integers: planes are those of the distance to the dimension's least value."""
    rows = len(numbers)
    least = numbers.min(axis=0)
    sums, products = cross_products((numbers - least).astype(np.uint64))
    least = least.astype(object)
    products = products + np.triu(np.outer(least, sums) + np.outer(sums, least) + rows * np.outer(least, least))
    return sums + rows * least, products


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """(rows, width) of doubles; shorter vectors are followed by zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and lengths.min() == width:
        return flat.reshape(-1, width)
    made = np.zeros((len(lengths), width))
    made[np.arange(width) < lengths[:, None]] = flat
    return made


def _limbs(number: int) -> list[int]:
    parts = []
    for _ in range(_LIMBS - 1):
        parts.append(number & ((1 << _LIMB_BITS) - 1))
        number >>= _LIMB_BITS
    return [*parts, number]


def _scatter_of(width: int):
    chunk = max(64, CHUNK_VALUES // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        waiting: list[np.ndarray] = []

        def add() -> None:
            nonlocal count, sums, products
            numbers = np.concatenate(waiting)
            waiting.clear()
            for first in range(0, len(numbers), chunk):
                some = numbers[first : first + chunk]
                more, crossed = shifted_cross_products(some)
                count, sums, products = count + len(some), sums + more, products + crossed

        for batch in batches:
            if batch.num_rows:
                waiting.append(on_grid(_matrix(batch.column(0), width)))
                if sum(map(len, waiting)) >= chunk:
                    add()
        if waiting:
            add()
        if count:
            high, low = np.triu_indices(width)
            keys = [(_COUNT, 0), *((_SUM, i) for i in range(width)), *zip(high.tolist(), low.tolist())]
            values = [_limbs(int(v)) for v in [count, *sums, *products[high, low]]]
            columns = [pa.array(c, pa.int32()) for c in zip(*keys)] + [pa.array(c, pa.int64()) for c in zip(*values)]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", *(f"limb{k}" for k in range(_LIMBS))])

    return run


class Basis:
    """What the fit gives: the number of vectors, the sums of each dimension, and the components."""

    def __init__(self, count: int, sums: list[int], products: np.ndarray, most: int):
        width = len(sums)
        exact = np.array(sums, object)  # Python integers: 64 bits could overflow
        scatter = count * products - np.outer(exact, exact)
        scatter = np.triu(scatter) + np.triu(scatter, 1).T
        # A quotient of Python integers is rounded once.
        covariance = np.array([[v / (count * count) for v in row] for row in scatter.tolist()], float).reshape(width, width)
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
        largest = np.abs(vectors).argmax(axis=0)
        vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
        trace = sum(scatter[i, i] for i in range(width)) / (count * count)
        # Below this an eigenvalue is rounding; its direction has no spread to bring to one.
        spread = values > max(trace, 0) * width * np.finfo(float).eps
        self.count, self.sums, self.spread = count, sums, spread
        self.values = np.where(spread, values, 0.0)
        self.explained = self.values / trace if trace > 0 else np.zeros(len(values))
        self.projection = np.where(spread, vectors / np.sqrt(np.where(spread, values, 1.0)), 0.0)

    def apply(self, numbers: np.ndarray) -> tuple[np.ndarray, list[int] | np.ndarray]:
        """Whitened rows, and the exact squared distance of n * x from the sums."""
        base = [total // self.count for total in self.sums]
        rest = [total - self.count * low for total, low in zip(self.sums, base)]
        near = numbers - np.array(base, np.int64)
        farthest = (int(np.abs(near).max(initial=0)) + 1) * self.count
        if farthest.bit_length() * 2 + len(base).bit_length() < 62:
            centred = self.count * near - np.array(rest, np.int64)
            deviation = (centred * centred).sum(axis=1)
            return (centred / self.count) @ self.projection, deviation
        centred = self.count * near.astype(object) - np.array(rest, object)
        deviation = (centred * centred).sum(axis=1)
        return (centred / self.count).astype(float) @ self.projection, deviation.tolist()


def fit(vectors: Column | str, df: DataFrame, most: int = COMPONENTS) -> Basis | None:
    """The basis of all of ``df``'s vectors (arrays of finite doubles); none where there is nothing to fit."""
    rows = df.select(F.col(vectors).alias(_VECTOR) if isinstance(vectors, str) else vectors.alias(_VECTOR))
    width = rows.agg(F.max(F.size(_VECTOR))).first()[0]
    if not width:
        return None
    small_batches(df.sparkSession)
    limbs = [f"limb{k}" for k in range(_LIMBS)]
    parts = rows.mapInArrow(_scatter_of(width), "i int, j int, " + ", ".join(f"{name} long" for name in limbs))
    found = parts.groupBy("i", "j").agg(*(F.sum(name).alias(name) for name in limbs)).toArrow()
    columns = [found.column(name).to_pylist() for name in limbs]
    count, sums, products = 0, [0] * width, np.zeros((width, width), object)
    for i, j, *parts_of in zip(found.column("i").to_pylist(), found.column("j").to_pylist(), *columns):
        value = sum(part << (_LIMB_BITS * k) for k, part in enumerate(parts_of))
        if i == _COUNT:
            count = value
        elif i == _SUM:
            sums[j] = value
        else:
            products[i, j] = value
    return Basis(count, sums, products, most)


def _decimals(values) -> pa.Array:
    kind = pa.decimal128(38, 0)
    if isinstance(values, np.ndarray):
        return pa.array(values, pa.int64()).cast(kind)
    return pa.array([Decimal(v) if v < 10**38 else None for v in values], kind)


def _whitened_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = products = None
    for batch in batches:
        if batch.num_rows:
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            more, crossed = rows.sum(axis=0), rows.T @ rows
            sums, products = (more, crossed) if sums is None else (sums + more, products + crossed)
    if sums is not None and len(sums):
        i, j = np.indices(products.shape)
        i, j = np.append(i, np.full(len(sums), _SUM)), np.append(j, np.arange(len(sums)))
        values = np.append(products, sums)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(values)], ["i", "j", "v"])


def identity_error(rows: DataFrame, column: str, basis: Basis) -> float:
    """How far the covariance of the whitened rows themselves is from the identity, over the components with any spread."""
    parts = rows.select(column).mapInArrow(_whitened_moments, "i int, j int, v double")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    size = len(basis.values)
    mean, products = np.zeros(size), np.zeros((size, size))
    for i, j, value in found:
        if i == _SUM:
            mean[j] = value / basis.count
        else:
            products[i, j] = value / basis.count
    off = products - np.outer(mean, mean) - np.eye(size)
    return float(np.abs(off[np.ix_(basis.spread, basis.spread)]).max(initial=0.0))


def whiten(df: DataFrame, vector_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component, numbered by falling eigenvalue from 1.

    Columns: ``vector_id``, component int, n long, deviation decimal(38, 0), whitened, explained and identity_error double.

    Rows whose vector is null or holds a null, NaN or infinite entry are left out.  A null id stays null; repeated
    rows count, and come back, as often as they are there; all other columns are ignored, whatever their names.  Vectors shorter
    than the longest count as followed by zeros.  An empty table, or one of empty vectors, gives no rows.  A component without spread
    (all vectors alike, or fewer vectors than components) has whitened and explained 0 and no part in identity_error.  Ties of
    eigenvalues leave the choice of their eigenvectors to the solver.  A deviation of more than 38 digits is null.

    ``df`` is read three times; its rows must be the same each time.
    """
    spark = df.sparkSession
    rows = df.select(F.col(vector_id).alias(_ID), F.col(vector).cast("array<double>").alias(_VECTOR))
    finite = F.forall(_VECTOR, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = rows.where(F.col(_VECTOR).isNotNull() & finite)
    basis = fit(_VECTOR, rows, components)
    kind = df.schema[vector_id].dataType.simpleString()
    if basis is None:
        return spark.createDataFrame(
            [],
            f"`{vector_id}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
            "identity_error double",
        )
    width = len(basis.sums)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made, deviation = basis.apply(on_grid(_matrix(batch.column(1), width)))
                flat = pa.array(np.ascontiguousarray(made).ravel())
                offsets = pa.array(np.arange(0, made.size + 1, made.shape[1]), pa.int32())
                made = [batch.column(0), _decimals(deviation), pa.ListArray.from_arrays(offsets, flat)]
                yield pa.RecordBatch.from_arrays(made, [_ID, "deviation", "whitened"])

    schema = f"`{_ID}` {kind}, deviation decimal(38,0), whitened array<double>"
    whitened = staged(rows.mapInArrow(project, schema), "whitened")
    error = identity_error(whitened, "whitened", basis)
    explained = F.array(*(F.lit(float(v)) for v in basis.explained))
    each = whitened.select(_ID, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        F.col(_ID).alias(vector_id),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(basis.count).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
