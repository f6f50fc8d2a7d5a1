"""Embedding whitening: eigenvectors of a distributed covariance, refined to double precision.

The covariance is summed over Spark partitions in whole numbers and is exact.
Its eigenvectors start in float32 and are corrected by the matrix products of
Ogita and Aishima (2018, 2019) in extended precision; eigenvalues too close to
be told apart there are solved as small problems of their own. Only sums whose
size is the square of a vector's reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
# Entries stop here; differences of two such numbers are exact in doubles.
LARGEST = 2**50
# Sums travel as three whole numbers of 40 bits each, so that none overflows.
LIMB = 40
LIMB_MASK = (1 << LIMB) - 1
MERGED_AT_ONCE = 256
CHUNK = 8_192
# A variance below this share of all is not told from none.
NO_VARIANCE = 1e-14
ROUNDS, REACHED = 20, 1e-15
SUMS = "part int, row int, limbs array<long>"


def usable_vectors(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, vector) of the rows whose vector is neither null nor empty and whose entries are all numbers."""
    entries = F.col(vector)
    number = F.forall(entries, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.where(entries.isNotNull() & (F.size(entries) > 0) & number).select(F.col(key).alias("key"), entries.alias("vector"))


def whole_numbers(column: pa.Array, size: int) -> np.ndarray:
    """floor(64 * c) of every entry, a row per vector of ``size`` entries."""
    entries = np.asarray(column.flatten()).astype(np.float64).reshape(-1, size)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * entries), -LARGEST, LARGEST).astype(np.int64)


def _carried(limbs: np.ndarray) -> np.ndarray:
    """The same sums with all but the highest limb below 2**40."""
    low, middle, high = limbs
    middle = middle + (low >> LIMB)
    return np.stack([low & LIMB_MASK, middle & LIMB_MASK, high + (middle >> LIMB)])


def _limbs_of(values: np.ndarray) -> np.ndarray:
    """Three int64 limbs of whole numbers, given as int64 or as Python's."""
    if values.dtype == object:
        parts = [values & LIMB_MASK, (values >> LIMB) & LIMB_MASK, values >> (2 * LIMB)]
        return np.stack([p.astype(np.int64) for p in parts])
    return np.stack([values & LIMB_MASK, values >> LIMB, np.zeros_like(values)])


def _numbers(limbs: list[int]) -> list[int]:
    """The whole numbers of a list of limbs: all low ones, all middle ones, all high ones."""
    third = len(limbs) // 3
    return [limbs[i] + (limbs[third + i] << LIMB) + (limbs[2 * third + i] << 2 * LIMB) for i in range(third)]


def _merged(sums: DataFrame) -> DataFrame:
    """Adds the partial sums of each row, first in 256 parts, then these; no group holds more than some hundred sums."""

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = None
        for limbs in table.column("limbs"):
            one = np.asarray(limbs.values, np.int64).reshape(3, -1)
            total = _carried(one if total is None else total + one)
        columns = [pa.array([key[1].as_py() if len(key) > 1 else 0], pa.int32()), pa.array([key[0].as_py()], pa.int32())]
        return pa.table([*columns, pa.array([total.ravel()], pa.list_(pa.int64()))], ["part", "row", "limbs"])

    in_parts = sums.withColumn("part", F.pmod("part", F.lit(MERGED_AT_ONCE)))
    first = in_parts.groupBy("row", "part").applyInArrow(add, SUMS)
    return first.groupBy("row").applyInArrow(add, SUMS).select("row", "limbs")


def _summed(vectors: DataFrame, add: Callable[[dict[int, np.ndarray], pa.Array], None]) -> DataFrame:
    """The sums (row, limbs) that ``add`` gathers per task from batches of vectors, merged."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                add(sums, batch.column(0))
        part = TaskContext.get().partitionId()
        for row, limbs in sums.items():
            columns = [pa.array([part], pa.int32()), pa.array([row], pa.int32()), pa.array([limbs.ravel()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "row", "limbs"])

    return _merged(vectors.select("vector").mapInArrow(gather, SUMS))


def _add_to(sums: dict[int, np.ndarray], row: int, limbs: np.ndarray) -> None:
    sums[row] = _carried(limbs if row not in sums else sums[row] + limbs)


def _add_vectors(sums: dict[int, np.ndarray], column: pa.Array) -> None:
    """Per length: the sum of each entry's upper and lower half, and the number of vectors."""
    sizes = np.asarray(pc.list_value_length(column))
    for size in np.unique(sizes).tolist():
        x = whole_numbers(column.filter(pa.array(sizes == size)), size)
        # in two halves, as a sum of many large entries could overflow
        high, low = (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)
        halves = np.concatenate([high, low, [len(x)]]).astype(np.int64)
        _add_to(sums, size, _limbs_of(halves))


def exact_products(y: np.ndarray) -> np.ndarray:
    """The limbs of ``y.T @ y`` for whole numbers up to 2**51 in size, by products that are exact in doubles."""
    largest = max(1, int(np.abs(y).max(initial=0)))
    if largest * largest < 1 << 52:
        total = np.zeros((3, y.shape[1], y.shape[1]), np.int64)
        rows = min(CHUNK, (1 << 53) // (largest * largest))
        for at in range(0, len(y), rows):
            part = y[at : at + rows].astype(np.float64)
            total = _carried(total + _limbs_of((part.T @ part).astype(np.int64)))
        return total
    high, low = (y >> 26).astype(np.float64), (y & ((1 << 26) - 1)).astype(np.float64)
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), 2):
        h, w = high[at : at + 2], low[at : at + 2]
        mixed = (h.T @ w).astype(np.int64).astype(object)
        total += ((h.T @ h).astype(np.int64).astype(object) << 52) + ((mixed + mixed.T) << 26) + (w.T @ w).astype(np.int64).astype(object)
    return _limbs_of(total)


def refined_eigenvectors(matrix: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of a symmetric extended-precision matrix.

    Each round takes the residuals of orthogonality R = I - X'X and of diagonality
    S = X'AX, and adds X E, where E solves both to first order. Where two
    eigenvalues lie closer than the residuals can tell, E only mends the
    orthogonality, and the block of such a cluster, shifted by its mean, is solved
    by itself and its vectors turned. It ends when the residuals are below a
    double's precision and no longer halve, or after ``rounds``; the best one counts.
    """
    x, best, least = start.astype(np.longdouble), None, np.inf
    one = np.eye(len(matrix), dtype=np.longdouble)
    for _ in range(rounds):
        r, s = one - _symmetric(x.T @ x), _symmetric(x.T @ (matrix @ x))
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        mixed, scale = s - np.diag(np.diag(s)), np.abs(values).max()
        residual = np.abs(mixed).max() + scale * np.abs(r).max()
        shrinks = residual < least / 2
        if residual < least:
            best, least = (values, x), residual
        if not shrinks and residual < REACHED * scale:
            break
        gap = values[None, :] - values[:, None]
        spread = 2 * (np.abs(mixed).sum(axis=0).max() + scale * np.abs(r).sum(axis=0).max())
        apart = np.abs(gap) > spread
        x = x + x @ np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        cuts = [0, *(np.flatnonzero(values[:-1] - values[1:] > spread) + 1).tolist(), len(values)]
        for begin, end in zip(cuts, cuts[1:]):
            if end - begin > 1:
                x[:, begin:end] = x[:, begin:end] @ _cluster_turn(matrix, x[:, begin:end])
    return best


def _symmetric(a: np.ndarray) -> np.ndarray:
    """Rounding leaves a product with its transpose a little lopsided, which a small gap would blow up."""
    return (a + a.T) / 2


def _cluster_turn(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The rotation of a cluster's vectors that makes its shifted block diagonal."""
    product = _symmetric(x.T @ x)
    block = _symmetric(x.T @ (a @ x))
    middle = np.trace(block) / np.trace(product)
    block = block - middle * product
    largest = np.abs(block).max()
    if largest == 0:
        return np.eye(len(block), dtype=np.longdouble)
    # the shift takes away what is common, so that doubles hold what is left
    turn = np.linalg.eigh((block / largest).astype(np.float64))[1].astype(np.longdouble)
    return turn @ (3 * np.eye(len(turn)) - turn.T @ turn) / 2


@dataclass(frozen=True)
class Whitening:
    """What the rows need: ``pivot`` (whole numbers near the means), ``sums`` of the entries less the pivot, and the components."""

    n: int
    pivot: np.ndarray
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def size(self) -> int:
        return len(self.pivot)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learns the whitening from all ``vectors``; None if there are none or they do not vary.

    The vectors of the most frequent length count, of the longest of these. Two
    passes: sums first, then products of the entries less whole numbers next to
    their means. Components of no variance are left out.
    """
    sums = stored(_summed(vectors, _add_vectors), "vector-sums")
    n_of = F.col("limbs")[2 * F.col("row")] + F.col("limbs")[4 * F.col("row") + 1] * (1 << LIMB)
    found = sums.orderBy(n_of.desc(), F.col("row").desc()).limit(1).collect()
    if not found:
        return None
    size, (*halves, n) = found[0].row, _numbers(found[0].limbs)
    totals = [(h << 26) + w for h, w in zip(halves[:size], halves[size:])]
    pivots = [(2 * t + n) // (2 * n) for t in totals]
    rest = [t - n * p for t, p in zip(totals, pivots)]
    pivot = np.array(pivots, np.int64)

    def add_products(sums: dict[int, np.ndarray], column: pa.Array) -> None:
        products = exact_products(whole_numbers(column, size) - pivot)
        for row in range(size):
            _add_to(sums, row, products[:, row])

    squares = {r.row: _numbers(r.limbs) for r in _summed(of_size(vectors, size), add_products).collect()}
    scatter = [[n * squares[i][j] - rest[i] * rest[j] for j in range(size)] for i in range(size)]
    covariance = np.array([[np.longdouble(v) for v in line] for line in scatter]) / np.longdouble(n * n)
    trace = np.trace(covariance)
    if not trace > 0:
        return None
    start = np.linalg.eigh((covariance / trace).astype(np.float32))[1][:, ::-1]
    values, x = refined_eigenvectors(covariance / trace, start)
    keep = int((values[:components] > NO_VARIANCE).sum())
    unit = x[:, :keep].astype(np.float64)
    variances = (values[:keep] * trace).astype(np.float64)
    scaled = unit.astype(np.longdouble) / np.sqrt(variances.astype(np.longdouble))
    error = np.abs(scaled.T @ covariance @ scaled - np.eye(keep)).max(initial=0)
    return Whitening(n, pivot, rest, unit, variances, values[:keep].astype(np.float64), float(error))


def of_size(vectors: DataFrame, size: int) -> DataFrame:
    return vectors.where(F.size("vector") == size)


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of (n * y - sum)**2 of each row, exactly; None where it exceeds a long."""
    largest = n * int(np.abs(y).max(initial=0)) + max(map(abs, sums), default=0)
    if largest * largest * y.shape[1] < 1 << 63:
        d = n * y - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = n * y.astype(object) - np.array(sums, object)
    return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(key, deviation, whitened): each vector of the model's length less the mean, along each component over its deviation."""
    kind = vectors.schema["key"].dataType.simpleString()
    n, pivot, sums, size = model.n, model.pivot, model.sums, model.size
    mean = np.array([float(np.longdouble(s) / np.longdouble(n)) for s in sums])
    unit, spread = model.components, np.sqrt(model.variances)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = whole_numbers(batch.column(1), size) - pivot
            z = (y - mean) @ unit / spread
            at = np.arange(0, z.size + 1, max(1, z.shape[1]), np.int32)[: len(z) + 1]
            columns = [batch.column(0), pa.array(deviations(y, n, sums), pa.int64()), pa.ListArray.from_arrays(at, z.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "deviation", "whitened"])

    return of_size(vectors, size).mapInArrow(project, f"key {kind}, deviation long, whitened array<double>")


def _list(values: np.ndarray) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def whitened_components(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per vector and component.

    Vectors that are null or empty, or hold a null, a NaN or an infinity, take no
    part, and of the others those of the most frequent length (the longest of
    these) alone. Rows without vec_id and repeated rows count and are returned
    like any other; further columns are ignored. Entries whose 64-fold exceeds
    2**50 count as that. There are as many components as vary, ``components`` at
    most; no rows if none does, as in an empty table. Components of one variance
    may be any that span them. A deviation beyond a long is null.

    ``identity_error`` is worked out from the exact covariance and the components
    as stored, which spares a pass over the vectors.
    """
    vectors = usable_vectors(embeddings)
    model = fit(vectors, components)
    if model is None or not len(model.variances):
        key = embeddings.schema["vec_id"].dataType.simpleString()
        columns = f"vec_id {key}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return embeddings.sparkSession.createDataFrame([], columns)
    along = whiten(vectors, model).select("key", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return along.select(
        F.col("key").alias("vec_id"),
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(_list(model.explained), F.col("place") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
