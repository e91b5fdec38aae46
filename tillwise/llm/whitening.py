"""Whitening of embeddings by their principal components.

Entries are steps of 1/64, so sums and the scatter are whole numbers: tasks add them up exactly,
Spark adds up one figure per dimension or pair of dimensions, and the covariance is right to the
last bit however the rows were dealt out. What reaches the driver is bounded by the dimensions
squared. There a Cholesky factorisation with pivots gives a triangular factor, one-sided Jacobi
rotations make its columns orthogonal, and their squared norms are the eigenvalues, the columns
themselves, normalised, the components.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.common import group_sums, reach_package

# Steps of an entry, and what is added to the step.
STEPS = 64
OFFSET = 1_000_000
COMPONENTS = 32
# The dimensions squared are the driver's share of the work.
MOST_DIMENSIONS = 8192

# Products of whole numbers below this are added up as doubles without loss, so many at once.
_SMALL = 1 << 20
_ROWS = 4096
_MOST_STEP = float(1 << 62)


# --- whole numbers from vectors ------------------------------------------------------


def _stepped(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the complete vectors and their entries as steps, a pair for each length."""
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(lists.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    finite = np.isfinite(flat)
    complete = valid & (group_sums((~finite).astype(np.int64), sizes) == 0)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[complete]).tolist():
        at = np.flatnonzero(complete & (sizes == size))
        step = max(1, min(_ROWS, (1 << 20) // max(size, 1)))
        for first in range(0, len(at), step):
            some = at[first : first + step]
            steps = np.floor(STEPS * flat[starts[some][:, None] + np.arange(size)])
            if steps.size and np.abs(steps).max() >= _MOST_STEP:
                raise ValueError("an entry is too large to be counted in steps")
            yield some, steps.astype(np.int64)


def _exact_sums(steps: np.ndarray) -> np.ndarray:
    """Sums of the columns as Python integers."""
    low, high = steps & 0xFFFFFFFF, steps >> 32
    return high.sum(axis=0).astype(object) * (1 << 32) + low.sum(axis=0).astype(object)


def _exact_products(steps: np.ndarray) -> np.ndarray:
    """steps' steps as Python integers: as doubles where they are exact, else one by one."""
    large = (np.abs(steps) >= _SMALL).any(axis=1)
    small = steps[~large].astype(np.float64)
    total = (small.T @ small).astype(np.int64).astype(object)
    if large.any():
        rest = steps[large].astype(object)
        total = total + rest.T @ rest
    return total


def _summed(vectors: DataFrame, column: str, sums: Callable, keys: tuple[str, ...]) -> DataFrame:
    """What each task adds up, an exact number per key, summed over the tasks.

    ``sums`` gives the figures of some vectors of one length, or None where they do not count.
    A task holds one set of figures per length, which leaves it as rows when it ends.
    """
    kinds = ", ".join(f"{k} int" for k in keys)
    schema = pa.schema([("length", pa.int32()), *((k, pa.int32()) for k in keys), ("value", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        figures: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, steps in _stepped(batch.column(0)):
                length = steps.shape[1]
                own = sums(steps)
                if own is not None:
                    figures[length] = figures[length] + own if length in figures else own
        for length, values in figures.items():
            places = np.nonzero(np.triu(np.ones(values.shape))) if values.ndim == 2 else (np.arange(len(values)),)
            columns = [pa.array(p.astype(np.int32)) for p in places]
            numbers = pa.array([Decimal(int(v)) for v in values[places]], pa.decimal128(38, 0))
            lengths = pa.array(np.full(len(numbers), length, np.int32))
            yield pa.RecordBatch.from_arrays([lengths, *columns, numbers], schema=schema)

    rows = vectors.select(column).mapInArrow(run, f"length int, {kinds}, value decimal(38, 0)")
    return rows.groupBy("length", *keys).agg(F.sum("value").alias("value"))


def _counts_and_sums(steps: np.ndarray) -> np.ndarray:
    """The number of vectors, then the sums of their entries."""
    return np.concatenate([np.array([len(steps)], object), _exact_sums(steps)])


# --- the driver's share ----------------------------------------------------------------


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """A with A A' = v, by columns of falling pivots, as many as v has rank.

    With its rows in pivot order A is lower triangular.
    """
    size = len(v)
    rest, factor = np.diag(v).astype(float).copy(), np.zeros((size, size))
    least = size * np.finfo(float).eps * max(rest.max(initial=0.0), 0.0)
    done = np.zeros(size, bool)
    for k in range(size):
        pivot = int(np.argmax(np.where(done, -np.inf, rest)))
        if rest[pivot] <= least:
            return factor[:, :k]
        root = np.sqrt(rest[pivot])
        column = (v[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / root
        column[done] = 0.0
        column[pivot] = root
        factor[:, k] = column
        rest -= column**2
        done[pivot] = True
    return factor


def _tournament(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which each column meets each other one once."""
    teams = list(range(size + size % 2))
    for _ in range(len(teams) - 1):
        pairs = [(teams[i], teams[-1 - i]) for i in range(len(teams) // 2)]
        pairs = [(min(p), max(p)) for p in pairs if max(p) < size]
        yield np.array([p for p, _ in pairs], int), np.array([q for _, q in pairs], int)
        teams = [teams[0], teams[-1], *teams[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated until they are orthogonal."""
    a = factor.copy()
    enough = np.finfo(float).eps * np.sqrt(max(len(a), 1))
    for _ in range(sweeps):
        worst = 0.0
        for p, q in _tournament(a.shape[1]):
            left, right = a[:, p], a[:, q]
            alpha, beta = (left**2).sum(axis=0), (right**2).sum(axis=0)
            gamma = (left * right).sum(axis=0)
            angle = np.abs(gamma) / np.sqrt(alpha * beta)
            worst = max(worst, angle.max(initial=0.0))
            turn = angle > enough
            if not turn.any():
                continue
            zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            left, right = left[:, turn], right[:, turn]
            a[:, p[turn]], a[:, q[turn]] = c * left - s * right, s * left + c * right
        if worst <= enough:
            break
    return a


def principal_components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as columns, ``most`` at most and no
    more than the rank. The largest entry of a component is positive."""
    columns = one_sided_jacobi(pivoted_cholesky(v))
    values = (columns**2).sum(axis=0)
    order = np.argsort(-values, kind="stable")[:most]
    vectors = columns[:, order] / np.sqrt(values[order])
    if vectors.size:
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors


# --- fit and projection --------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fit: number of vectors, sums of the entries per dimension (x, whole numbers), components
    as columns, their eigenvalues and their shares of the total variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def fit(vectors: DataFrame, vector_column: str = "embedding", most: int = COMPONENTS) -> Whitening | None:
    """The fit over all complete vectors: those that are not null and hold neither null nor
    infinite nor undefined entries. Where lengths differ, the vectors of the most frequent length
    (of equally frequent ones the longest) count and the others are left out. An entry too
    large to be counted in steps of a long is an error. None without vectors."""
    reach_package(vectors.sparkSession)
    totals = _summed(vectors, vector_column, _counts_and_sums, ("i",))
    most_frequent = totals.where("i = 0").orderBy(F.desc("value"), F.desc("length")).first()
    if most_frequent is None:
        return None
    length, n = most_frequent["length"], int(most_frequent["value"])
    if length > MOST_DIMENSIONS:
        raise ValueError(f"{length} dimensions; at most {MOST_DIMENSIONS} are supported")
    rows = totals.where(F.col("length") == length).collect()
    steps = [0] * length
    for row in rows:
        if row["i"]:
            steps[row["i"] - 1] = int(row["value"])

    # Centred at whole numbers first; the rest of the mean is taken off the exact sums.
    near = np.array([s // n for s in steps], np.int64)

    def products(own: np.ndarray) -> np.ndarray | None:
        return _exact_products(own - near) if own.shape[1] == length else None

    left = [s - n * int(m) for s, m in zip(steps, near, strict=True)]
    v = np.zeros((length, length))
    for row in _summed(vectors, vector_column, products, ("i", "j")).collect():
        i, j = row["i"], row["j"]
        v[i, j] = v[j, i] = (n * int(row["value"]) - left[i] * left[j]) / (n * n)
    values, components = principal_components(v, most)
    sums = [s + n * OFFSET for s in steps]
    return Whitening(n, sums, components, values, values / np.trace(v) if len(values) else values)


def project(vectors: DataFrame, fitted: Whitening, id_column: str, vector_column: str) -> DataFrame:
    """``id``, ``deviation`` (sum of the squares of n x - S, exact) and ``whitened``, an array with a
    value per component, for every vector that the fit counts."""
    reach_package(vectors.sparkSession)
    n, length = fitted.n, len(fitted.sums)
    sums = [s - n * OFFSET for s in fitted.sums]
    weights = fitted.components / np.sqrt(fitted.eigenvalues) / n
    fits_long = np.array([abs(s) < 1 << 61 for s in sums]).all()
    largest = max((abs(s) for s in sums), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, steps in _stepped(batch.column(1)):
                if steps.shape[1] != length:
                    continue
                reach = n * int(np.abs(steps).max(initial=0)) + largest
                if fits_long and length * reach * reach < 1 << 62:
                    centred = n * steps - np.array(sums, np.int64)
                    squares = pa.array((centred**2).sum(axis=1)).cast(pa.decimal128(38, 0))
                else:
                    centred = n * steps.astype(object) - np.array(sums, object)
                    squares = pa.array([Decimal(int(r @ r)) for r in centred], pa.decimal128(38, 0))
                white = centred.astype(float) @ weights
                ends = np.arange(len(at) + 1, dtype=np.int32) * white.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))
                ids = batch.column(0).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([ids, squares, lists], ["id", "deviation", "whitened"])

    kind = vectors.schema[id_column].dataType.simpleString()
    own = vectors.select(F.col(id_column).alias("id"), vector_column)
    return own.mapInArrow(run, f"id {kind}, deviation decimal(38, 0), whitened array<double>")


def identity_error(projected: DataFrame, n: int, components: int) -> float:
    """The largest absolute entry of the covariance of the whitened values minus the identity."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((components + 1, components))
        for batch in batches:
            white = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            products[:components] += white.T @ white
            products[components] += white.sum(axis=0)
        i, j = np.indices(products.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(products.ravel())], schema=schema)

    parts = projected.select("whitened").mapInArrow(run, "i int, j int, value double")
    sums = np.zeros((components + 1, components))
    for row in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        sums[row["i"], row["j"]] = row["value"]
    mean = sums[components] / n
    return float(np.abs(sums[:components] / n - np.outer(mean, mean) - np.eye(components)).max())


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """One row per complete vector and component, numbered from 1 by falling eigenvalue.

    Columns: the id column, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``. Vectors are dropped or left out as in ``fit``; repeated rows count as often
    as they occur, rows without an id are kept. Directions without variance are no components: all
    vectors equal, a single one, or none at all give no rows. Other columns have no part in it.
    """
    fitted = fit(vectors, vector_column, most)
    kind = vectors.schema[id_column].dataType.simpleString()
    if fitted is None or not len(fitted.eigenvalues):
        figures = "whitened double, explained double, identity_error double"
        schema = f"`{id_column}` {kind}, component int, n bigint, deviation decimal(38, 0), {figures}"
        return vectors.sparkSession.createDataFrame([], schema)
    rows = project(vectors, fitted, id_column, vector_column)
    error = identity_error(rows, fitted.n, len(fitted.eigenvalues))
    shares = F.array(*(F.lit(float(e)) for e in fitted.explained))
    exploded = rows.select("id", "deviation", F.posexplode("whitened").alias("at", "white"))
    return exploded.select(
        F.col("id").alias(id_column),
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("bigint").alias("n"),
        "deviation",
        F.col("white").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
