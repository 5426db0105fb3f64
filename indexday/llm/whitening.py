"""Whitening of vectors: distributed covariance, leading eigenvectors by bisection and inverse iteration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexday.llm.common import prepared

EPS = np.finfo(np.float64).eps
CLUSTER = 1e-3  # eigenvalues nearer than this part of the norm have their vectors reorthogonalised
REFINEMENTS = 4
LONGEST = 2**63 - 1


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of Q' A Q for a symmetric A, by Householder reflections.

    Reflector k is a unit vector over the coordinates after k, or empty where the column is already clear.
    """
    a, n, reflectors = np.array(matrix, np.float64), len(matrix), []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        v = x.copy()
        length = np.linalg.norm(x)
        if length == 0 or not np.any(x[1:]):
            reflectors.append(np.zeros(0))
            continue
        v[0] += np.copysign(length, x[0])
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        w = p - (v @ p) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(length, x[0])
        a[k + 2 :, k] = a[k, k + 2 :] = 0
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value the number of eigenvalues below it: negative terms of the Sturm sequence."""
    least = np.finfo(np.float64).tiny / EPS
    below = np.zeros(len(at), np.int64)
    q = np.ones(len(at))
    for i, d in enumerate(diagonal):
        q = d - at - (off[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues, falling, by bisection of the Sturm counts to the last bit that counts."""
    n = len(diagonal)
    radius = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low, high = float((diagonal - radius).min()), float((diagonal + radius).max())
    margin = 4 * EPS * max(abs(low), abs(high)) * n
    lows, highs = np.full(k, low - margin), np.full(k, high + margin)
    order = n - np.arange(k)  # the value with order - 1 eigenvalues below it
    while True:
        middle = (lows + highs) / 2
        open_ = (middle > lows) & (middle < highs)
        if not open_.any():
            return (lows + highs) / 2
        enough = count_below(diagonal, off, middle) >= order
        highs, lows = np.where(open_ & enough, middle, highs), np.where(open_ & ~enough, middle, lows)


def solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solve (T - shift) y = right by elimination with row exchanges; pivots are kept off zero by ``least``."""
    n = len(diagonal)
    d, u = (diagonal - shift).tolist(), [*off.tolist(), 0.0]
    v, b, lower = [0.0] * n, right.tolist(), off.tolist()
    for i in range(n - 1):
        if abs(lower[i]) > abs(d[i]):
            d[i], u[i], v[i], d[i + 1], u[i + 1], low = lower[i], d[i + 1], u[i + 1], u[i], 0.0, d[i]
            b[i], b[i + 1] = b[i + 1], b[i]
        else:
            low = lower[i]
        if abs(d[i]) < least:
            d[i] = least
        part = low / d[i]
        d[i + 1] -= part * u[i]
        u[i + 1] -= part * v[i]
        b[i + 1] -= part * b[i]
    if abs(d[-1]) < least:
        d[-1] = least
    y = [0.0] * (n + 2)
    for i in range(n - 1, -1, -1):
        y[i] = (b[i] - u[i] * y[i + 1] - v[i] * y[i + 2]) / d[i]
    return np.array(y[:n])


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, seed: int = 13) -> np.ndarray:
    """Unit eigenvectors of the falling ``values``, as columns.

    Vectors of a cluster of near eigenvalues are made orthogonal to those before them in each step; equal values are
    set apart by a few last bits, so that they do not give the same vector.
    """
    n, rng = len(diagonal), np.random.default_rng(seed)
    norm = float(np.abs(diagonal).max() + 2 * (np.abs(off).max() if len(off) else 0)) or 1.0
    out, shift, first = np.zeros((n, len(values))), np.inf, 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        shift = min(float(value), shift - 2 * EPS * norm) if j > first else float(value)
        y = rng.uniform(-1, 1, n)
        for _ in range(REFINEMENTS):
            near = out[:, first:j]
            for _ in range(2):
                y = y - near @ (near.T @ y)
            y = solve(diagonal, off, shift, y / np.linalg.norm(y), EPS * norm)
            y /= np.abs(y).max()
        for _ in range(2):
            y = y - out[:, first:j] @ (out[:, first:j].T @ y)
        out[:, j] = y / np.linalg.norm(y)
    return out


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the k greatest eigenvalues of a symmetric matrix, falling.

    The entry of greatest size of a vector is positive. Vectors are checked against the matrix.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).max()) if n else 0.0
    k = min(k, n)
    if not scale or not k:
        return np.zeros(k), np.eye(n)[:, :k]
    scaled = matrix / scale
    diagonal, off, reflectors = tridiagonal(scaled)
    values = leading_values(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(reflectors) - 1, -1, -1):
        v = reflectors[i]
        if len(v):
            vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    size = np.linalg.norm(scaled)
    astray = np.abs(scaled @ vectors - vectors * values).max()
    skew = np.abs(vectors.T @ vectors - np.eye(k)).max()
    if astray > 1e3 * n * EPS * size or skew > 1e5 * n * EPS:
        raise ArithmeticError(f"eigenvectors astray by {astray:.2e}, skew by {skew:.2e}")
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return values * scale, vectors * signs


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(size: int, change):
    """Sums of the (changed) vectors of a task: one line per dimension."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            total = total + change(_matrix(batch.column(0), size)).sum(axis=0)
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "total"])

    return scan


def _products(size: int, change, mean: np.ndarray):
    """Sums of products of the centred vectors of a task: the upper triangle, one line per row of it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        for batch in batches:
            centred = change(_matrix(batch.column(0), size)) - mean
            total += centred.T @ centred
        rows = [total[i, i:] for i in range(len(total))]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.array(rows, pa.list_(pa.float64()))], ["i", "row"])

    return scan


def _as_is(x: np.ndarray) -> np.ndarray:
    return x


def sums_of(vectors: DataFrame, size: int, change=_as_is, kind: str = "long") -> list:
    found = vectors.mapInArrow(_sums(size, change), f"at long, total {kind}").groupBy("at").agg(F.sum("total").alias("total"))
    return [r["total"] for r in sorted(found.collect(), key=lambda r: r["at"])]


def covariance(vectors: DataFrame, size: int, n: int, mean: np.ndarray, change=_as_is) -> np.ndarray:
    """Covariance (divisor n) of the changed vectors, centred on ``mean`` before they are multiplied.

    Tasks add up their own products; what is shuffled and fetched grows with the square of the dimensions, not
    with the rows.
    """
    per_task = vectors.mapInArrow(_products(size, change, mean), "i long, row array<double>")
    cells = per_task.select("i", F.posexplode("row").alias("j", "part")).groupBy("i", "j").agg(F.sum("part").alias("total"))
    out = np.zeros((len(mean), len(mean)))
    for r in cells.collect():
        out[r["i"], r["i"] + r["j"]] = out[r["i"] + r["j"], r["i"]] = r["total"] / n
    return out


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """For each row the exact sum of (n * x - sums) ** 2, or None where a long cannot hold it."""
    rough = ((x * float(n) - sums.astype(np.float64)) ** 2).sum(axis=1)
    if not len(rough) or rough.max() < LONGEST // 4:
        return ((x * n - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
    return [d if d <= LONGEST else None for d in exact]


def _project(size: int, n: int, sums: np.ndarray, weights: np.ndarray, explained: np.ndarray, identity_error: float, id: str):
    mean, k = sums / n, weights.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            rows = len(x)
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * k, n, np.int64)), pa.array(_deviations(x, n, sums), pa.int64()).take(each),
                 pa.array(((x - mean) @ weights).ravel()), pa.array(np.tile(explained, rows)),
                 pa.array(np.full(rows * k, identity_error))],
                [id, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return scan


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & finite


def whiten(
    vectors: DataFrame, id: str = "vec_id", column: str = "embedding", components: int = 16, scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    An entry c becomes the whole number x = floor(scale * c) + shift. The fit list holds each distinct x vector once: n
    of them, with sums S. V is its covariance (divisor n, centred on S / n). Component 1 has the greatest
    eigenvalue e; ``whitened`` is (x - S / n) on its unit eigenvector, over sqrt(e); ``explained`` is e / trace(V). ``deviation``
    is the exact sum over dimensions of (n * x - S) ** 2, null where a long cannot hold it. ``identity_error`` is measured: the
    greatest entry, in absolute value, of the whitened fit list's covariance minus the identity.

    The driver gets d sums and a d x d matrix (d dimensions), whatever the number of rows, and finds the
    components there: Householder reflections, bisection of Sturm counts, inverse iteration. The projection goes to the
    tasks with their code (d x components numbers). Copies are counted out before the fit by a distinct, which combines in the
    tasks first, so one vector on a third of all rows is one line per task.

    Rows with a null vector or a null or non-finite entry are left out. d is the length that most of the
    others have (of equally frequent ones the longer); vectors of other lengths are left out too, as are empty ones. Repeated rows
    and null ids are answered each. Components without variance (e within rounding of 0) cannot be whitened and give no
    rows, so there are fewer than ``components`` where the fit list has a lower rank, and none if it holds one vector or
    the table is empty. Entries of 2 ** 57 and more overflow and raise. Other columns are not read.
    """
    spark = vectors.sparkSession
    store = prepared(spark)
    own = F.col(f"`{column}`")
    x = F.transform(own, lambda c: F.floor(c.cast("double") * scale) + shift).alias("x")
    rows = vectors.filter(usable(own) & (F.size(own) > 0)).select(F.col(f"`{id}`").alias(id), x)
    kind = rows.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    nothing = spark.createDataFrame([], schema)
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if size is None:
        return nothing
    d = size["d"]
    rows = rows.filter(F.size("x") == d)
    fit = store.put("fit_list", rows.select("x").distinct())
    n = fit.count()
    sums = np.array(sums_of(fit, d), np.int64)
    mean = sums / n
    v = covariance(fit, d, n, mean)
    values, axes = leading_components(v, components)
    real = values > d * EPS * max(float(np.trace(v)), 0.0)
    values, axes = values[real], axes[:, real]
    if not len(values):
        return nothing
    weights = axes / np.sqrt(values)

    def white(x: np.ndarray) -> np.ndarray:
        return (x - mean) @ weights

    centre = np.array(sums_of(fit, d, white, "double")) / n
    error = float(np.abs(covariance(fit, d, n, centre, white) - np.eye(len(values))).max())
    explained = values / float(np.trace(v))
    return rows.mapInArrow(_project(d, n, sums, weights, explained, error, id), schema)
