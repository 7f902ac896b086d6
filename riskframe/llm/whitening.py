"""Whitening of vectors: distributed centred covariance, leading eigenvectors, projection with a broadcast matrix.

The covariance needs two passes: exact whole-number sums per dimension, then the products of the centred vectors, added
up per task and merged row by row. What reaches the driver is one matrix of ``dims`` x ``dims`` numbers, whatever the number of
vectors. There it is brought to tridiagonal form by Householder reflections, the leading eigenvalues are found by
bisection on Sturm counts, and their vectors by inverse iteration, orthogonalised again within clusters of close values.

Vectors count as whole numbers ``floor(scale * c) + shift``, so sums and deviations are exact.

Defined results: rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are vectors whose
length is not the most frequent one (of equally frequent ones the greatest). Null and repeated keys are kept, a row each. A component
without variance has no whitened value (null) and is left out of ``identity_error``. ``deviation`` is null where it does not fit
into 64 bits. Entries of ``2**40`` or more are an error. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import finite_vectors, saved, vectors_of

COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
ROUNDS, CLOSE = 5, 1e-3
EPS = float(np.finfo(float).eps)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and Householder vectors of a symmetric matrix; vector k acts on rows k+1 and on."""
    a, mirrors = np.array(matrix, float), []
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if not np.any(x[1:]):
            mirrors.append(None)
            continue
        v = x
        alpha = -np.copysign(length, x[0])
        v[0] -= alpha
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = 0
        a[k + 1, k] = alpha
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each of the given values."""
    least = EPS * EPS * max(1.0, float(np.max(off**2, initial=0.0)))
    q, count = np.ones(len(at)), np.zeros(len(at), int)
    for d, e in zip(diagonal.tolist(), [0.0, *(off**2).tolist()], strict=True):
        q = d - at - e / q
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` greatest eigenvalues in falling order, all bisected together."""
    reach = np.abs(np.concatenate(([0], off))) + np.abs(np.concatenate((off, [0])))
    low, high = np.full(k, np.min(diagonal - reach)), np.full(k, np.max(diagonal + reach))
    width = EPS * max(abs(low[0]), abs(high[0]))
    low, high = low - width, high + width
    below = len(diagonal) - 1 - np.arange(k)  # so many eigenvalues are smaller than the wanted one
    while True:
        middle = (low + high) / 2
        if np.all((high - low <= EPS * np.maximum(np.abs(low), np.abs(high))) | (middle == low) | (middle == high)):
            return middle
        above = sturm_counts(diagonal, off, middle) > below
        low, high = np.where(above, low, middle), np.where(above, middle, high)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) y = right by elimination with row exchanges; zero pivots become ``least``."""
    n = len(diagonal)
    d, u, b = (diagonal - shift).tolist(), [*off.tolist(), 0.0], right.tolist()
    low, second = off.tolist(), [0.0] * n
    for i in range(n - 1):
        if abs(d[i]) >= abs(low[i]):
            d[i] = d[i] if abs(d[i]) > least else least
            f = low[i] / d[i]
            d[i + 1] -= f * u[i]
            b[i + 1] -= f * b[i]
        else:
            f = d[i] / low[i]
            d[i], u[i], second[i], d[i + 1], u[i + 1] = low[i], d[i + 1], u[i + 1], u[i] - f * d[i + 1], -f * u[i + 1]
            b[i], b[i + 1] = b[i + 1], b[i] - f * b[i + 1]
    y = [0.0] * n
    for i in range(n - 1, -1, -1):
        s = b[i] - (u[i] * y[i + 1] if i + 1 < n else 0.0) - (second[i] * y[i + 2] if i + 2 < n else 0.0)
        y[i] = s / (d[i] if abs(d[i]) > least else least)
    return np.array(y)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) for the given values in falling order; close values share a cluster, in which every step is
    orthogonalised against the vectors before it."""
    norm = max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(off), initial=0.0))) or 1.0
    rng, found, start = np.random.default_rng(0), [], 0
    used = None
    for i, value in enumerate(values.tolist()):
        if i and values[i - 1] - value > CLOSE * norm:
            start = i
        shift = value if used is None or start == i else min(value, used - 2 * EPS * norm)
        used = shift
        y = rng.standard_normal(len(diagonal))
        for _ in range(ROUNDS):
            y = _solve(diagonal, off, shift, y / np.linalg.norm(y), EPS * norm)
            y /= np.max(np.abs(y))
            for _ in range(2):
                for other in found[start:i]:
                    y = y - (other @ y) * other
            y /= np.linalg.norm(y)
        found.append(y)
    return np.stack(found, axis=1)


def leading_eigen(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues of a symmetric matrix in falling order and their unit vectors (columns); the
    greatest entry of a vector is positive."""
    scale = float(np.max(np.abs(matrix), initial=0.0)) or 1.0
    diagonal, off, mirrors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(mirrors) - 1, -1, -1):
        if (v := mirrors[i]) is not None:
            vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    top = np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0)
    return values * scale, vectors * np.sign(top)


def _whole(batch: pa.RecordBatch, dims: int, scale: int, shift: int) -> np.ndarray:
    values = np.floor(vectors_of(batch, dims) * scale)
    if values.size and np.abs(values).max() >= float(1 << 40):
        raise ValueError("an entry is too large for whole numbers")
    return values.astype(np.int64) + shift


def totals(rows: DataFrame, dims: int, scale: int = SCALE, shift: int = SHIFT) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dims, np.int64)
        for batch in batches:
            whole = _whole(batch, dims, scale, shift)
            n, sums = n + len(whole), sums + whole.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.tolist()])], names=["n", "sums"])

    parts = rows.select("vector").mapInArrow(run, "n bigint, sums array<bigint>")
    each = parts.select("n", F.posexplode("sums").alias("pos", "s")).groupBy("pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    found = {r["pos"]: r for r in each.collect()}
    return found[0]["n"], np.array([found[i]["s"] for i in range(dims)], np.int64)


def covariance(rows: DataFrame, n: int, sums: np.ndarray, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    """Covariance (divisor n) of the vectors, centred before they are multiplied. Each task adds up its own products; the tasks'
    matrices are merged row by row."""
    dims = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((dims, dims))
        for batch in batches:
            centred = (n * _whole(batch, dims, scale, shift) - sums) / n
            products += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(list(products), pa.list_(pa.float64()))], names=["i", "row"])

    def merge(table: pa.Table) -> pa.Table:
        row = np.sum(np.stack(table["row"].to_numpy()), axis=0) / n
        return pa.table({"i": pa.array([table["i"][0].as_py()]), "row": pa.array([row.tolist()], pa.list_(pa.float64()))})

    parts = rows.select("vector").mapInArrow(run, "i bigint, row array<double>")
    found = {r["i"]: r["row"] for r in parts.groupBy("i").applyInArrow(merge, "i bigint, row array<double>").collect()}
    matrix = np.array([found[i] for i in range(dims)])
    return (matrix + matrix.T) / 2


def _deviations(centred: np.ndarray) -> list[int | None]:
    """Exact sums of squares; null beyond 64 bits."""
    if float(np.max(np.abs(centred), initial=0)) ** 2 * centred.shape[1] < 2.0**62:
        return (centred * centred).sum(axis=1).tolist()
    sums = [sum(v * v for v in row) for row in centred.tolist()]
    return [s if s < 1 << 63 else None for s in sums]


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """(key, n, deviation, whitened, explained, identity_error): a row per vector, with arrays over the leading components.

    ``explained`` is the share of a component's eigenvalue in the trace; ``identity_error`` is the greatest entry of the
    covariance of the whitened values less the identity, measured over all rows.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = finite_vectors(df, key, vector)
    sizes = rows.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.filter("dims > 0").orderBy(F.desc("n"), F.desc("dims")).first()
    schema = f"`{key}` {kind}, n bigint, deviation bigint, whitened array<double>"
    results = f"{schema}, explained array<double>, identity_error double"
    if most is None:
        return df.sparkSession.createDataFrame([], results)
    dims = most["dims"]
    rows = rows.filter(F.size("vector") == dims)
    n, sums = totals(rows, dims, scale, shift)
    matrix = covariance(rows, n, sums, scale, shift)
    values, vectors = leading_eigen(matrix, min(components, dims))
    trace = float(np.trace(matrix))
    real = values > dims * EPS * max(trace, 1e-300)
    weights = vectors[:, real] / np.sqrt(values[real])
    sent = df.sparkSession.sparkContext.broadcast((sums, weights, real))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, matrix, some = sent.value
        for batch in batches:
            centred = n * _whole(batch, len(own), scale, shift) - own
            white = np.full((len(centred), len(some)), None, object)
            white[:, some] = (centred / n) @ matrix
            columns = [batch.column(0), pa.array(np.full(len(centred), n)), pa.array(_deviations(centred), pa.int64()), pa.array(white.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n", "deviation", "whitened"])

    done = saved(rows.mapInArrow(project, schema), "whitened")
    error = identity_error(done, np.flatnonzero(real).tolist())
    explained = F.array(*[F.lit(float(v) / trace if r else 0.0) for v, r in zip(values, real, strict=True)])
    return done.withColumns({"explained": explained, "identity_error": F.lit(error)})


def identity_error(done: DataFrame, components: list[int]) -> float | None:
    """Greatest absolute entry of the covariance of the whitened values less the identity, centred before multiplying."""
    if not components:
        return None
    value = {i: F.col("whitened")[i] for i in components}
    means = done.agg(*[F.avg(value[i]).alias(f"m{i}") for i in components]).first()
    pairs = [(i, j) for i in components for j in components if i <= j]
    products = [F.avg((value[i] - means[f"m{i}"]) * (value[j] - means[f"m{j}"])).alias(f"p{i}_{j}") for i, j in pairs]
    found = done.agg(*products).first()
    return max(abs(found[f"p{i}_{j}"] - (i == j)) for i, j in pairs)
