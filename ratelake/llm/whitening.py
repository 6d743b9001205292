"""Embedding whitening: distributed centred covariance, own symmetric eigensolver, broadcast projection.

Entries are put on an integer grid, x = floor(scale * c) + shift, so that counts, sums and deviations are exact.
Four scans of the table, each with one small result:

1. n and the sums S per dimension (exact integers);
2. the covariance V of x about S / n, divisor n: every task multiplies its centred rows and gives the upper triangle,
   which an aggregate adds up;
3. the covariance of the whitened rows, whose distance to the identity is reported;
4. the projection of each row on the components.

V is dimension x dimension and is solved on the driver whatever the number of rows: Householder reflections make it
tridiagonal, Sturm counts bisect the leading eigenvalues, inverse iteration gives their vectors (reorthogonalised
within clusters of close eigenvalues), the reflections are undone. The components that the tasks get are
dimension x ``components`` doubles.

Defined results: rows whose vector is NULL, empty or holds NULL or non-finite entries are dropped; so are vectors whose
length is not the commonest one (of equally common ones the greatest). NULL and repeated ids are rows like others, extra
columns are not read. Components whose eigenvalue is nothing but rounding (a table of equal vectors, fewer rows than
components) are left out, so there may be fewer than asked for, or none and so no rows. Grid values beyond a long
saturate; a deviation beyond a long is NULL. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAFE = 1 << 62
_MAX = float(2**63 - 1024)  # the greatest double that fits a long


def householder(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and subdiagonal of Q' A Q, and the unit reflection vectors whose product is Q (first one outermost)."""
    a = a.copy()
    d = len(a)
    vectors = []
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        v[0] += np.copysign(norm, v[0])
        length = np.linalg.norm(v)
        if length > 0:
            v /= length
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            p -= v * (v @ p)
            rest -= 2 * (np.outer(v, p) + np.outer(p, v))
            a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, a[k + 1, k])
        vectors.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), vectors


def sturm_counts(diag: np.ndarray, off2: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """For each value, how many eigenvalues of the tridiagonal matrix are smaller: the signs of its LDL' pivots."""
    q = diag[0] - at
    count = (q < 0).astype(np.int64)
    for k in range(1, len(diag)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diag[k] - at - off2[k - 1] / q
        count += q < 0
    return count


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, m: int) -> np.ndarray:
    """The m greatest eigenvalues, falling, by bisection of Gershgorin's interval."""
    radius = np.zeros(len(diag))
    radius[:-1] += np.abs(off)
    radius[1:] += np.abs(off)
    low, high = (diag - radius).min(), (diag + radius).max()
    spread = max(abs(low), abs(high), np.finfo(float).tiny)
    tiny = spread * np.finfo(float).eps ** 2
    index = len(diag) - 1 - np.arange(m)  # ascending index of each one
    lo, hi = np.full(m, low - spread * 1e-15), np.full(m, high + spread * 1e-15)
    for _ in range(200):
        mid = (lo + hi) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            break
        above = sturm_counts(diag, off * off, mid, tiny) > index
        lo, hi = np.where(above, lo, mid), np.where(above, mid, hi)
    return (lo + hi) / 2


def solve_shifted(diag: np.ndarray, off: np.ndarray, shift: float, rhs: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = rhs by Gaussian elimination with row exchanges; vanishing pivots become tiny."""
    n = len(diag)
    a, b, c = np.zeros(n), np.zeros(n), np.zeros(n)  # pivot row: main, next, next but one
    x = rhs.copy()
    main, right = diag[0] - shift, off[0] if n > 1 else 0.0
    for k in range(n - 1):
        below, own, after = off[k], diag[k + 1] - shift, off[k + 1] if k + 2 < n else 0.0
        if abs(main) >= abs(below):
            a[k], b[k], c[k] = main if abs(main) > tiny else tiny, right, 0.0
            f = below / a[k]
            main, right = own - f * right, after
            x[k + 1] -= f * x[k]
        else:
            a[k], b[k], c[k] = below, own, after
            f = main / below
            main, right = right - f * own, -f * after
            x[k], x[k + 1] = x[k + 1], x[k] - f * x[k + 1]
    a[n - 1] = main if abs(main) > tiny else tiny
    for k in range(n - 1, -1, -1):
        if k + 1 < n:
            x[k] -= b[k] * x[k + 1]
        if k + 2 < n:
            x[k] -= c[k] * x[k + 2]
        x[k] /= a[k]
    return x


def inverse_iteration(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as columns. Eigenvalues closer than a thousandth of the norm are a cluster, whose vectors are
    made orthogonal to each other in every step."""
    n, norm = len(diag), max(np.abs(values).max(), np.finfo(float).tiny)
    tiny = norm * np.finfo(float).eps
    rng = np.random.default_rng(0)
    out = np.zeros((n, len(values)))
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        # equal eigenvalues get slightly different shifts
        shift = value - 3 * tiny * sum(values[i] - value <= 3 * tiny for i in range(first, j))
        x = rng.standard_normal(n)
        for _ in range(5):
            x = solve_shifted(diag, off, shift, x / np.linalg.norm(x), tiny)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def eigen(v: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The m leading eigenvalues (falling) and unit eigenvectors (columns; the largest entry is positive) of ``v``."""
    m = min(m, len(v))
    if len(v) == 1:
        return v[0, :1].copy(), np.ones((1, 1))
    diag, off, reflections = householder(v)
    values = leading_eigenvalues(diag, off, m)
    vectors = inverse_iteration(diag, off, values)
    for k in range(len(reflections) - 1, -1, -1):
        h = reflections[k]
        vectors[k + 1 :] -= 2 * np.outer(h, h @ vectors[k + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(m)])
    return values, vectors * np.where(signs == 0, 1, signs)


def _strips(batch: pa.RecordBatch, scale: float, shift: int, dims: int | None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Strips of a batch with their grid values (object integers where a long sum could overflow)."""
    step = max(1, (1 << 20) // max(dims or 1, 1))
    for lo in range(0, batch.num_rows, step):
        part = batch.slice(lo, step)
        flat = part.column(part.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
        grid = np.floor(np.float64(scale) * flat)
        x = np.clip(grid, -_MAX, _MAX).astype(np.int64)
        if len(x) and np.abs(grid).max() > SAFE:
            # the sum with the shift saturates, too
            x = np.array([min(max(int(i) + shift, -(2**63)), 2**63 - 1) for i in x.tolist()], dtype=object)
        else:
            x = x + shift
        yield part, x.reshape(part.num_rows, -1)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact."""
    top = max([abs(s) for s in sums] + [0])
    if x.dtype == object or top >= SAFE or (x.size and n * int(np.abs(x).max()) >= SAFE):
        return x.astype(object) * n - np.array(sums, dtype=object)
    return n * x - np.array(sums, dtype=np.int64)


def clean_vectors(df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    v = F.col(vector)
    finite = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(finite).select(*keep, v.cast("array<double>").alias("__vector"))


def whiten(
    spark: SparkSession, df: DataFrame, vector: str = "embedding", id_column: str = "vec_id", components: int = 32, scale: float = 64.0, shift: int = 1_000_000
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row per usable row of ``df`` and component."""
    schema = f"{id_column} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = clean_vectors(df, vector, [F.col(id_column).cast("long").alias(id_column)])
    bare = rows.select("__vector")

    commonest = bare.groupBy(F.size("__vector").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if commonest is None:
        return spark.createDataFrame([], schema)
    dims, n = commonest["dims"], commonest["n"]
    rows, bare = (t.where(F.size("__vector") == dims) for t in (rows, bare))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for batch in batches:
            for _, x in _strips(batch, scale, shift, dims):
                safe = x.dtype != object and x.size and int(np.abs(x).max()) * len(x) < SAFE
                total = [a + int(b) for a, b in zip(total, (x if safe else x.astype(object)).sum(axis=0), strict=True)] if len(x) else total
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(dims), pa.int32()), "s": pa.array([str(t) for t in total], pa.string())})

    found = bare.mapInArrow(add, "at int, s string").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = [int(r["s"]) for r in sorted(found, key=lambda r: r["at"])]

    def covariance(project: np.ndarray | None) -> np.ndarray:
        """Of the centred rows, or of their projection: upper triangles per task, added up by an aggregate."""
        width = dims if project is None else project.shape[1]

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width, width))
            for batch in batches:
                for _, x in _strips(batch, scale, shift, dims):
                    z = (centred(x, n, sums) / n).astype(np.float64)
                    z = z if project is None else z @ project
                    total += z.T @ z
            i, j = np.triu_indices(width)
            for lo in range(0, len(i), 1 << 16):
                a, b = i[lo : lo + (1 << 16)], j[lo : lo + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"i": pa.array(a, pa.int32()), "j": pa.array(b, pa.int32()), "v": pa.array(total[a, b])})

        out = np.zeros((width, width))
        for r in bare.mapInArrow(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"] / n
        return out

    v = covariance(None)
    if not np.trace(v) > 0:
        return spark.createDataFrame([], schema)
    values, vectors = eigen(v, components)
    real = values > dims * np.finfo(float).eps * values[0]
    values, project = values[real], vectors[:, real] / np.sqrt(values[real])
    m, explained = len(values), values / np.trace(v)
    error = float(np.abs(covariance(project) - np.eye(m)).max())
    sent = spark.sparkContext.broadcast((project, sums))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project, sums = sent.value
        for batch in batches:
            for part, x in _strips(batch, scale, shift, max(dims, m)):
                d = centred(x, n, sums)
                white = (d / n).astype(np.float64) @ project
                exact = d if d.dtype == object or int(np.abs(d).max(initial=0)) ** 2 * dims >= SAFE else None
                deviation = (d * d).sum(axis=1).tolist() if exact is None else [sum(int(e) ** 2 for e in r) for r in d]
                deviation = pa.array([s if s < 2**63 else None for s in deviation], pa.int64())
                rows = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(rows), m))),
                        pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * m, n, dtype=np.int64)),
                        deviation.take(pa.array(np.repeat(np.arange(rows), m))),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * m, error)),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return rows.mapInArrow(apply, schema)
