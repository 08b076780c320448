"""Whitening of embeddings by mixed-precision eigenvectors of a distributed covariance.

Entries are taken on a grid of 1/64 as integers x, so that sums over any number
of rows, in any order, are exact. Each distinct x vector counts once; finding
them is a grouped aggregate, combined before the shuffle, so a vector on a third
of all rows is one row a task. Two passes over the distinct vectors, as sums of
a task each, give first n and the sums S, then the products about the rounded
mean: the covariance V is known to the last bit. What comes to the driver is a
vector and a matrix of the dimension.

Eigenvectors start in single precision and are corrected by the iteration of
Ogita and Aishima in extended precision: matrix products alone, the error
squared each time. Where eigenvalues lie closer than the iteration can tell
apart, the vectors of that cluster are first turned by the solution of the
small problem that V, less the cluster's mean eigenvalue, has in their span.

Defined results: rows whose vector is null, or holds an entry that is null, not
finite or too large for a long, are dropped, and so are those whose length is
not the most frequent one (the greater of equally frequent ones). Rows that
repeat are all returned. A direction in which the fit list does not vary has
explained 0 and no whitened value. A deviation too large for a long is null. An
empty table, or one of empty vectors, has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm import common

GRID, SHIFT = 64.0, 1_000_000
COMPONENTS = 16
#: Integers of any size are summed as digits of this many bits, in longs.
DIGIT, DIGITS = 31, 6
#: Below this share of the trace an eigenvalue is zero.
ZERO = 1e-15
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
#: Rows of a block in a task.
ROWS = 4096


def on_grid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, z, dim): valid vectors as ``z = x - SHIFT``, little-endian integers of 2, 4 or 8 bytes, the least that hold a vector."""
    own = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v")).where("v is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            ends, values = lists.offsets.to_numpy(), lists.values
            holes = values.is_null().to_numpy(zero_copy_only=False)
            c = np.where(holes, np.nan, values.fill_null(np.nan).to_numpy(zero_copy_only=False))
            z = np.floor(GRID * c)
            fit = np.isfinite(z) & (np.abs(z) < 2.0**62)
            bad = np.concatenate([[0], np.cumsum(~fit)])
            size = np.abs(np.where(fit, z, 0.0))
            z = np.where(fit, z, 0.0).astype("<i8")
            places, out, dims = [], [], []
            for i in range(batch.num_rows):
                a, b = int(ends[i]), int(ends[i + 1])
                if b > a and bad[b] == bad[a]:
                    most = size[a:b].max()
                    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
                    places.append(i)
                    out.append(z[a:b].astype(kind).tobytes())
                    dims.append(b - a)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(places, pa.int64())), pa.array(out, pa.binary()), pa.array(dims, pa.int32())], names=["id", "z", "dim"])

    return common.map_arrow(own, run, "id long, z binary, dim int")


def _blocks(batch: pa.RecordBatch, name: str, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integer matrix) of blocks of a batch."""
    values = batch.column(batch.schema.names.index(name)).to_pylist()
    for at in range(0, len(values), ROWS):
        part = values[at : at + ROWS]
        yield at, np.stack([np.frombuffer(z, dtype=f"<i{len(z) // dim}").astype(np.int64) for z in part])


def digits(number: int) -> list[int]:
    """A whole number in digits of ``DIGIT`` bits, the sign in the last one."""
    low = [(number >> (DIGIT * k)) & ((1 << DIGIT) - 1) for k in range(DIGITS - 1)]
    return [*low, number >> (DIGIT * (DIGITS - 1))]


def _summed(df: DataFrame, keys: list[str]) -> list[tuple[tuple[int, ...], int]]:
    """Sums of numbers in digits by key; there are at most as many keys as entries of a matrix of the dimension."""
    total = df.groupBy(*keys).agg(*[F.sum(f"d{k}").alias(f"d{k}") for k in range(DIGITS)])
    return [(tuple(r[k] for k in keys), sum(r[f"d{k}"] << (DIGIT * k) for k in range(DIGITS))) for r in total.collect()]


def _exact_product(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of integers as Python integers; by floating products where these are exact."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if most < 1 << 52:
        # halves whose products are exact for a few rows at a time
        high, low = y >> 26, y & ((1 << 26) - 1)
        total = 0
        for at in range(0, len(y), 2):
            h, lo = high[at : at + 2].astype(np.float64), low[at : at + 2].astype(np.float64)
            hh, hl, ll = ((a.T @ b).astype(np.int64).astype(object) for a, b in ((h, h), (h, lo), (lo, lo)))
            total = total + hh * (1 << 52) + (hl + hl.T) * (1 << 26) + ll
        return total
    o = y.astype(object)
    return o.T @ o


def sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension of z."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, dtype=object)
        for batch in batches:
            for _, z in _blocks(batch, "z", dim):
                n += len(z)
                total = total + (z.sum(axis=0) if np.abs(z).max() < 1 << 50 else z.astype(object).sum(axis=0)).astype(object)
        if n:
            yield _digit_rows([(-1, n), *enumerate(total)])

    def _digit_rows(numbers) -> pa.RecordBatch:
        cols = [pa.array([i for i, _ in numbers], pa.int32())]
        split = [digits(int(x)) for _, x in numbers]
        return pa.RecordBatch.from_arrays([*cols, *[pa.array([s[k] for s in split], pa.int64()) for k in range(DIGITS)]], names=["i", *[f"d{k}" for k in range(DIGITS)]])

    found = dict(_summed(common.map_arrow(fit, run, "i int, " + ", ".join(f"d{k} long" for k in range(DIGITS))), ["i"]))
    return found.get((-1,), 0), [found.get((i,), 0) for i in range(dim)]


def products(fit: DataFrame, dim: int, middle: np.ndarray) -> list[list[int]]:
    """Sums of products of all pairs of dimensions of ``z - middle``."""
    rows, cols = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, z in _blocks(batch, "z", dim):
                total = _exact_product(z - middle) + (0 if total is None else total)
        if total is not None:
            split = [digits(int(x)) for x in total[rows, cols]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array(cols, pa.int32()), *[pa.array([s[k] for s in split], pa.int64()) for k in range(DIGITS)]],
                names=["i", "j", *[f"d{k}" for k in range(DIGITS)]],
            )

    out = [[0] * dim for _ in range(dim)]
    for (i, j), x in _summed(common.map_arrow(fit, run, "i int, j int, " + ", ".join(f"d{k} long" for k in range(DIGITS))), ["i", "j"]):
        out[i][j] = out[j][i] = x
    return out


def _clusters(lam: np.ndarray, delta) -> list[np.ndarray]:
    """Runs of sorted eigenvalues of which neighbours lie within ``delta``."""
    order = np.argsort(lam)
    cut = np.flatnonzero(np.diff(lam[order]) > delta) + 1
    return [c for c in np.split(order, cut) if len(c) > 1]


def _spectrum(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.longdouble]:
    """R = I - X'X, S = X'AX, the eigenvalues of both, and the distance under which these cannot be told apart."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    lam = np.diag(s) / (1 - np.diag(r))
    norm = lambda m: np.sqrt((m * m).sum())
    noise = 4 * len(a) * np.finfo(a.dtype).eps * np.abs(lam).max()
    return r, s, lam, max(2 * (norm(s - np.diag(lam)) + np.abs(lam).max() * norm(r)), noise)


def refined(a: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of a symmetric matrix of extended precision."""
    scale = np.abs(a).max()
    if scale == 0 or len(a) == 1:
        return np.diag(a).copy(), np.eye(len(a), dtype=a.dtype)
    a = a / scale
    eps = np.finfo(a.dtype).eps * len(a)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(a.dtype)
    best = np.inf
    for _ in range(40):
        r, s, lam, delta = _spectrum(a, x)
        close = _clusters(lam, delta) if depth < 6 else []
        if close:
            # first the span of each cluster, then the vectors in it
            x = x + x @ r / 2
            for c in close:
                basis = x[:, c]
                mean = lam[c].mean()
                inner = basis.T @ (a @ basis) - mean * (basis.T @ basis)
                inner = (inner + inner.T) / 2
                if len(c) < len(a) and np.abs(inner).max() > eps:
                    x[:, c] = basis @ refined(inner, depth + 1)[1]
            r, s, lam, delta = _spectrum(a, x)
        gap = lam[None, :] - lam[:, None]
        apart = np.abs(gap) > delta
        e = np.where(apart, (s + lam[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        size = np.abs(e).max()
        if size <= eps or (size < 1e-12 and size >= best):
            break
        best = min(best, size)
    for _ in range(3):
        # orthogonal to the last bit, also where two eigenvalues are hardly apart
        x = x + x @ (np.eye(len(a), dtype=a.dtype) - x.T @ x) / 2
    lam = _spectrum(a, x)[2]
    order = np.argsort(-lam, kind="stable")
    return lam[order] * scale, x[:, order]


def covariance(n: int, total: list[int], second: list[list[int]], middle: list[int]) -> np.ndarray:
    """Covariance, divisor n, from exact sums about ``middle``, each entry rounded once."""
    rest = [s - n * m for s, m in zip(total, middle)]
    square = np.longdouble(str(n * n))
    d = len(total)
    v = np.empty((d, d), dtype=np.longdouble)
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = np.longdouble(str(n * second[i][j] - rest[i] * rest[j])) / square
    return v


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every valid vector on the leading components of the distinct ones, scaled to unit variance (``OUT``)."""
    spark = vectors.sparkSession
    grid = on_grid(vectors, vec_id, embedding)
    # the lengths, most frequent first
    first = grid.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if first is None:
        return spark.createDataFrame([], OUT)
    dim = first["dim"]
    rows = grid.where(F.col("dim") == dim).select("id", "z")
    fit = common.stored(rows.select("z").distinct())
    n, total = sums(fit, dim)
    middle = [(2 * s + n) // (2 * n) for s in total]
    center = np.array(middle, dtype=np.int64)
    v = covariance(n, total, products(fit, dim, center), middle)
    lam, vecs = refined(v)
    trace = np.trace(v)
    k = min(components, dim)
    lam, vecs = lam[:k], vecs[:, :k]
    live = lam > trace * ZERO
    rest = [s - n * m for s, m in zip(total, middle)]
    offset = np.array([np.longdouble(str(r)) for r in rest]) / np.longdouble(str(n))
    project = (vecs / np.sqrt(np.where(live, lam, 1))).astype(np.float64)
    constant = (offset @ (vecs / np.sqrt(np.where(live, lam, 1)))).astype(np.float64)
    explained = np.where(live, lam / (trace if trace > 0 else 1), 0).astype(np.float64)

    def scores(z: np.ndarray) -> np.ndarray:
        return (z - center).astype(np.float64) @ project - constant

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, z in _blocks(batch, "z", dim):
                w = scores(z)
                one += w.sum(axis=0)
                two += w.T @ w
        i, j = np.indices((k + 1, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.concatenate([two, one[None, :]]).ravel())], names=["i", "j", "s"])

    held = np.zeros((k + 1, k))
    for r in common.map_arrow(fit, moments, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        held[r["i"], r["j"]] = r["s"] / n
    unit = (held[:k] - np.outer(held[k], held[k]) - np.eye(k))[np.ix_(live, live)]
    error = float(np.abs(unit).max(initial=0.0))
    far = np.array([abs(r) for r in rest], dtype=object).max()
    shift = np.array(rest, dtype=object)

    def deviation(z: np.ndarray) -> list[int | None]:
        y = z - center
        most = n * int(np.abs(y).max(initial=0)) + int(far)
        if most * most * dim < 1 << 63:
            return ((n * y - shift.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((n * y.astype(object) - shift) ** 2).sum(axis=1)
        return [int(e) if e < 1 << 63 else None for e in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, z in _blocks(batch, "z", dim):
                w = scores(z)
                r = len(z)
                ids = batch.column(0).slice(at, r).take(pa.array(np.repeat(np.arange(r), k)))
                far_off = pa.array(deviation(z), pa.int64()).take(pa.array(np.repeat(np.arange(r), k)))
                dead = np.tile(~live, r)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.tile(np.arange(1, k + 1), r), pa.int32()), pa.array(np.full(r * k, n), pa.int64()), far_off,
                        pa.array(w.ravel(), mask=dead), pa.array(np.tile(explained, r)), pa.array(np.full(r * k, error)),
                    ],
                    names=[x.split()[0] for x in OUT.split(", ")],
                )

    return common.map_arrow(rows, run, OUT)
