"""Whitening of vectors: exact moments in Spark, spectral divide and conquer on the driver, projection in tasks.

The covariance is split by polar decompositions (QDWH: dynamically weighted Halley steps, by QR while
they are ill conditioned, else by Cholesky). The polar factor of V - shift * I is the sign of V about
the shift; half of it plus the identity projects on the eigenvectors above the shift. A basis of that
range and of its complement splits V into two smaller blocks, down to blocks of one.

What the driver holds is bounded by the length of a vector: sums, the covariance and its eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

SCALE, OFFSET = 64, 1_000_000
#: Entries of this size and above have no place on the grid of longs.
LARGEST = 2.0**36
COMPONENTS = 16
ROWS = 4096
EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric, non-singular matrix by QDWH."""
    size = len(a)
    x = a / max(np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf)), np.finfo(float).tiny)
    low = max(1.0 / (np.linalg.norm(np.linalg.inv(x), 1) * np.sqrt(size)), EPS) if np.linalg.matrix_rank(x) == size else EPS
    low, eye = min(low, 1.0), np.eye(size)
    for _ in range(30):
        l2 = low * low
        gap = np.cbrt(4 * max(1 - l2, 0.0) / (l2 * l2))
        root = np.sqrt(1 + gap)
        wa = root + 0.5 * np.sqrt(8 - 4 * gap + 8 * (2 - l2) / (l2 * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        low = min(low * (wa + wb * l2) / (1 + wc * l2), 1.0)
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        else:
            factor = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(factor, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(factor.T, half).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        if moved <= np.cbrt(4 * EPS) and 1 - low < 1e-8:
            break
    return x


def _split(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of `a` that make up the whole, or None if it is a multiple of the identity."""
    size, middle, norm = len(a), np.trace(a) / len(a), np.linalg.norm(a)
    if np.linalg.norm(a - middle * np.eye(size)) <= 4 * EPS * norm:
        return None
    diagonal, best = np.sort(np.diag(a)), None
    # The mean always parts the eigenvalues of such a matrix; the others keep clear of a shift that is an eigenvalue.
    shifts = [(diagonal[(size - 1) // 2] + diagonal[size // 2]) / 2, middle, *(middle + s * np.linalg.norm(a - middle * np.eye(size)) / size for s in (0.1, -0.1, 0.3, -0.3))]
    for shift in shifts:
        project = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
        rank = round(float(np.trace(project)))
        if not 0 < rank < size:
            continue
        start = project @ rng.standard_normal((size, rank))
        basis = np.linalg.qr(project @ np.linalg.qr(start)[0], mode="complete")[0]
        left, right = basis[:, :rank], basis[:, rank:]
        lost = np.linalg.norm(right.T @ a @ left)
        if best is None or lost < best[0]:
            best = (lost, left, right)
        if lost <= 10 * EPS * size * norm:
            break
    return best and best[1:]


def eigenvectors(v: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns, the largest entry of each positive."""
    rng, done, open_ = np.random.default_rng(seed), [], [np.eye(len(v))]
    while open_:
        basis = open_.pop()
        parts = None
        if basis.shape[1] > 1:
            block = basis.T @ v @ basis
            parts = _split((block + block.T) / 2, rng)
        if parts is None:
            done.append(basis)
        else:
            open_ += [basis @ part for part in parts]
    vectors = np.linalg.qr(np.hstack(done))[0]
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(v))])
    return values[order], vectors * np.where(signs == 0, 1, signs)


class Fit:
    """What the tasks need of the vectors of one length: count, sums as (quotient, remainder), and the projection."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.quotient = np.array([s // n for s in sums], dtype=np.int64)
        self.remainder = np.array([s % n for s in sums], dtype=np.int64)
        self.project: np.ndarray | None = None
        self.live: np.ndarray | None = None
        self.explained: np.ndarray | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs, or Python integers where those might not do."""
        away = x - self.quotient
        if len(x) and int(np.abs(away).max()) + 1 >= 2**62 // self.n:
            away = away.astype(object)
        return away * self.n - self.remainder

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        scaled = self.scaled(x)
        if scaled.dtype == object or (len(x) and float(np.abs(scaled).max()) ** 2 * scaled.shape[1] >= 2.0**62):
            sums = (scaled.astype(object) ** 2).sum(axis=1)
            return [int(s) if s < 2**63 else None for s in sums]
        return (scaled * scaled).sum(axis=1).tolist()

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.project


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix of longs) for each length in a batch."""
    ends = column.offsets.to_numpy()
    flat, sizes = column.values.to_numpy(zero_copy_only=False), np.diff(ends)
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, flat[ends[rows][:, None] + np.arange(size)]


def on_grid(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows that take part."""
    fits = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(F.coalesce(fits, F.lit(False)))
    return rows.select("id", F.transform("vector", lambda c: F.floor(c * SCALE) + OFFSET).alias("x"))


def _moments(fit: DataFrame, fits: dict[int, Fit], function: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length the sum and the sum of products of a Fit's `function` over the fit list; tasks send sums only."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in _by_length(batch.column(0)):
                y = getattr(fits[size], function)(x)
                y = np.hstack([np.ones((len(y), 1)), y])  # products with 1 are the sums
                totals[size] = totals.get(size, 0) + y.T @ y
        for size, total in totals.items():
            i, j = np.triu_indices(len(total))
            columns = [np.full(len(i), size), i, j, total[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["size", "i", "j", "value"])

    sums = fit.mapInArrow(partial, "size long, i long, j long, value double").groupBy("size", "i", "j").agg(F.sum("value").alias("value"))
    out: dict[int, np.ndarray] = {}
    # At most the square of a vector's length.
    for r in sums.collect():
        width = (fits[r["size"]].project.shape[1] if function == "whitened" else r["size"]) + 1
        total = out.setdefault(r["size"], np.zeros((width, width)))
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["value"]
    return {size: (t[0, 1:], t[1:, 1:]) for size, t in out.items()}


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each row that takes part and each component.

    Rows without a vector, or with a null, non-finite or too large (2^36) entry take no part. Repeated
    rows and null ids are rows like any other; vectors that are equal on the grid count once in the fit.
    Vectors of another length are fitted among themselves; empty ones have no components. Equal
    eigenvalues have any orthonormal vectors of their space. Where an eigenvalue is zero (to rounding,
    against the trace) `whitened` is null and the component is left out of identity_error; a single
    distinct vector has only such, and `explained` is null. A deviation beyond a long is null. A table
    without such rows gives none.
    """
    small_batches(rows.sparkSession, ROWS)
    points = on_grid(rows, id_col, vector_col)
    fit = written(points.select("x").where(F.size("x") > 0).distinct(), "whitening-fit")
    # Sums of the high and low parts, so that no sum leaves the longs: one row for each dimension.
    high, low = F.sum(F.shiftright("v", 20)).alias("high"), F.sum(F.col("v").bitwiseAND(2**20 - 1)).alias("low")
    sums = fit.select(F.size("x").alias("size"), F.posexplode("x").alias("at", "v")).groupBy("size", "at").agg(F.count("*").alias("n"), high, low).collect()
    fits: dict[int, Fit] = {}
    for size in {r["size"] for r in sums}:
        own = sorted((r["at"], (r["high"] << 20) + r["low"], r["n"]) for r in sums if r["size"] == size)
        fits[size] = Fit(own[0][2], [s for _, s, _ in own])
    for size, (mean, products) in _moments(fit, fits, "centred").items():
        n = fits[size].n
        v = products / n - np.outer(mean / n, mean / n)
        values, vectors = eigenvectors((v + v.T) / 2)
        trace, values, vectors = np.trace(v), values[:components], vectors[:, :components]
        live = values > size * EPS * max(trace, np.finfo(float).tiny)
        fits[size].live, fits[size].project = live, vectors / np.sqrt(np.where(live, values, 1.0))
        fits[size].explained = values / trace if trace > 0 else np.full(len(values), np.nan)
    errors = {}
    for size, (mean, products) in _moments(fit, fits, "whitened").items():
        n, live = fits[size].n, fits[size].live
        off = products / n - np.outer(mean / n, mean / n) - np.eye(len(live))
        errors[size] = float(np.abs(off[np.ix_(live, live)]).max(initial=0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, x in _by_length(batch.column(1)):
                f = fits[size]
                w, k = f.whitened(x), f.project.shape[1]
                dead = np.broadcast_to(~f.live, w.shape).ravel()
                one = np.repeat(np.arange(len(rows)), k)
                explained = np.tile(f.explained, len(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[one])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(one), f.n, dtype=np.int64)), pa.array(f.deviation(x), pa.int64()).take(pa.array(one)),
                        pa.array(w.ravel(), mask=dead), pa.array(explained, mask=np.isnan(explained)), pa.array(np.full(len(one), errors[size]))
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
                )

    kind = dict(points.dtypes)["id"]
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return points.mapInArrow(run, schema)
