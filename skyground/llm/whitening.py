"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers x = floor(scale * c) + shift. The fit list holds each distinct vector once. Its centred rows X
are bidiagonalised, X V = U B: every step is one pass over the rows, in which each task forms its part of the left vectors
(X times their coefficients, so no left vector is stored and a lost executor costs a task), the product Xv of the new one,
less the one before, and the product X'u. Only sums over rows leave the tasks. Left and right vectors are fully
reorthogonalised: the left ones by their inner products from the same pass, the right ones twice on the driver, where
B and V are as long as a vector, not as the table. The singular vectors and values of the small B give components and
deviations.

Steps go on until all directions are found, or the wanted ones have converged and what variance is left outside
V is less than the last of them has, so that none, also no second copy of an equal value, can be missing. Where a
Krylov space ends early a random direction orthogonal to it starts the next; if that has no variance, nothing else has.

The fit list is packed into blocks of about a megabyte, so a step reads bytes and no lists. Sums and ``deviation`` are
exact whole numbers.

Defined cases: rows whose vector is null, or holds an entry that is null, not finite or of 2^52 / scale and more, are
dropped, all others come out, rows with a null id and repeated rows too; vectors of each length are a table of their own; components
without variance (below 1e-10 of the first in deviation) do not exist, so where all vectors are equal, where there is one, or where they are empty, no
rows come out; nor from an empty table. A ``deviation`` that fits no long is null. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyground.llm.common import staged

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK_BYTES = 1 << 20
#: Relative to the root of the total variance: what counts as nothing, and as converged.
NOTHING, CONVERGED = 1e-12, 1e-14
LEAST_DEVIATION = 1e-10
SEED = 11


class Fit(NamedTuple):
    """What is learnt of vectors of one length. ``sums`` and ``mean`` are of x less the shift."""

    n: int
    sums: list[int]
    mean: np.ndarray
    variances: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float


def _whole(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id, x, dims`` of the rows that remain; ``x`` is without the shift, which changes no difference."""
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < 2.0**52)
    return (
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("_v"))
        .filter(F.col("_v").isNotNull() & F.forall("_v", usable) & (F.size("_v") > 0))
        .select("vec_id", F.transform("_v", lambda c: F.floor(c * scale)).alias("x"))
        .withColumn("dims", F.size("x"))
    )


def _by_length(batch: pa.RecordBatch, lists: int, sizes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each length of vector in a batch, the rows that have it, and their matrix."""
    each = batch.column(sizes).to_numpy()
    for dims in np.unique(each).tolist():
        mine = np.flatnonzero(each == dims)
        flat = batch.column(lists).take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False)
        yield dims, mine, flat.reshape(-1, dims)


def fit_list(whole: DataFrame) -> DataFrame:
    """Each distinct vector once, packed: ``dims`` and ``block``, rows of doubles end to end."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, _, x in _by_length(batch, 0, 1):
                rows = max(1, BLOCK_BYTES // (8 * dims))
                blobs = [x[at : at + rows].astype("<f8").tobytes() for at in range(0, len(x), rows)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dims] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())], names=["dims", "block"]
                )

    return whole.select("x", "dims").distinct().mapInArrow(pack, "dims int, block binary")


def _sums(blocks: DataFrame, of: Callable[[int, np.ndarray], np.ndarray | None], kind: str = "double") -> dict[int, list]:
    """Sums over all blocks of the numbers ``of`` gives for one: per length as many numbers as it returns.

    A task sends one row per length, and places are summed across tasks before the driver sees them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = of(dims, np.frombuffer(blob.as_buffer(), "<f8").reshape(-1, dims))
                if part is not None:
                    sums[dims] = sums[dims] + part if dims in sums else part
        if sums:
            value = pa.int64() if kind == "long" else pa.float64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(value))],
                names=["dims", "total"],
            )

    parts = blocks.mapInArrow(run, f"dims int, total array<{kind}>")
    places = parts.select("dims", F.posexplode("total").alias("at", "part")).groupBy("dims", "at").agg(F.sum("part").alias("part"))
    out: dict[int, dict[int, float]] = {}
    for dims, at, part in places.collect():
        out.setdefault(dims, {})[at] = part
    return {dims: [sums[i] for i in range(len(sums))] for dims, sums in out.items()}


def _exact(dims: int, x: np.ndarray) -> np.ndarray:
    """Number of rows and, per dimension, sums of high and low parts of the whole numbers; none of them can overflow."""
    whole = x.astype(np.int64)
    return np.concatenate([[len(x)], (whole >> 26).sum(axis=0), (whole & ((1 << 26) - 1)).sum(axis=0)])


class Bidiagonal:
    """The bidiagonalisation of one matrix as far as it is: X V = U B.

    ``w`` holds the coefficients of the left vectors (u = X w), ``z`` their products X'u.
    """

    def __init__(self, dims: int, total: float, wanted: int):
        self.dims, self.total, self.wanted = dims, total, wanted
        self.small = NOTHING * np.sqrt(total)
        self.random = np.random.default_rng((SEED, dims))
        self.v, self.w, self.z = (np.zeros((dims, 0)) for _ in range(3))
        self.alphas: list[float] = []
        self.betas: list[float] = []
        self.next = self._start()
        self.restarted = True
        self.done = total == 0

    def _orthogonal(self, r: np.ndarray) -> np.ndarray:
        for _ in range(2):
            r = r - self.v @ (self.v.T @ r)
        return r

    def _start(self) -> np.ndarray:
        r = self._orthogonal(self.random.standard_normal(self.dims))
        return r / np.linalg.norm(r)

    def ask(self) -> np.ndarray:
        """Coefficients to multiply the rows by: of the left vectors so far, and of the new one before reorthogonalisation."""
        new = self.next.copy()
        if self.betas and self.betas[-1]:
            new -= self.betas[-1] * self.w[:, -1]
        return np.column_stack([self.w, new])

    def tell(self, asked: np.ndarray, sums: np.ndarray) -> None:
        """One step: ``sums`` are X'u of the new left vector and its inner products with all of them and itself."""
        product, dots, square = sums[: self.dims], sums[self.dims : -1], sums[-1]
        alpha = float(np.sqrt(max(0.0, square - dots @ dots)))
        self.v = np.column_stack([self.v, self.next])
        if alpha <= self.small:
            # No variance along this direction beyond what earlier left vectors have.
            if self.restarted:
                self.v = self.v[:, :-1]
                self.done = True
                return
            alpha, w, z = 0.0, np.zeros(self.dims), np.zeros(self.dims)
        else:
            w = (asked[:, -1] - self.w @ dots) / alpha
            z = (product - self.z @ dots) / alpha
        self.w, self.z = np.column_stack([self.w, w]), np.column_stack([self.z, z])
        self.alphas.append(alpha)
        if len(self.alphas) == self.dims:
            self.done = True
            return
        rest = self._orthogonal(z - alpha * self.next)
        beta = float(np.linalg.norm(rest))
        self.restarted = beta <= self.small
        self.next = self._start() if self.restarted else rest / beta
        self.done = self._converged(beta)
        self.betas.append(0.0 if self.restarted else beta)

    def matrix(self) -> np.ndarray:
        return np.diag(self.alphas) + np.diag(self.betas[: max(0, len(self.alphas) - 1)], 1)

    def _converged(self, beta: float) -> bool:
        b = self.matrix()
        if len(b) < self.wanted:
            return False
        left, values, _ = np.linalg.svd(b)
        outside = self.total - float((b * b).sum())
        residuals = beta * np.abs(left[-1, : self.wanted])
        return bool(residuals.max() <= CONVERGED * np.sqrt(self.total) and outside < values[self.wanted - 1] ** 2)

    def components(self) -> tuple[np.ndarray, np.ndarray]:
        """Singular values, falling, and right singular vectors of X, as many as wanted and there are."""
        if not self.alphas:
            return np.zeros(0), np.zeros((self.dims, 0))
        _, values, right = np.linalg.svd(self.matrix())
        there = min(self.wanted, int((values > LEAST_DEVIATION * values[0]).sum()))
        return values[:there], self.v @ right[:there].T


def fit(blocks: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Per length of vector the components of the packed ``blocks``; one pass over them per step, for all lengths at once."""
    counts, sums, means = {}, {}, {}
    for dims, s in _sums(blocks, _exact, "long").items():
        counts[dims] = s[0]
        sums[dims] = [(high << 26) + low for high, low in zip(s[1 : dims + 1], s[dims + 1 :], strict=True)]
        means[dims] = np.array([total / counts[dims] for total in sums[dims]])
    totals = _sums(blocks, lambda d, x: np.array([((x - means[d]) ** 2).sum()]))
    state = {d: Bidiagonal(d, totals[d][0], components) for d in counts}
    while going := {d: b.ask() for d, b in state.items() if not b.done}:

        def step(d: int, x: np.ndarray, going=going) -> np.ndarray | None:
            if d not in going:
                return None
            rows = x - means[d]
            left = rows @ going[d]
            return np.concatenate([rows.T @ left[:, -1], left.T @ left[:, -1]])

        for d, s in _sums(blocks, step).items():
            state[d].tell(going[d], np.array(s))
    found = {d: b.components() for d, b in state.items()}
    variances = {d: values**2 / counts[d] for d, (values, _) in found.items()}
    scaled = {d: found[d][1] / np.sqrt(variances[d]) for d in found}

    def moments(d: int, x: np.ndarray) -> np.ndarray:
        white = (x - means[d]) @ scaled[d]
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    measured = _sums(blocks, moments) if any(len(v) for v in variances.values()) else {}
    out = {}
    for d, n in counts.items():
        k = len(variances[d])
        error = 0.0
        if k:
            first, second = np.array(measured[d][:k]) / n, np.array(measured[d][k:]).reshape(k, k) / n
            error = float(np.abs(second - np.outer(first, first) - np.eye(k)).max())
        trace = totals[d][0] / n
        explained = variances[d] / trace if k else np.zeros(0)
        out[d] = Fit(n, sums[d], means[d], variances[d], found[d][1], explained, error)
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of (n * x - S)^2, exactly; None where a long cannot hold one."""
    whole = x.astype(np.int64)
    most = n * int(np.abs(whole).max()) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        return ((whole * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = (sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in whole.tolist())
    return [d if d < 1 << 63 else None for d in exact]


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error`` per remaining row; the two lists are by component."""
    whole = _whole(vectors, scale)
    fits = fit(staged(fit_list(whole), "fit-list"), components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, mine, x in _by_length(batch, 1, 2):
                f = fits[dims]
                white = (x - f.mean) @ (f.components / np.sqrt(f.variances))
                k = white.shape[1]
                bounds = pa.array(np.arange(0, (len(x) + 1) * k, k) if k else np.zeros(len(x) + 1), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(mine)),
                        pa.array(np.full(len(x), f.n)),
                        pa.array(_deviations(x, f.n, f.sums), pa.int64()),
                        pa.ListArray.from_arrays(bounds, pa.array(white.ravel())),
                        pa.ListArray.from_arrays(bounds, pa.array(np.tile(f.explained, len(x)))),
                        pa.array(np.full(len(x), f.identity_error)),
                    ],
                    names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return whole.select("vec_id", "x", "dims").mapInArrow(
        run,
        "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double",
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """One row per row of :func:`whiten` and component, numbered from 1."""
    pairs = F.arrays_zip("whitened", "explained")
    return whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(pairs).alias("at", "c")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )
