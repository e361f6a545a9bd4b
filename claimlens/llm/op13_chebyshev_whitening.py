"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become integers. The distinct vectors are written once, in blocks, to the shared folder. The covariance V
is never formed: a pass over the blocks centres them and adds up XᵀXQ / n for a narrow matrix Q. A few Lanczos
passes bound the spectrum from below, the least Ritz value of the block bounds its unwanted part from above, and a
Chebyshev polynomial of V, by its three-term recurrence with one pass per degree, damps that part. QR and
Rayleigh-Ritz follow, until the residuals of all wanted pairs are certified to lie at rounding level. Where the gap
behind the block is so narrow that this would take more than ``MAX_PASSES`` passes, the block is widened, at most to
all dimensions.

The driver holds only matrices of (dimension x block width). Sums of integers are exact; x is shifted by the integer
nearest to its mean before anything is rounded.

Defined results: a row takes no part if its vector is null, empty, or holds an entry that is null, not finite or
beyond 2**56 in size (it would not fit a long). Vectors of each length are whitened as a list of their own. Components
without variance (equal vectors, fewer vectors than dimensions) cannot be whitened and are left out. Repeated rows and
null ids keep their rows; equal vectors get equal values. A deviation beyond a long is null. Other columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import table, written

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
LARGEST = 2.0**56
BLOCK_VALUES = 1 << 20
LANCZOS_STEPS, MAX_DEGREE, MAX_PASSES, MAX_SWEEPS = 8, 16, 160, 60
RESIDUAL, FLOOR = 2e-14, 1e-12

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def integers(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and integer vector x of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    return (
        embeddings.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
        .filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
        .select("id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long")).alias("x"))
    )


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) of each length among a batch's integer vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield rows, flat[starts[rows][:, None] + np.arange(dim)]


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct vector once, in blocks of one length, written to the shared folder."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, x in _matrices(batch.column(0)):
                step = max(1, BLOCK_VALUES // x.shape[1])
                out += [(x.shape[1], x[i : i + step].astype("<i8").tobytes()) for i in range(0, len(x), step)]
            dims, blocks = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(blocks, pa.binary())], names=["dim", "x"])

    return written(vectors.select("x").distinct().mapInArrow(pack, "dim int, x binary"), "whitening-list")


@dataclass
class Centre:
    """Count, exact sums, the integer next to each mean and what is left of the mean."""

    n: int
    sums: list[int]

    def __post_init__(self):
        near = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        self.near = np.array(near, np.int64)
        self.over = [s - self.n * c for s, c in zip(self.sums, near, strict=True)]
        self.rest = np.array([o / self.n for o in self.over])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n*x - S)**2 of each row, exact; None beyond a long."""
        y = x - self.near
        largest = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.over), default=0)
        exact = np.int64 if largest * largest * y.shape[1] < 1 << 63 else object
        gap = y.astype(exact) * self.n - np.array(self.over, exact)
        total = (gap * gap).sum(axis=1).tolist()
        return [t if t < 1 << 63 else None for t in total]


def centre(blocks: DataFrame, dim: int) -> Centre:
    """Exact count and sums of the blocks of one length; the halves of a sum cannot overflow in a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            for x in batch.column(0):
                x = np.frombuffer(x.as_py(), "<i8").reshape(-1, dim)
                n += len(x)
                high += (x >> 32).sum(axis=0)
                low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim, dtype=np.int32)), pa.array([n] * dim), pa.array(high), pa.array(low)],
            names=["i", "n", "high", "low"],
        )

    parts = blocks.select("x").mapInArrow(add, "i int, n long, high long, low long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    rows = sorted(parts.groupBy("i").agg(*exact).collect())  # one row per dimension
    return Centre(int(rows[0].n), [(int(r.high) << 32) + int(r.low) for r in rows])


def product(blocks: DataFrame, mean: Centre, q: np.ndarray) -> tuple[np.ndarray, float]:
    """VQ by one pass over the blocks, and the trace of V."""
    dim, width = q.shape
    names = [f"c{k}" for k in range(width)] + ["squares"]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares = np.zeros((dim, width)), np.zeros(dim)
        for batch in batches:
            for x in batch.column(0):
                z = mean.centred(np.frombuffer(x.as_py(), "<i8").reshape(-1, dim))
                total += z.T @ (z @ q)
                squares += (z * z).sum(axis=0)
        columns = [np.arange(dim, dtype=np.int32), *(np.ascontiguousarray(c) for c in total.T), squares]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", *names])

    parts = blocks.select("x").mapInArrow(multiply, "i int, " + ", ".join(f"{c} double" for c in names))
    rows = sorted(parts.groupBy("i").agg(*(F.sum(c).alias(c) for c in names)).collect())  # one row per dimension
    sums = np.array([r[1:] for r in rows]) / mean.n
    return sums[:, :-1], float(sums[:, -1].sum())


class Passes:
    """V as an operator; every application is one pass over the blocks."""

    def __init__(self, blocks: DataFrame, mean: Centre):
        self.blocks, self.mean, self.count, self.trace = blocks, mean, 0, 0.0

    def __call__(self, q: np.ndarray) -> np.ndarray:
        self.count += 1
        out, self.trace = product(self.blocks, self.mean, q)
        return out


def least_bound(apply, dim: int, rng) -> float:
    """A safeguarded lower bound of the spectrum by a few Lanczos steps."""
    v = rng.standard_normal(dim)
    basis, alphas, betas = [v / np.linalg.norm(v)], [], []
    for _ in range(min(LANCZOS_STEPS, dim)):
        w = apply(basis[-1][:, None])[:, 0]
        alphas.append(float(basis[-1] @ w))
        for _ in range(2):  # twice is enough to stay orthogonal
            w -= np.array(basis).T @ (np.array(basis) @ w)
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= FLOOR * max(map(abs, alphas)):
            break
        basis.append(w / betas[-1])
    t = np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1) + np.diag(betas[: len(alphas) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - betas[-1])


def chebyshev(apply, x: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """The scaled Chebyshev filter that damps the spectrum in [low, high]; one application per degree."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    y = (apply(x) - middle * x) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        x, y = y, 2 * (apply(y) - middle * y) * (following / half) - sigma * following * x
        sigma = following
    return y


def rayleigh_ritz(apply, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values by falling size, their vectors and the norms of their residuals; one application."""
    image = apply(q)
    h = q.T @ image
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors = q @ turn
    return values, vectors, np.linalg.norm(image @ turn - vectors * values, axis=0)


def leading(apply, dim: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding level and their unit vectors, with certified residuals."""
    rng = np.random.default_rng(seed)
    wanted, width = min(wanted, dim), min(dim, 2 * wanted)
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    low = least_bound(apply, dim, rng) if width < dim else 0.0
    last, passes = np.inf, 0
    for _ in range(MAX_SWEEPS):
        values, vectors, residuals = rayleigh_ritz(apply, q)
        top = max(float(values[0]), 0.0)
        known = int((values[:wanted] > FLOOR * top).sum())
        worst = float(residuals[:known].max(initial=0.0))
        certified = worst <= RESIDUAL * top or (worst > last / 4 and worst <= FLOOR * top)
        if certified or width == dim:  # a block of all dimensions is exact
            return values[:known], vectors[:, :known]
        last = worst
        high = max(float(values[-1]), 1e-9 * top)
        floor = low if low < high else 0.0
        growth = np.arccosh(max(1.0, 1 + 2 * (values[known - 1] - high) / (high - floor)))
        need = np.log(worst / (RESIDUAL * top)) / max(growth, 1e-9)
        if passes + need > MAX_PASSES:
            width = min(dim, 2 * width)
            q = np.linalg.qr(np.hstack([vectors, rng.standard_normal((dim, width - vectors.shape[1]))]))[0]
            continue
        degree = int(np.clip(np.ceil(need) + 1, 2, MAX_DEGREE))
        passes += degree + 1
        q = np.linalg.qr(chebyshev(apply, vectors, degree, floor, high, top))[0]
    raise RuntimeError(f"leading eigenvectors were not certified in {MAX_SWEEPS} sweeps")


@dataclass
class Whitening:
    mean: Centre
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.mean.centred(x) @ (self.vectors / np.sqrt(self.values))


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, by one pass."""
    k, dim = len(model.values), len(model.mean.sums)
    names = [f"c{j}" for j in range(k)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for x in batch.column(0):
                w = model.apply(np.frombuffer(x.as_py(), "<i8").reshape(-1, dim))
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
        columns = [np.arange(k + 1, dtype=np.int32), *(np.ascontiguousarray(c) for c in total.T)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", *names])

    parts = blocks.select("x").mapInArrow(add, "i int, " + ", ".join(f"{c} double" for c in names))
    rows = sorted(parts.groupBy("i").agg(*(F.sum(c).alias(c) for c in names)).collect())  # components + 1 rows
    sums = np.array([r[1:] for r in rows]) / model.mean.n
    covariance = sums[:k] - np.outer(sums[k], sums[k])
    return float(np.abs(covariance - np.eye(k)).max())


def fit(blocks: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """Mean, components and eigenvalues of the blocks of one length."""
    blocks = blocks.filter(F.col("dim") == dim)
    mean = centre(blocks, dim)
    apply = Passes(blocks, mean)
    values, vectors = leading(apply, dim, components)
    model = Whitening(mean, vectors, values, values / apply.trace if len(values) else values)
    if len(values):
        model.identity_error = identity_error(blocks, model)
    return model


def whitened(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component."""
    vectors = integers(embeddings, id_col, vector_col)
    blocks = fit_list(vectors)
    # one model per length of vector; lengths are few
    models = {r.dim: fit(blocks, r.dim, components) for r in blocks.select("dim").distinct().collect()}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _matrices(batch.column("x")):
                model = models[x.shape[1]]
                k, n = len(model.values), len(rows)
                ids = batch.column("id").take(pa.array(np.repeat(rows, k)))
                deviation = pa.array(model.mean.deviations(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * k, model.mean.n, np.int64)),
                        deviation.take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array(model.apply(x).ravel()),
                        pa.array(np.tile(model.explained, n)),
                        pa.array(np.full(n * k, model.identity_error)),
                    ],
                    names=[c.split()[0] for c in RESULT.split(", ")],
                )

    return vectors.mapInArrow(project, RESULT)


def query(spark, sf_dir):
    return whitened(table(spark, sf_dir, "embeddings"))
