"""Embedding whitening by the leading eigenvectors of the covariance, found by Chebyshev-filtered subspace iteration.

The covariance V is never formed: one pass over the staged blocks gives VQ for a thin block Q as the sum of XᵀXQ over
centred rows. A polynomial recurrence of such passes damps the unwanted part [a, b] of the spectrum (a from a few Lanczos
steps, b from the block's smallest Ritz value), QR and Rayleigh-Ritz turn the block to the eigenvectors, and rounds go on
until every wanted residual is at the level of double rounding and a fresh random block, filtered in the complement of
what was found, shows nothing larger. The driver holds blocks of dimension times width only.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlab.llm.common import staged

COMPONENTS = 32
#: Vectors in the block beyond the wanted ones, degree of the filter, Lanczos steps, vectors of the last probe.
GUARD = 16
DEGREE = 10
LANCZOS = 12
PROBE = 4
#: Residuals of the wanted vectors, as shares of the largest eigenvalue: aimed at, and enough if rounding allows no less.
AIM, ENOUGH = 2e-14, 1e-11
ROUNDS = 60
#: Eigenvalues below this share of the largest one belong to no direction of the vectors.
LEAST_SHARE = 1e-10
#: x = floor(SCALE * c) + SHIFT, held within +-MOST.
SCALE, SHIFT, MOST = 64.0, 1_000_000, 9.2e18
#: Bytes of a block of vectors.
BLOCK_BYTES = 2 << 20

BLOCKS = pa.schema([("ids", pa.list_(pa.int64())), ("values", pa.binary())])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of vectors without null, NaN or infinite entries, of the length that most of them have."""
    entry = "embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).filter(entry)
    size = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.col("count").desc(), "size").limit(1)
    # One row.
    return rows.join(F.broadcast(size.select("size")), F.size("embedding") == F.col("size"))


def vector_blocks(vectors: DataFrame) -> DataFrame:
    """The vectors as whole numbers, in blocks of bounded bytes."""
    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dim = batch.column("size")[0].as_py()
            ids = batch.column("vec_id")
            flat = batch.column("embedding").flatten().to_numpy()
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(SCALE * flat), -MOST, MOST).astype(np.int64).reshape(-1, dim) + SHIFT
            step = max(1, BLOCK_BYTES // (8 * dim))
            for k in range(0, len(x), step):
                yield pa.RecordBatch.from_pydict({"ids": pa.array([ids[k : k + step].to_pylist()], pa.list_(pa.int64())), "values": [x[k : k + step].tobytes()]}, schema=BLOCKS)

    return staged(usable(vectors).mapInArrow(cut, "ids array<long>, values binary"), "vectors")


def read_blocks(batches, dim: int):
    for batch in batches:
        for ids, values in zip(batch.column("ids"), batch.column("values")):
            yield ids.values, np.frombuffer(values.as_buffer(), np.int64).reshape(-1, dim)


def whole_sum(x: np.ndarray) -> list[int]:
    """Column sums of whole numbers, exact."""
    if np.abs(x.astype(float)).max(initial=0.0) * max(len(x), 1) < 2.0**62:
        return [int(v) for v in x.sum(axis=0)]
    return [sum(map(int, column)) for column in x.T]


def exact_sums(blocks: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension."""
    schema = pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])

    def add(batches):
        for batch in batches:
            for ids, values in zip(batch.column("ids"), batch.column("values")):
                n = len(ids.values)
                x = np.frombuffer(values.as_buffer(), np.int64).reshape(n, -1)
                yield pa.RecordBatch.from_pydict({"dim": range(x.shape[1]), "n": [n] * x.shape[1], "total": [Decimal(v) for v in whole_sum(x)]}, schema=schema)

    found = blocks.mapInArrow(add, "dim int, n long, total decimal(38,0)").groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect()
    return (found[0]["n"], [int(r["total"]) for r in found]) if found else (0, [])


class Centred:
    """Centred rows of a block: the whole part of the mean is taken off exactly, then the rest of it."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.dim = n, len(sums)
        self.whole = [s // n for s in sums]
        self.rest = np.array([s - n * w for s, w in zip(sums, self.whole)], np.int64)

    def off(self, x: np.ndarray) -> np.ndarray:
        """x minus the whole part of the mean, in longs while none can leave their range."""
        whole = np.array(self.whole, np.int64)
        if max(np.abs(x.astype(float)).max(initial=0.0), np.abs(whole.astype(float)).max(initial=0.0)) < 2.0**62:
            return x - whole
        return x.astype(object) - whole.astype(object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.off(x).astype(float) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum of (n * x - S)^2 of every row, exact, held at the end of the long range."""
        u = self.off(x)
        if u.dtype != object and (np.abs(u.astype(float)).max(initial=0.0) + 1) ** 2 * float(self.n) ** 2 * self.dim < 2.0**62:
            return ((self.n * u - self.rest) ** 2).sum(axis=1)
        exact = ((self.n * u.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return np.array([min(int(v), 2**63 - 1) for v in exact], np.int64)


def summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], height: int, width: int, dim: int) -> np.ndarray:
    """The sum over all blocks of a matrix (height, width) that ``part`` makes of a block's whole numbers."""
    def run(batches):
        total = np.zeros((height, width))
        for _, x in read_blocks(batches, dim):
            total += part(x)
        yield pa.RecordBatch.from_pydict({"row": pa.array(range(height), pa.int32()), "value": pa.array(list(total), pa.list_(pa.float64()))})

    sums = blocks.mapInArrow(run, "row int, value array<double>").groupBy("row").agg(F.array(*[F.sum(F.col("value")[k]) for k in range(width)]).alias("value"))
    out = np.zeros((height, width))
    for r in sums.collect():  # height rows
        out[r["row"]] = r["value"]
    return out


def covariance_times(spark: SparkSession, blocks: DataFrame, centre: Centred) -> Callable[[np.ndarray], np.ndarray]:
    """The pass Q -> VQ; divided by n before the sum leaves a task."""
    def times(q: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(q)

        def part(x):
            rows = centre.rows(x)
            return rows.T @ (rows @ sent.value) / centre.n

        out = summed(blocks, part, centre.dim, q.shape[1], centre.dim)
        sent.unpersist()
        return out

    return times


def lowest(times, dim: int, rng: np.random.Generator) -> float:
    """About the smallest eigenvalue, from below: the smallest Ritz value of a few Lanczos steps less its residual."""
    q = rng.standard_normal(dim)
    basis = [q / np.linalg.norm(q)]
    alphas, betas = [], []
    for _ in range(min(LANCZOS, dim)):
        w = times(basis[-1][:, None])[:, 0]
        alphas.append(w @ basis[-1])
        for _ in range(2):
            for b in basis:
                w = w - (w @ b) * b
        betas.append(np.linalg.norm(w))
        if betas[-1] <= 1e-12 * max(alphas):
            break
        basis.append(w / betas[-1])
    t = np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1) + np.diag(betas[: len(alphas) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, values[0] - betas[-1] * abs(vectors[-1, 0]))


def damped(times, q: np.ndarray, vq: np.ndarray | None, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The block under the Chebyshev polynomial that stays small on [low, high] and is scaled to 1 at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2
    first = sigma = half / (top - middle)
    before, now = q, ((times(q) if vq is None else vq) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (times(now) - middle * now) * (2 * following / half) - (sigma * following) * before
        sigma = following
    return now


def rayleigh_ritz(times, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values from the largest down, their vectors, and V times them."""
    vq = times(q)
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def leading(times, dim: int, wanted: int, degree: int = DEGREE, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, from the largest down, and their unit vectors as columns."""
    rng = np.random.default_rng(seed)
    width = min(dim, wanted + GUARD)
    wanted = min(wanted, dim)
    values, u, vu = rayleigh_ritz(times, np.linalg.qr(rng.standard_normal((dim, width)))[0])
    if width == dim or values[0] <= 0:
        return np.maximum(values[:wanted], 0), u[:, :wanted]
    low, best, still = lowest(times, dim, rng), np.inf, 0
    for _ in range(ROUNDS):
        low = min(low, max(values[-1], 0.0))
        # Below LEAST_SHARE there are no components, so an interval that small only has to have a width.
        high = max(values[-1], low + 0.1 * (values[wanted - 1] - low), low + 0.1 * LEAST_SHARE * values[0])
        residual = np.linalg.norm(vu[:, :wanted] - u[:, :wanted] * values[:wanted], axis=0).max() / values[0]
        still = 0 if residual < best / 2 else still + 1
        best = min(best, residual)
        if residual <= AIM or (still >= 3 and residual <= ENOUGH):
            missed = probe(times, u[:, :wanted], low, high, values, degree, rng)
            if missed is None:
                return np.maximum(values[:wanted], 0), u[:, :wanted]
            u = np.linalg.qr(np.concatenate([u[:, : width - PROBE], missed], axis=1))[0]
            values, u, vu = rayleigh_ritz(times, u)
            best, still = np.inf, 0
            continue
        q = np.linalg.qr(damped(times, u, vu, low, high, values[0], degree))[0]
        values, u, vu = rayleigh_ritz(times, q)
    raise RuntimeError(f"eigenvectors aren't certified after {ROUNDS} rounds: residual {best:.2g}")


def probe(times, found: np.ndarray, low: float, high: float, values: np.ndarray, degree: int, rng: np.random.Generator) -> np.ndarray | None:
    """Vectors that a filtered random block finds beyond what was found, if one is larger than the last of these."""
    def off(q):
        for _ in range(2):
            q = q - found @ (found.T @ q)
        return np.linalg.qr(q)[0]

    more = off(rng.standard_normal((len(found), min(PROBE, len(found) - found.shape[1]))))
    most, q, _ = rayleigh_ritz(times, off(damped(times, more, None, low, high, values[0], degree)))
    return q if most[0] > values[found.shape[1] - 1] * (1 + 1e-9) + 0.1 * LEAST_SHARE * values[0] else None


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    Entries become x = floor(64 * c) + 1000000 (held within +-9.2e18). Vectors that are null, empty or hold null, NaN or
    infinite entries take no part, nor do vectors of another length than most have (ties: the shorter). Rows without
    vec_id and repeated rows are vectors like others. There are fewer components where the vectors span fewer directions,
    and no rows for an empty table or equal vectors only. ``deviation`` is exact up to the end of the long range. Other
    columns play no part.
    """
    spark = vectors.sparkSession
    blocks = vector_blocks(vectors)
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, sums = exact_sums(blocks)
    if not n:
        return spark.createDataFrame([], shape)
    centre = Centred(n, sums)
    trace = summed(blocks, lambda x: np.array([[np.square(centre.rows(x)).sum() / n]]), 1, 1, centre.dim)[0, 0]
    values, u = leading(covariance_times(spark, blocks, centre), centre.dim, components)
    real = values > LEAST_SHARE * max(values[0], np.finfo(float).tiny)
    values, u = values[real], u[:, real]
    k = len(values)
    if not k or trace <= 0:
        return spark.createDataFrame([], shape)
    turn = spark.sparkContext.broadcast(u / np.sqrt(values))

    def moments(x):
        """Sums and products of the whitened rows."""
        w = centre.rows(x) @ turn.value
        return np.concatenate([w.T @ w, w.sum(axis=0)[None]]) / n

    found = summed(blocks, moments, k + 1, k, centre.dim)
    error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())

    def project(batches):
        for ids, x in read_blocks(batches, centre.dim):
            deviation, whitened = centre.deviation(x), centre.rows(x) @ turn.value
            step = max(1, 65_536 // k)
            for first in range(0, len(x), step):
                m = len(x[first : first + step])
                rows = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids.slice(first, m).take(pa.array(rows)), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    "n": np.full(m * k, n, np.int64), "deviation": deviation[first : first + m][rows],
                    "whitened": whitened[first : first + m].ravel(), "explained": np.tile(values / trace, m), "identity_error": np.full(m * k, error)})

    return blocks.mapInArrow(project, shape)
