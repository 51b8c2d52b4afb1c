"""Whitening of embeddings on principal components found by Jacobi-Davidson.

Entries become whole numbers ``floor(1024 * c) + 100000``, so that their sums are exact. The
covariance is never formed: a product with it is a pass over the centred vectors, ``X'(X v) / n``,
by tasks over blocks of vectors and a sum over tasks; a block of vectors v is multiplied in one
pass. The driver holds some dozens of vectors of the embeddings' dimension and nothing that grows
with the rows.

The search starts with a random block. In each round the Rayleigh-Ritz values of the search space
are taken; for each wanted pair (u, theta) the projected correction equation
``(I - QQ')(V - theta)(I - QQ') t = -r`` is solved by a few steps of MINRES, all pairs in step, one
pass a step; Q has the locked and the current vectors. The corrections widen the space, which is
cut back to its best vectors when it gets large. Leading pairs are locked once their residual is at
rounding level. One pair more than wanted is followed as a guard, so that no larger value is missed.

Defined cases: a vector that is null or holds a null or non-finite entry is left out, as is one
whose length isn't the most common one (the longest of several); entries beyond ``2**40`` count as
that; null and repeated ids stay, row by row; components without variance are left out, so that
equal vectors or an empty table give an empty result; a deviation beyond 64 bits is null; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradmesh.llm.common import written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
INNER, ROUNDS = 4, 200  # MINRES steps a round; rounds at most
BLOCK_BYTES = 1 << 21
EPS = float(np.finfo(np.float64).eps)

RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


# ---- vectors in blocks ---------------------------------------------------------------------

@dataclass
class Vectors:
    """Blocks ``ids, x`` (rows of 64-bit numbers), and what centring needs: ``floor`` is the whole
    part of the mean, ``rest / n`` what is missing to it."""

    blocks: DataFrame | None
    k: int
    n: int = 0
    floor: np.ndarray | None = None
    rest: list[int] | None = None

    def facts(self) -> Vectors:
        """What tasks get: all but the blocks."""
        return replace(self, blocks=None)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(np.float64) - np.array([r / self.n for r in self.rest])


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that can be used, entries as whole numbers."""
    given = rows.select(rows[id_col].cast("bigint").alias("vec_id"), rows[vector_col].cast("array<double>").alias("v")).where("v IS NOT NULL")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    given = given.where(F.coalesce(finite, F.lit(False)))
    common = given.groupBy(F.size("v").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).first()
    k = common["k"] if common else 0
    whole = F.transform("v", lambda c: F.floor(F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST)) * SCALE) + SHIFT)
    return given.where(F.size("v") == k).select("vec_id", whole.cast("array<bigint>").alias("x"))


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Vectors:
    whole = whole_vectors(rows, id_col, vector_col)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = len(b.column("x")[0]) if b.num_rows else 0
            step = max(1, min(4096, BLOCK_BYTES // (8 * max(k, 1))))
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i8")
                yield pa.RecordBatch.from_pydict({"ids": pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())), "x": pa.array([x.tobytes()], pa.binary())})

    blocks = written(whole.mapInArrow(pack, "ids array<bigint>, x binary"), "whitening-blocks").persist(StorageLevel.MEMORY_AND_DISK)
    first = blocks.select(F.size("ids").alias("n"), F.length("x").alias("bytes")).first()
    k = first["bytes"] // (8 * first["n"]) if first else 0
    found = Vectors(blocks, k)
    if not k:
        return found

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (k + 1)
        for x, _ in _matrices(batches, k):
            total = [a + b for a, b in zip(total, [*x.sum(axis=0).tolist(), len(x)], strict=True)]
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(k + 1), pa.int32()), "total": pa.array([str(v) for v in total])})

    summed = blocks.mapInArrow(add, "at int, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = {r["at"]: int(r["total"]) for r in summed.collect()}
    found.n = sums[k]
    found.floor = np.array([sums[j] // found.n for j in range(k)], np.int64)
    found.rest = [sums[j] % found.n for j in range(k)]
    return found


def _matrices(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[np.ndarray, list]]:
    for b in batches:
        for ids, x in zip(b.column("ids"), b.column("x"), strict=True):
            yield np.frombuffer(x.as_buffer(), "<i8").reshape(-1, k), ids


def reduced(found: Vectors, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all blocks of ``part(centred block)``: one row a task, summed by Spark."""

    facts = found.facts()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for x, _ in _matrices(batches, facts.k):
            total += part(facts.centred(x))
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.ravel()], pa.list_(pa.float64()))})

    parts = found.blocks.mapInArrow(run, "part array<double>").select(F.posexplode("part").alias("at", "v"))
    out = np.zeros(shape[0] * shape[1])
    for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out.reshape(shape)


# ---- Jacobi-Davidson -----------------------------------------------------------------------

def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of ``apply(x) = b``, column by column in step; ``apply`` takes them
    all at once and is symmetric in each."""
    tiny = np.finfo(np.float64).tiny
    beta = np.linalg.norm(b, axis=0)
    x, v0, v = np.zeros_like(b), np.zeros_like(b), b / np.maximum(beta, tiny)
    w0, w1 = np.zeros_like(b), np.zeros_like(b)
    c0, c1, s0, s1 = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    eta, beta = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        av = apply(v)
        alpha = (v * av).sum(axis=0)
        v2 = av - alpha * v - beta * v0
        beta2 = np.linalg.norm(v2, axis=0)
        delta = c1 * alpha - c0 * s1 * beta
        rho1, rho2, rho3 = np.hypot(delta, beta2), s1 * alpha + c0 * c1 * beta, s0 * beta
        live = rho1 > tiny
        rho1 = np.where(live, rho1, 1.0)
        c0, s0, c1, s1 = c1, s1, delta / rho1, beta2 / rho1
        w0, w1 = w1, (v - rho3 * w0 - rho2 * w1) / rho1
        x += np.where(live, c1 * eta, 0.0) * w1
        eta = -s1 * eta
        v0, v, beta = v, v2 / np.maximum(beta2, tiny), beta2
    return x


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to orthonormal columns; twice is enough."""
    norm = np.linalg.norm(new, axis=0)
    new = new[:, norm > 0] / norm[norm > 0]
    for _ in range(2):
        for q in against:
            new = new - q @ (q.T @ new)
        if not new.shape[1]:
            return new
        left, size, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, size > 1e-10]
    return new


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], k: int, wanted: int, inner: int = INNER, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric positive operator, with unit vectors and
    residual norms."""
    wanted = min(wanted, k)
    guarded = min(wanted + 1, k)
    most = max(6 * guarded, 24)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((k, 0)), []
    space = _orthonormal(rng.standard_normal((k, guarded)))
    image = product(space)
    largest, before = 0.0, np.inf
    for _ in range(ROUNDS):
        theta, y = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        y = y[:, ::-1]
        theta, ritz, ritz_image = theta[::-1], space @ y, image @ y
        largest = max(largest, *theta[:1], *values[:1])
        need = guarded - len(values)
        r = ritz_image[:, :need] - ritz[:, :need] * theta[:need]
        r -= locked @ (locked.T @ r)
        norms = np.linalg.norm(r, axis=0)
        whole = locked.shape[1] + space.shape[1] >= k  # nothing is left to add
        level = 4 * EPS * np.sqrt(k) * largest
        worst = norms.max(initial=0.0)
        if worst <= 1e-12 * largest and worst > before / 2:
            level = max(level, worst)  # rounding of the products: no further fall
        before = worst
        take = 0
        while take < need and (whole or norms[take] <= level or (len(values) + take >= wanted and norms[take] <= 1e-3 * largest)):
            take += 1
        locked, values = np.hstack([locked, ritz[:, :take]]), [*values, *theta[:take]]
        if len(values) >= guarded:
            break
        need, r = need - take, r[:, take:]
        shift = theta[take : take + need]
        keep = slice(take, None if space.shape[1] - take + need <= most else take + 2 * guarded)
        space, image = ritz[:, keep], ritz_image[:, keep]
        q = np.hstack([locked, ritz[:, take : take + need]])

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - q @ (q.T @ t)  # noqa: B023
            t = product(t) - t * shift  # noqa: B023
            return t - q @ (q.T @ t)  # noqa: B023

        new = _orthonormal(minres(projected, -r, inner), locked, space)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((k, 1)), locked, space)
        if new.shape[1]:
            space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    locked, _ = np.linalg.qr(locked)
    image = product(locked)
    theta, y = np.linalg.eigh((locked.T @ image + image.T @ locked) / 2)
    y, theta = y[:, ::-1][:, :wanted], theta[::-1][:wanted]
    found = locked @ y
    return theta, found, np.linalg.norm(image @ y - found * theta, axis=0)


# ---- the operator --------------------------------------------------------------------------

@dataclass
class Whitening:
    values: np.ndarray
    vectors: np.ndarray  # a column a component
    residuals: np.ndarray
    trace: float

    @property
    def map(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(found: Vectors, components: int = COMPONENTS) -> Whitening:
    """The components with variance, at most ``components``."""
    n, k = found.n, found.k
    trace = float(reduced(found, lambda x: (x * x).sum(axis=0)[None, :], (1, k)).sum() / n)

    def product(block: np.ndarray) -> np.ndarray:
        return reduced(found, lambda x: x.T @ (x @ block), block.shape) / n

    if trace <= 0:
        return Whitening(np.zeros(0), np.zeros((k, 0)), np.zeros(0), trace)
    values, vecs, residuals = jacobi_davidson(product, k, components)
    varies = values > 64 * EPS * trace
    return Whitening(values[varies], vecs[:, varies], residuals[varies], trace)


def _deviations(found: Vectors, x: np.ndarray) -> list[int | None]:
    """Sum over dimensions of ``(n * x - S)**2``, exactly; None beyond 64 bits."""
    off = x - found.floor
    most = (int(np.abs(off).max(initial=0)) + 1) * found.n
    if found.k * most * most < 1 << 63:
        d = off * found.n - np.array(found.rest, np.int64)
        return (d * d).sum(axis=1).tolist()
    each = ([int(v) * found.n - r for v, r in zip(row, found.rest, strict=True)] for row in off)
    return [s if s < 1 << 63 else None for s in (sum(v * v for v in row) for row in each)]


def whitened(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row that
    can be used and every component."""
    found = vectors(rows, id_col, vector_col)
    try:
        model = fit(found, components) if found.n else None
        if model is None or not len(model.values):
            return rows.sparkSession.createDataFrame([], RESULT)
        to, p, n = model.map, len(model.values), found.n
        both = reduced(found, lambda x: np.vstack([(z := x @ to).T @ z, z.sum(axis=0)]), (p + 1, p)) / n
        error = float(np.abs(both[:p] - np.outer(both[p], both[p]) - np.eye(p)).max())
        explained = (model.values / model.trace).tolist()
        facts = found.facts()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, ids in _matrices(batches, facts.k):
                m = len(x)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": pa.array([i for i in ids.as_py() for _ in range(p)], pa.int64()),
                    "component": pa.array(np.tile(np.arange(1, p + 1, dtype=np.int32), m)),
                    "n": pa.array(np.full(m * p, n, np.int64)),
                    "deviation": pa.array([d for d in _deviations(facts, x) for _ in range(p)], pa.int64()),
                    "whitened": pa.array((facts.centred(x) @ to).ravel()),
                    "explained": pa.array(np.tile(explained, m)),
                    "identity_error": pa.array(np.full(m * p, error)),
                })

        return written(found.blocks.mapInArrow(run, RESULT), "whitened")
    finally:
        found.blocks.unpersist()
