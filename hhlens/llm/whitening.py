"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers x = floor(1024 c) + 100000, kept as packed row blocks in the
shared folder together with exact column sums; every later number is taken from the centred
rows y = x - mean, so the large offset never enters a product.

Each step is one pass over the blocks: p = Y q for the step's direction q, and the sums
p.p, U'p (against all earlier left vectors) and Y'p.  Both sides are reorthogonalised in
full.  A left vector u_j has one entry per row; it lies in the column space of Y, so it is
held as its coefficients m_j (u_j = Y m_j) and each task recomputes its rows of it: nothing
as long as the table is stored or collected, and a lost executor costs a re-read.  Sums meet
per position of the sum vector, so no task and no driver holds one row per task.

With Y V = U B, the singular values of the small bidiagonal B give the components' variances
and its right singular vectors, carried by V, the components.  The steps end when the wanted
triplets have converged AND the variance outside V is below the least wanted one, so that
no further component (nor a copy of an equal one) can be missing; at the latest when V is
complete.  An exhausted direction is followed by a fresh one, orthogonal to all before.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite entry are left
out, as are vectors of another length than the most frequent one (ties: the longer); entries
beyond +-2^42 count as +-2^42; repeated rows and null ids count like any other; components
without variance are not returned, so one distinct vector (or none) gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

SCALE, SHIFT = 1024, 100_000          # fixed values of the contract
BOUND = 1 << 52                       # largest |floor(1024 c)|
COMPONENTS = 8
BLOCK_ROWS = 4096
EPS = float(np.finfo(float).eps)
RANK_TOL = 1e-10                      # singular values below this share of the largest are zero


@dataclass
class Blocks:
    """Packed rows (n, wide, x, ids, hi, lo), their count, length and exact column sums."""
    rows: DataFrame
    n: int
    dim: int
    sums: list[int]

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole quotient and remainder of sums / n (exact)."""
        pairs = [divmod(s, self.n) for s in self.sums]
        return np.array([q for q, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int64)


@dataclass
class Whitening:
    """Components (rows of ``axes``), their variances, the total variance and the check."""
    blocks: Blocks
    axes: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float
    steps: int


def pack(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> Blocks:
    """The usable vectors of ``df`` as blocks of whole numbers in the shared folder."""
    v = F.col("v")
    fine = F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))),
                      F.lit(False)) & (F.size(v) > 0)
    rows = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).where(fine)
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = top["d"] if top else 0
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                b = whole.slice(at, BLOCK_ROWS)
                c = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(SCALE * c), -BOUND, BOUND).astype(np.int64) + SHIFT
                wide = bool(np.abs(x).max() >= 1 << 31)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.num_rows], pa.int32()), pa.array([wide]),
                     pa.array([x.astype("<i8" if wide else "<i4").tobytes()], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("k")),
                     pa.array([(x >> 26).sum(axis=0)], pa.list_(pa.int64())),
                     pa.array([(x & ((1 << 26) - 1)).sum(axis=0)], pa.list_(pa.int64()))],
                    names=["n", "wide", "x", "ids", "hi", "lo"])

    packed = cut_lineage(rows.where(F.size("v") == dim).mapInArrow(
        run, f"n int, wide boolean, x binary, ids array<{key_type}>, hi array<bigint>, lo array<bigint>"))
    n = packed.agg(F.sum("n")).first()[0] or 0
    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    got = packed.select(F.posexplode(F.arrays_zip("hi", "lo"))).select("pos", "col.*").groupBy("pos").agg(
        big("hi"), big("lo")).collect()
    return Blocks(packed, n, dim, [(int(r.hi) << 26) + int(r.lo) for r in sorted(got)])


def _whole(row_x: bytes, wide: bool, dim: int, base: np.ndarray) -> np.ndarray:
    """Rows of a block less the whole part of the mean, exactly."""
    return np.frombuffer(row_x, "<i8" if wide else "<i4").reshape(-1, dim) - base


def _blocks_of(batches: Iterator[pa.RecordBatch], dim: int, base: np.ndarray, rest: np.ndarray):
    for b in batches:
        for x, wide in zip(b.column("x"), b.column("wide")):
            yield _whole(x.as_buffer(), wide.as_py(), dim, base) - rest


def _sums(blocks: Blocks, measure, width: int) -> np.ndarray:
    """Sum over all blocks of ``measure(centred rows)``, ``width`` numbers."""
    base, r = blocks.centre()
    rest, dim = r / blocks.n, blocks.dim

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for y in _blocks_of(batches, dim, base, rest):
            total += measure(y)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["s"])

    got = blocks.rows.select("x", "wide").mapInArrow(part, "s array<double>").select(F.posexplode("s")).groupBy(
        "pos").agg(F.sum("col").alias("s")).collect()
    return np.array([r.s for r in sorted(got)])


def _fresh(rng, basis: np.ndarray) -> np.ndarray:
    """A unit vector orthogonal to the orthonormal columns of ``basis``."""
    while True:
        v = rng.standard_normal(len(basis))
        size = np.linalg.norm(v)
        for _ in range(3):
            v -= basis @ (basis.T @ v)
        if np.linalg.norm(v) > 1e-6 * size:
            return v / np.linalg.norm(v)


def bidiagonalise(blocks: Blocks, components: int = COMPONENTS, seed: int = 1
                  ) -> tuple[np.ndarray, np.ndarray, float]:
    """(V, B, total): orthonormal columns V and bidiagonal B with Y V = U B for some orthonormal
    U, and the sum of squares of Y.  See the module's description for when the steps end."""
    d, rng = blocks.dim, np.random.default_rng(seed)
    v_all, m_all, back = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))   # V, M, Y'U
    alphas, betas, total = [], [], None
    v, beta = _fresh(rng, v_all), 0.0
    for k in range(d):
        q = v - beta * m_all[:, -1] if k else v
        a = np.column_stack([m_all, q])

        def measure(y, a=a, first=not k):
            u = y @ a
            p = u[:, -1]
            return np.concatenate([p @ u, p @ y, [np.vdot(y, y) if first else 0.0]])

        s = _sums(blocks, measure, k + 1 + d + 1)
        h, pp, g = s[:k], s[k], s[k + 1:-1]
        total = s[-1] if not k else total
        if not total:
            return np.zeros((d, 0)), np.zeros((0, 0)), 0.0
        tiny = 64 * EPS * np.sqrt(total)
        alpha = float(np.sqrt(max(pp - h @ h, 0.0)))
        v_all = np.column_stack([v_all, v])
        if alpha > tiny:
            m_all = np.column_stack([m_all, (q - m_all @ h) / alpha])
            w = (g - back @ h) / alpha
        else:                                   # Y v lies in the span of the earlier left vectors
            alpha, w = 0.0, np.zeros(d)
            m_all = np.column_stack([m_all, w])
        back = np.column_stack([back, w])
        alphas.append(alpha)
        z = w - alpha * v
        for _ in range(2):
            z = z - v_all @ (v_all.T @ z)
        beta = float(np.linalg.norm(z))
        if k + 1 == d:
            break
        b = np.diag(alphas) + np.diag(betas, 1)
        left, sigma, _ = np.linalg.svd(b)
        want = min(components, d)
        if k + 1 >= want:
            outside = total - (b * b).sum()
            loose = beta * np.abs(left[-1, :want]).max()
            if loose <= EPS * sigma[0] and outside < sigma[want - 1] ** 2:
                break
        if beta > tiny:
            v = z / beta
        else:
            beta, v = 0.0, _fresh(rng, v_all)
        betas.append(beta)
    return v_all, np.diag(alphas) + np.diag(betas, 1), float(total)


def fit(df: DataFrame, components: int = COMPONENTS, vector: str = "embedding",
        key: str = "vec_id", seed: int = 1) -> Whitening:
    """Components of the usable vectors of ``df`` by falling variance (divisor n), each with
    its entry of largest size positive, and the largest entry by which the whitened rows'
    covariance misses the identity (one more pass)."""
    blocks = pack(df, vector, key)
    if not blocks.n:
        return Whitening(blocks, np.zeros((0, blocks.dim)), np.zeros(0), 0.0, 0.0, 0)
    v, b, total = bidiagonalise(blocks, components, seed)
    _, sigma, right = np.linalg.svd(b)
    keep = [i for i in range(min(components, len(sigma))) if sigma[i] > RANK_TOL * sigma[0]]
    axes = right[keep] @ v.T
    axes /= np.linalg.norm(axes, axis=1, keepdims=True)
    if len(axes):
        axes *= np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
    var = sigma[keep] ** 2 / blocks.n
    model = Whitening(blocks, axes, var, total / blocks.n, 0.0, len(b))
    if len(axes):
        c, to = len(axes), (axes / np.sqrt(var)[:, None]).T

        def measure(y):
            w = y @ to
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

        s = _sums(blocks, measure, c + c * c) / blocks.n
        cov = s[c:].reshape(c, c) - np.outer(s[:c], s[:c])
        model.identity_error = float(np.abs(cov - np.eye(c)).max())
    return model


def transform(model: Whitening, key: str = "vec_id") -> DataFrame:
    """One row per fitted vector: the key, its whitened entries (array<double>, one per
    component) and ``deviation``, the exact sum over dimensions of (n x - S)^2 as a decimal
    (null beyond 38 digits)."""
    blocks = model.blocks
    key_type = blocks.rows.schema["ids"].dataType.elementType.simpleString()
    schema = f"k {key_type}, whitened array<double>, deviation string"
    if not len(model.axes):
        return blocks.rows.sparkSession.createDataFrame([], schema).select(
            F.col("k").alias(key), "whitened", F.col("deviation").cast("decimal(38,0)").alias("deviation"))
    base, r = blocks.centre()
    n, dim, rest = blocks.n, blocks.dim, r / blocks.n
    to = (model.axes / np.sqrt(model.variances)[:, None]).T
    tail, r_obj = sum(int(x) ** 2 for x in r), r.astype(object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, wide, ids in zip(b.column("x"), b.column("wide"), b.column("ids")):
                z = _whole(x.as_buffer(), wide.as_py(), dim, base)
                w = (z - rest) @ to
                # sum (n z - r)^2 = n^2 sum z^2 - 2 n sum z r + sum r^2, in whole numbers
                small = int(np.abs(z).max()) * max(n, int(np.abs(z).max())) * dim < 1 << 62
                zi, ri = (z, r) if small else (z.astype(object), r_obj)
                dev = [str(n * n * int(a) - 2 * n * int(c) + tail) for a, c in zip((zi * zi).sum(axis=1), zi @ ri)]
                flat = pa.array(w.ravel())
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.ListArray.from_arrays(
                        pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), flat), pa.array(dev)],
                    names=["k", "whitened", "deviation"])

    out = blocks.rows.select("x", "wide", "ids").mapInArrow(run, schema)
    return out.select(F.col("k").alias(key), "whitened",
                      F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"))
