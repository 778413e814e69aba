"""Whitening of vectors of whole numbers: the leading principal components by Chebyshev-filtered subspace iteration.

The covariance V of the vectors is never formed.  A product V Q with a narrow block Q is one pass: each task centres
its rows X by the exact mean, adds up X^T (X Q), and Spark sums those tables of length x block numbers.  From a block of
several times the wanted components:

1. Rayleigh-Ritz: eigenvectors of Q^T V Q turn Q towards eigenvectors; the block's least value bounds the
   unwanted spectrum from above, as V has no negative values.
2. Certificate: done when |V q - e q| of each wanted vector is at the rounding of a product (``TOLERANCE``), or is
   below ``ENOUGH`` of its value e and falls no further.  A leading vector with ``APART`` times the value of the last wanted one
   is settled at ``SETTLED`` of its value, and kept out of the block from then on.
3. Else the three-term recurrence of the Chebyshev polynomial of the unwanted interval, a pass per degree, keeps unwanted
   directions below one and raises the others; QR makes the block orthonormal again.

The vectors are a table in the shared folder, read once per pass; only tables of length x block numbers come to the driver.
The mean is kept as whole quotient and remainder, so that centring x - S/n rounds once whatever the size of x.

Rows: null vectors and empty ones take no part.  Repeated rows and rows without an id count each for themselves.  Vectors of
different lengths have no covariance together: a ValueError.  There are as many components as asked for, at most the
length, and only those with more than ``RANK`` of the greatest variance: copies of one vector have none, and an empty
table, a single row or equal rows give an empty result.  Equal variances leave the choice of their components
open; signs are those of the larger sum of components.  Further columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

BLOCK = 6                # columns of the block for each wanted component
TOLERANCE, ENOUGH = 2e-15, 1e-11
SETTLED, APART = 1e-13, 4.0
RANK = 1e-9
DEGREE = 16              # of the filter, at most
SPREAD = 1e8             # between the gains of the greatest and the least wanted value in one filter
CYCLES = 60


@dataclass
class Moments:
    """Number of rows and exact sums per dimension."""

    n: int
    sums: list[int]

    @property
    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole part and rest of S / n."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self.mean
        return (x - whole).astype(float) - rest

    def deviation(self, x: np.ndarray) -> list[str]:
        """Sum over dimensions of (n x - S)^2 per row, exact, as decimal text."""
        if not len(x):
            return []
        whole = [s // self.n for s in self.sums]
        off = x - np.array(whole, np.int64)
        most = (int(np.abs(off).max()) + 1) * self.n
        kind = np.int64 if most * most * x.shape[1] < 1 << 63 else object
        rest = np.array([s - w * self.n for s, w in zip(self.sums, whole, strict=True)], kind)
        away = off.astype(kind) * self.n - rest
        return [str(s) for s in (away * away).sum(axis=1)]


@dataclass
class Components:
    """Unit eigenvectors (columns), their variances, the sum of all variances, and how they were found."""

    vectors: np.ndarray
    variances: np.ndarray
    total: float
    residual: float
    passes: int


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def moments(vectors: DataFrame) -> Moments | None:
    """Of a table with vectors of one length; None if it is empty."""
    sizes = [r[0] for r in vectors.select(F.size("vector")).distinct().limit(2).collect()]
    if len(sizes) > 1:
        raise ValueError("vectors of different lengths")
    if not sizes:
        return None
    length = sizes[0]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, np.int64)
        for batch in batches:
            x = _matrix(batch, length)
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(np.full(length, n)), pa.array(total)], ["at", "n", "total"])

    found = vectors.select("vector").mapInArrow(sums, "at long, n long, total long").groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("at").collect()
    return Moments(found[0]["n"], [r["total"] for r in found])


class Covariance:
    """Products with the covariance of a table's vectors; a pass each."""

    def __init__(self, vectors: DataFrame, of: Moments) -> None:
        self.vectors, self.of, self.passes, self.total = vectors, of, 0, 0.0

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        of, (length, width) = self.of, block.shape

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((length, width + 1))
            for batch in batches:
                x = of.centred(_matrix(batch, length))
                out[:, :width] += x.T @ (x @ block)
                out[:, width] += (x * x).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], ["at", "part"])

        parts = self.vectors.select("vector").mapInArrow(add, "at long, part double")
        found = parts.groupBy("at").agg(F.sum("part").alias("part")).toArrow()
        out = np.zeros(length * (width + 1))
        out[found["at"].to_numpy()] = found["part"].to_numpy()
        out = out.reshape(length, width + 1) / of.n
        self.passes, self.total = self.passes + 1, float(out[:, width].sum())
        return out[:, :width]


def filtered(v: Covariance, block: np.ndarray, done: np.ndarray, degree: int, high: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of [0, ``high``] in V, applied to the block and scaled to about one at ``top``; what is
    ``done`` stays out of it."""
    def shifted(x: np.ndarray) -> np.ndarray:
        out = v @ x
        return out - done @ (done.T @ out) - half * x

    half = high / 2
    first = scale = half / (top - half)
    before, now = block, shifted(block) * (scale / half)
    for _ in range(degree - 1):
        scale, old = 1 / (2 / first - scale), scale
        before, now = now, 2 * (scale / half) * shifted(now) - old * scale * before
    return now


def components(v: Covariance, k: int) -> Components:
    """The ``k`` leading eigenvectors, certified by their residuals."""
    length = len(v.of.sums)
    k, width = min(k, length), min(length, BLOCK * k)
    block = np.linalg.qr(np.random.default_rng(0).normal(size=(length, width)))[0]
    done, sizes, off, last = np.zeros((length, 0)), [], [], np.inf
    for _ in range(CYCLES):
        image = v @ block
        image -= done @ (done.T @ image)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residual = np.sqrt(((image - block * values) ** 2).sum(axis=0))
        top, need = max([values[0], *sizes]), k - len(sizes)
        wanted, rest = np.maximum(values[:need], 1e-300), residual[:need]
        none = (values[:need] <= RANK * top) & (rest <= RANK * top)
        worst = float((rest / wanted)[~none].max(initial=0))
        if (none | (rest <= TOLERANCE * np.sqrt(top * wanted))).all() or (worst <= ENOUGH and worst > last / 2):
            vectors = np.concatenate([done, block[:, :need][:, ~none]], axis=1)
            found, off = np.array([*sizes, *values[:need][~none]]), [*off, *rest[~none]]
            vectors = vectors / np.sqrt((vectors ** 2).sum(axis=0))
            signs = np.where(vectors.sum(axis=0) < 0, -1.0, 1.0)
            order = np.argsort(-found, kind="stable")
            return Components((vectors * signs)[:, order], found[order], v.total, max(off, default=0.0), v.passes)
        last = worst
        while need > 1 and values[0] > APART * values[need - 1] and residual[0] <= SETTLED * values[0]:
            done, sizes, off = np.concatenate([done, block[:, :1]], axis=1), [*sizes, values[0]], [*off, residual[0]]
            block, values, residual, need, last = block[:, 1:], values[1:], residual[1:], need - 1, np.inf
        high = max(values[-1], 1e-13 * top)
        gain = [np.arccosh(max(2 * x / high - 1, 1 + 1e-9)) for x in (values[0], values[need - 1])]
        even = np.log(SPREAD) / max(gain[0] - gain[1], 1e-9)
        block = filtered(v, block, done, int(np.clip(min(np.log(max(worst, 1e-9) / TOLERANCE) / gain[1], even), 2, DEGREE)), high, values[0])
        block = np.linalg.qr(block / np.sqrt((block ** 2).sum(axis=0)))[0]
    raise RuntimeError(f"no certified components: residual {last:.1e} of a variance")


@dataclass
class Whitened:
    """rows: vec_id, whitened (array of double), deviation (exact, decimal text)."""

    rows: DataFrame
    moments: Moments
    components: Components
    identity_error: float


def whiten(rows: DataFrame, k: int = 8) -> Whitened | None:
    """Projections of the centred vectors on their ``k`` leading components, over their deviations; None if there are none.

    rows: vec_id, vector (array of long, or null).
    """
    vectors = _kept(rows.where("vector IS NOT NULL AND size(vector) > 0").select("vec_id", "vector"), "vectors")
    of = moments(vectors)
    if of is None:
        return None
    found = components(Covariance(vectors, of), k)
    width = len(found.variances)
    if not width:
        return None
    turn = found.vectors / np.sqrt(found.variances)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, len(of.sums))
            y = of.centred(x) @ turn
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, y.size + 1, width), pa.int32()), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists, pa.array(of.deviation(x), pa.string())],
                                             ["vec_id", "whitened", "deviation"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    out = _kept(vectors.mapInArrow(project, f"vec_id {kind}, whitened array<double>, deviation string"), "whitened")
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    y = F.col("whitened")
    second = out.agg(*[F.covar_pop(y[i], y[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(second[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    return Whitened(out, of, found, float(error))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: a table in the shared folder."""
    spark: SparkSession = df.sparkSession
    place = scratch_path(spark, f"whitening-{name}")
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)
