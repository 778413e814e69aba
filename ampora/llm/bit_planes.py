"""Clustering around centroids with vectors of 64 integers kept as bit planes.

Plane i of a vector packs bit i of its 64 components into one 64-bit word; components are in two's complement, so
the top plane weighs -2^i and the others 2^i.  With p(x) the number of set bits, the product of a vector and a
centroid is the sum of weight_i * weight_j * p(plane_i & plane_j) over their planes, a whole number without rounding,
and the squared distance is |v|^2 - 2<v,c> + |c|^2.  The bits of each plane, counted by cluster, give the sums that
move the centroids.

Vectors are packed once, into a table in the shared folder.  A round is one pass over it: each task sends 64 sums
per cluster, Spark adds them up, and only the centroids come to the driver.  No vector is shuffled.

Rows: vectors that are null, or don't have 64 components, or hold null, NaN or infinite ones take no part.  Repeated rows
and rows without an id count each for themselves; rows without an id become first centroids only if too few others are there.
Of rows with one id, that with the smaller vector comes first.  Ties between centroids go to the smaller number.
A table with fewer vectors than centroids has fewer centroids; an empty one gives an empty result.  Further columns
aren't read.  Components must be whole and lie within +-2^27, so that distances fit 63 bits; others raise a ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

COMPONENTS = 64
LIMIT = 1 << 27
CHUNK = 2048             # vectors whose bits are laid out at once


def weights(planes: int) -> np.ndarray:
    """The value of a bit of each plane: powers of two, the last one negative."""
    w = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def pack(x: np.ndarray) -> np.ndarray:
    """(vectors, planes) words of (vectors, 64) whole numbers, with as many planes as the largest one needs."""
    if len(x) and max(int(x.max()), -int(x.min())) >= LIMIT:
        raise ValueError(f"components must lie within +-{LIMIT}")
    most = max(int(x.max()), -1 - int(x.min())) if len(x) else 0
    planes = most.bit_length() + 1
    words = np.empty((len(x), planes), np.uint64)
    for at in range(0, len(x), CHUNK):
        bits = (x[at:at + CHUNK, None, :] >> np.arange(planes)[:, None] & 1).astype(np.uint8)
        words[at:at + CHUNK] = np.packbits(bits, axis=2, bitorder="little").view("<u8")[:, :, 0]
    return words


def unpack(words: np.ndarray) -> np.ndarray:
    """The bits of planes: (vectors, planes, 64) of 0 and 1."""
    return np.unpackbits(words.astype("<u8").view(np.uint8).reshape(*words.shape, 8), axis=2, bitorder="little")


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the vectors behind two arrays of planes, by weighted counts of common bits."""
    out = np.zeros((len(left), len(right)), np.int64)
    other = weights(right.shape[1])
    for plane, weight in enumerate(weights(left.shape[1])):
        common = np.bitwise_count(left[:, plane, None, None] & right[None])
        out += weight * (common @ other)
    return out


def squares(words: np.ndarray) -> np.ndarray:
    """Squared length of each vector, from its own planes."""
    w = weights(words.shape[1])
    out = np.zeros(len(words), np.int64)
    for plane, weight in enumerate(w):
        out += weight * (np.bitwise_count(words[:, plane, None] & words) @ w)
    return out


class Centroids:
    """Centroids as planes; nearest ones of packed vectors."""

    def __init__(self, values: np.ndarray) -> None:
        self.words = pack(values)
        self.length = squares(self.words)

    def nearest(self, words: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of each vector; ties to the smaller number."""
        away = length[:, None] - 2 * products(words, self.words) + self.length
        cluster = away.argmin(axis=1)
        return cluster, away[np.arange(len(away)), cluster]


def _words(planes: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, planes) of packed vectors, by their number of planes."""
    sizes = planes.map(len).to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, np.frombuffer(b"".join(planes.iloc[rows]), "<u8").reshape(len(rows), size // 8).astype(np.uint64)


def packed(rows: DataFrame) -> DataFrame:
    """vec_id, planes (binary), length (squared): a table in the shared folder.  rows: vec_id, vector (array of long)."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = pack(np.array(b["vector"].tolist(), np.int64).reshape(len(b), COMPONENTS))
            yield pd.DataFrame({"vec_id": b["vec_id"], "planes": [w.tobytes() for w in words.astype("<u8")], "length": squares(words)})

    known = rows.where(F.col("vector").isNotNull() & (F.size("vector") == COMPONENTS)).select(F.col("vec_id").cast("long"), "vector")
    return _kept(known.mapInPandas(of, "vec_id long, planes binary, length long"), "planes")


def first_centroids(rows: DataFrame, order: Column, k: int) -> np.ndarray:
    """The ``k`` first vectors by ``order`` and then by their components."""
    known = rows.where(F.col("vector").isNotNull() & (F.size("vector") == COMPONENTS))
    taken = known.orderBy(order.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.array([r["vector"] for r in taken], np.int64).reshape(len(taken), COMPONENTS)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid that vectors are nearest to becomes the floor of their mean."""
    k = len(centroids)
    at = Centroids(centroids)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = np.zeros(k, np.int64), np.zeros((k, COMPONENTS), np.int64)
        for b in batches:
            for rows, words in _words(b["planes"]):
                cluster, _ = at.nearest(words, b["length"].to_numpy()[rows])
                count += np.bincount(cluster, minlength=k)
                value = weights(words.shape[1])
                for low in range(0, len(words), CHUNK):
                    member = (cluster[low:low + CHUNK, None] == np.arange(k)).astype(np.float32)
                    bits = unpack(words[low:low + CHUNK]).reshape(len(member), -1).astype(np.float32)
                    per_plane = (member.T @ bits).astype(np.int64).reshape(k, len(value), COMPONENTS)
                    total += (per_plane * value[:, None]).sum(axis=1)
        yield pd.DataFrame({"cluster": np.repeat(np.arange(k), COMPONENTS), "at": np.tile(np.arange(COMPONENTS), k),
                            "n": np.repeat(count, COMPONENTS), "total": total.ravel()})

    part = vectors.mapInPandas(sums, "cluster int, at int, n long, total long").where("n > 0")
    new = centroids.copy()
    for r in part.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r["cluster"], r["at"]] = r["total"] // r["n"]
    return new


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared) of packed vectors."""
    at = Centroids(centroids)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cluster, distance = np.zeros(len(b), np.int32), np.zeros(len(b), np.int64)
            for rows, words in _words(b["planes"]):
                cluster[rows], distance[rows] = at.nearest(words, b["length"].to_numpy()[rows])
            yield pd.DataFrame({"vec_id": b["vec_id"], "cluster": cluster, "distance": distance})

    return vectors.mapInPandas(of, "vec_id long, cluster int, distance long")


def clusters(rows: DataFrame, order: Column, k: int = 8, rounds: int = 10) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) after ``rounds`` moves of ``k`` centroids.

    rows: vec_id, vector (array of long, or null); the first centroids are the ``k`` first vectors by ``order``.
    Moves end early where no centroid changes any more, as the rest would change nothing.
    """
    spark = rows.sparkSession
    centroids = first_centroids(rows, order, k)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    vectors = packed(rows)
    for _ in range(rounds):
        before, centroids = centroids, moved(vectors, centroids)
        if (before == centroids).all():
            break
    found = _kept(assigned(vectors, centroids), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")
    inertia = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(exact.alias("inertia")).collect()}
    of = spark.createDataFrame([(i, inertia.get(i, 0), sum(inertia.values()), c.tolist()) for i, c in enumerate(centroids)],
                               "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(of), "cluster").select(*[f.name for f in RESULT])   # k rows


RESULT = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("cluster", T.IntegerType()),
                       T.StructField("distance", T.LongType()), T.StructField("cluster_inertia", T.LongType()),
                       T.StructField("inertia", T.LongType()), T.StructField("centroid", T.ArrayType(T.LongType()))])


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: a table in the shared folder."""
    spark: SparkSession = df.sparkSession
    place = scratch_path(spark, f"clusters-{name}")
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def digest(centroid: Column) -> Column:
    """Hex SHA-256 of a centroid's components as decimal numbers joined by commas."""
    return F.sha2(F.concat_ws(",", F.transform(centroid, lambda x: x.cast("string"))), 256)


def seed_order(vec_id: Column, seed: int = 3) -> Column:
    """Hex SHA-256 of ``<seed>:<vec_id>``: an order that doesn't depend on the rows' places."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256)
