"""Approximate nearest neighbours by inner product: learned partitions of a neighbour graph.

Fit, on a bounded sample (``SAMPLE`` rows, those with the smallest hashes of their ids; the only rows that come to the driver):

1. Graph: each of two thirds of the sample is linked to its ``NEAR`` nearest ones.
2. Partition: the graph is cut in two equal halves again and again, by the second eigenvector of its
   normalised adjacency, then by swaps of pairs that lessen the links cut.
3. Index classifier: softmax regression that learns a vector's part, so that rows outside the sample have one.
4. Router: softmax regression that learns how a vector's neighbours are spread over the parts.
5. Share: the last third are fresh queries and candidates; the least share of the router's probability whose parts
   hold ``TARGET`` of their neighbours is what queries are routed to.

Every row is indexed by 3.  Every query goes to its most probable parts until their probability reaches that share and they
hold more than ``k`` points.  Parts are searched whole: a block of queries of neighbouring parts meets, in one task, a shard of
neighbouring parts (or of one large part), both of bounded size, and hands on each query's best.  They are ranked by the product of the original components in double precision, added from left to right.  Equal vectors are one
point that stands for its smallest ids, so a vector that a third of all rows hold costs no more than others; a group of near
copies is spread over parts by 2 and over shards after that.

Rows: those with a null id, or a vector that is null, empty, zero, or holds null, NaN or infinite components take no part.
Vectors of different lengths have no product; each length has an index of its own, for at most ``LENGTHS`` of them (more: a
ValueError).  Ties go to smaller ids.  Repeated rows count once; rows with the query's id aren't its candidates;
an id with several vectors asks with each.  Further columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

SAMPLE, NEAR = 12_288, 20
PART, PARTS, LEAST = 512, 128, 48        # rows per part, parts at most, sample rows per part at least
TARGET = 0.95
BLOCK, QUERY_BLOCK, SHARD = 4096, 512, 65_536
LENGTHS = 64


def neighbours(queries: np.ndarray, points: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` other points with the largest products; queries are the first of the points."""
    k = min(k, len(points) - 1)
    out = np.empty((len(queries), k), np.int64)
    for at in range(0, len(queries), 512):
        score = queries[at:at + 512] @ points.T
        score[np.arange(len(score)), np.arange(at, at + len(score))] = -np.inf
        out[at:at + 512] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def halved(a: np.ndarray, b: np.ndarray, n: int, first: int, rng: np.random.Generator) -> np.ndarray:
    """Which of ``n`` vertices are in a first part of ``first``, such that few links (a, b) join both; links in both directions."""
    degree = np.maximum(np.bincount(a, minlength=n), 1.0)
    root = np.sqrt(degree)
    even, x = root / np.linalg.norm(root), rng.normal(size=n)
    for _ in range(60):
        x = x + np.bincount(a, weights=x[b] / root[b], minlength=n) / root
        x -= (x @ even) * even
        x /= max(np.linalg.norm(x), 1e-300)
    side = np.zeros(n, bool)
    side[np.argsort(x / root, kind="stable")[:first]] = True
    cut = int((side[a] != side[b]).sum())
    for _ in range(20):
        gain = np.bincount(a, weights=np.where(side[a] != side[b], 1.0, -1.0), minlength=n)
        ins, outs = (np.flatnonzero(s) for s in (side, ~side))
        ins, outs = (rows[np.argsort(-gain[rows], kind="stable")] for rows in (ins, outs))
        pairs = min(len(ins), len(outs))
        swap = int((gain[ins[:pairs]] + gain[outs[:pairs]] > 0).sum()) // 2
        if not swap:
            break
        new = side.copy()
        new[ins[:swap]], new[outs[:swap]] = False, True
        less = int((new[a] != new[b]).sum())
        if less >= cut:
            break
        side, cut = new, less
    return side


def balanced_parts(near: np.ndarray, parts: int) -> np.ndarray:
    """The part of each vertex of a neighbour graph; sizes differ by rounding only."""
    n = len(near)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    out, rng = np.zeros(n, np.int64), np.random.default_rng(0)

    def split(rows: np.ndarray, a: np.ndarray, b: np.ndarray, low: int, parts: int) -> None:
        if parts == 1:
            out[rows] = low
            return
        left = parts // 2
        side = halved(a, b, len(rows), len(rows) * left // parts, rng)
        for of, keep, at, some in ((rows[side], side, low, left), (rows[~side], ~side, low + left, parts - left)):
            number = np.cumsum(keep) - 1
            inside = keep[a] & keep[b]
            split(of, number[a[inside]], number[b[inside]], at, some)

    split(np.arange(n), a, b, 0, parts)
    return out


@dataclass
class Softmax:
    """Softmax regression on a vector; ``scale`` brings components to about one."""

    scale: float
    weights: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = (x * self.scale) @ self.weights[:-1] + self.weights[-1]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def learned(x: np.ndarray, target: np.ndarray, epochs: int = 25, batch: int = 256, rate: float = 0.02, decay: float = 1e-4) -> Softmax:
    """Least cross entropy to ``target`` (rows of probabilities), by Adam over shuffled batches."""
    model = Softmax(1 / max(float(np.sqrt((x * x).mean())), 1e-300), np.zeros((x.shape[1] + 1, target.shape[1])))
    rng, w = np.random.default_rng(0), model.weights
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs)
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            some, step = order[at:at + batch], step + 1
            off = (model.probabilities(x[some]) - target[some]) / len(some)
            slope = np.concatenate([(x[some] * model.scale).T @ off, off.sum(axis=0)[None]]) + decay * w
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
            w -= pace * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return model


@dataclass
class Partitions:
    """Index classifier, router, and the share of the router's probability to search."""

    index: Softmax
    router: Softmax
    share: float

    def part(self, x: np.ndarray) -> np.ndarray:
        return self.index.probabilities(x).argmax(axis=1)

    def routes(self, x: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
        """The parts that each query searches, most probable first."""
        p = self.router.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        reached = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        enough = (reached >= self.share) & (np.cumsum(sizes[order], axis=1) >= least)
        many = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, p.shape[1])
        return [row[:m][sizes[row[:m]] > 0] for row, m in zip(order, many, strict=True)]


def fit(sample: np.ndarray, n: int) -> Partitions:
    """Partitions for a table of ``n`` points, from a sample in random order."""
    own = max(len(sample) * 2 // 3, 1)
    train, fresh = sample[:own], sample[own:]
    parts = max(1, min(PARTS, n // PART + 3, own // LEAST))
    near = neighbours(train, train, NEAR) if parts > 1 else np.zeros((own, 0), np.int64)
    label = balanced_parts(near, parts)
    index = learned(train, np.eye(parts)[label])

    def spread(of: np.ndarray, near: np.ndarray) -> np.ndarray:
        return np.eye(parts)[of][near].mean(axis=1)

    if parts == 1 or len(fresh) < 2:
        return Partitions(index, index, 1.0)
    router = learned(train, spread(index.probabilities(train).argmax(axis=1), near))
    asked = fresh[:1024]
    of = index.probabilities(fresh).argmax(axis=1)
    found = neighbours(asked, fresh, NEAR)
    p = router.probabilities(asked)
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) - np.take_along_axis(p, order, axis=1)
    ahead = np.take_along_axis(before, np.argsort(order, axis=1), axis=1)
    # a neighbour is found once the share exceeds the probability of all parts ahead of its own
    needed = np.take_along_axis(ahead, of[found], axis=1).ravel()
    share = float(np.quantile(needed, TARGET)) + 1e-9 if len(needed) else 1.0
    return Partitions(index, router, share)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), float).reshape(len(vectors), -1)


def best(queries: np.ndarray, points: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, point row, score) of each query's ``k`` best points, by score and then by name."""
    score = queries @ points.T
    size = np.sqrt((queries ** 2).sum(axis=1))[:, None] * np.sqrt((points ** 2).sum(axis=1)).max()
    if k < len(points):
        kth = -np.partition(-score, k - 1, axis=1)[:, k - 1:k]
        q, p = np.nonzero(score >= kth - 1e-9 * size)
    else:
        q, p = (i.ravel() for i in np.indices(score.shape))
    exact = np.zeros(len(q))
    for j in range(queries.shape[1]):
        exact += queries[q, j] * points[p, j]
    order = np.lexsort((names[p], -exact, q))
    q, p, exact = q[order], p[order], exact[order]
    nth = np.arange(len(q)) - np.searchsorted(q, q)
    return q[nth < k], p[nth < k], exact[nth < k]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: finite numbers, not all of them zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): up to ``k`` near other rows for each query.

    rows: vec_id, vector (array of float or double, or null).
    """
    known = _kept(rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
                  .select("vec_id", "vector", F.size("vector").alias("length"), is_query.alias("is_query")), "vectors")
    lengths = sorted(r["length"] for r in known.select("length").distinct().limit(LENGTHS + 1).collect())
    if len(lengths) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    if not lengths:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, [_nearest(known.where(F.col("length") == n).drop("length"), k) for n in lengths])


def _nearest(known: DataFrame, k: int) -> DataFrame:
    # of equal vectors, the k + 1 smallest ids can be among the nearest of any query; tasks cut their own groups first
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    points = _kept(known.select("vec_id", "vector").distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
                   .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                   .select(F.col("ids")[0].alias("name"), "ids", "vector"), "points")
    asked = known.where("is_query").select("vec_id", "vector").distinct()
    queries = _kept(asked.join(points.select("vector", "name"), "vector").select(F.col("vec_id").alias("query_id"), "name"), "queries")
    n = points.count()
    sample = points.orderBy(F.xxhash64("name"), "name").limit(SAMPLE).select("vector").collect()
    model = fit(np.array([r["vector"] for r in sample], float), n)
    parts = model.index.weights.shape[1]

    @F.pandas_udf("int")
    def part(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            yield pd.Series(model.part(_matrix(vectors)).astype(np.int32))

    points = _kept(points.withColumn("part", part("vector")), "parts")
    sizes = _counts(points, parts)

    @F.pandas_udf("array<int>")
    def route(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            yield pd.Series([r.astype(np.int32) for r in model.routes(_matrix(vectors), sizes, k + 1)])

    query_points = points.select("name", "vector", "part").join(queries.select("name").distinct(), "name", "left_semi")
    routed = _kept(query_points.select("name", "vector", "part", route("vector").alias("routes")), "routes")

    # a query block meets a shard of the parts that its queries are routed to; neighbouring parts have neighbouring
    # numbers, so the queries of a block share most of theirs
    def numbered(counts: np.ndarray, most: int) -> tuple[Column, Column, Column]:
        """First number, numbers, and a row's own number, of blocks of ``most`` rows that each part's rows are dealt to."""
        splits = np.maximum(-(-counts // most), 1)
        first, at, held = np.zeros(parts, np.int64), 0, 0
        for p in range(parts):
            if held and (held + counts[p] > most or splits[p] > 1):
                at, held = at + 1, 0
            first[p] = at
            at, held = (at + splits[p], 0) if splits[p] > 1 else (at, held + counts[p])
        low, many = (F.array(*[F.lit(int(x)).cast("long") for x in xs]) for xs in (first, splits))
        return low, many, low[F.col("part")] + F.pmod(F.xxhash64("name"), many[F.col("part")])

    _, _, block = numbered(_counts(routed, parts), QUERY_BLOCK)
    low, many, shard = numbered(sizes, SHARD)
    shards = F.array_distinct(F.flatten(F.transform("routes", lambda p: F.sequence(low[p], low[p] + many[p] - 1))))
    left = routed.select(block.alias("block"), F.explode(shards).alias("shard"), "name", "vector", "routes")
    meets = routed.select(block.alias("block"), F.explode("routes").alias("part")).distinct()
    right = points.select("part", shard.alias("shard"), "name", "vector").join(meets, "part")

    def search(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"query": [], "name": [], "score": []}).astype({"query": "int64", "name": "int64"})
        asked, names, of = _matrix(q["vector"]), p["name"].to_numpy(np.int64), p["part"].to_numpy()
        goes = np.zeros((len(q), parts), bool)
        for row, to in enumerate(q["routes"]):
            goes[row, to] = True
        found = []
        for number in np.unique(of):
            some, rows = np.flatnonzero(goes[:, number]), np.flatnonzero(of == number)
            for at in range(0, len(rows) if len(some) else 0, BLOCK):
                here = rows[at:at + BLOCK]
                at_q, at_p, score = best(asked[some], _matrix(p["vector"].iloc[here]), names[here], k + 1)
                found.append((some[at_q], here[at_p], score))
        if not found:
            return search(q.iloc[:0], p)
        at_q, at_p, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((names[at_p], -score, at_q))
        at_q, at_p, score = at_q[order], at_p[order], score[order]
        keep = np.arange(len(at_q)) - np.searchsorted(at_q, at_q) <= k
        return pd.DataFrame({"query": q["name"].to_numpy(np.int64)[at_q[keep]], "name": names[at_p[keep]], "score": score[keep]})

    key = ["block", "shard"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, "query long, name long, score double")
    by_name = Window.partitionBy("query").orderBy(F.col("score").desc(), "name")
    found = _kept(found.withColumn("nth", F.row_number().over(by_name)).where(F.col("nth") <= k + 1).drop("nth"), "found")
    # the ids of a point share its score; a query leaves out its own
    by_id = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ids = (found.join(points.select("name", "ids"), "name").select("query", "score", F.explode("ids").alias("vec_id"))
           .withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= k + 1)
           .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("found")))
    ranked = queries.join(ids, queries["name"] == ids["query"]).select("query_id", F.posexplode(F.slice(
        F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                         F.col("x.score").alias("score"))


def _counts(df: DataFrame, parts: int) -> np.ndarray:
    """Rows of each part."""
    out = np.zeros(parts, np.int64)
    for r in df.groupBy("part").count().collect():
        out[r["part"]] = r["count"]
    return out


def recall(found: DataFrame, rows: DataFrame, is_query: Column, k: int = 20, queries: int = 200) -> float:
    """Share of the exact ``k`` nearest that ``found`` holds, for at most ``queries`` of them, chosen by hash and
    compared with every row."""
    known = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    asked = known.where(is_query).orderBy(F.xxhash64("vec_id"), "vec_id").limit(queries).select("vec_id", "vector").collect()
    if not asked:
        return 1.0
    ids, q = np.array([r["vec_id"] for r in asked]), np.array([r["vector"] for r in asked], float)

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names = b["vec_id"].to_numpy(np.int64)
            at, to, score = best(q, _matrix(b["vector"]), names, k + 1)
            keep = ids[at] != names[to]
            yield pd.DataFrame({"query_id": ids[at][keep], "vec_id": names[to][keep], "score": score[keep]})

    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    wanted = (known.where(F.size("vector") == q.shape[1]).select("vec_id", "vector").mapInPandas(exact, "query_id long, vec_id long, score double")
              .withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= k))
    hit = wanted.join(found.select("query_id", "vec_id").withColumn("hit", F.lit(1)), ["query_id", "vec_id"], "left")
    got = hit.agg(F.count("*").alias("n"), F.count("hit").alias("hit")).first()
    return got["hit"] / max(got["n"], 1)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: a table in the shared folder."""
    spark: SparkSession = df.sparkSession
    place = scratch_path(spark, f"partitions-{name}")
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)
