"""Exact top-k search by inner product: cover trees over queries and data, searched together.

Vectors are integers.  Equal vectors are one point that stands for its smallest ids, so copies cost
nothing.  Points are dealt to cells of the nearest of a few pivots and cells are split into blocks of
bounded size; so are the queries.  First each block of queries is searched against the blocks of its own
cell, which gives each query a lower bound of its worst kept score.  Then it is searched against
all other blocks whose centre and covering radius leave room for a better one, in those cells that do.

In a task, a cover tree is built over the queries and one over the points.  A pair of nodes with centres
c, d and covering radii r, s holds no product over <c,d> + r|d| + s|c| + rs, nor over (u^2 + v^2 - max(0, |c-d| - r - s)^2) / 2
if none of their vectors is longer than u and v; it is left out if either is below the worst kept score of the query
node's queries.  All others are split, down to single queries where these lie apart, and to the products of points.
Vectors that don't cluster, as directions without order, leave nothing out: then all products are made, in few large ones.

Rows: those with a null id, a null vector, or a null, NaN or infinite component take no part.  Vectors of
different lengths have no product.  Ties go to smaller ids.  Repeated rows count once; a row is known by its
id, and rows with the query's id aren't its candidates.  Components must keep sums of products
within 63 bits.  Further columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

LEAF = 24                # points of a node that isn't split
MOST = 128               # children of a node; points that need more to halve the radius don't cluster, and are a leaf
BLOCK, QUERY_BLOCK = 4096, 512
PER_PIVOT, PIVOTS = 16_384, 256      # a pivot for so many points, and at most so many
EXACT = float(1 << 53)


@dataclass
class Node:
    """``center`` covers ``rows`` within ``radius``, none is longer than ``longest``; a leaf has no children."""

    center: np.ndarray
    radius: float
    longest: float
    rows: np.ndarray
    children: list[Node]


def build(points: np.ndarray, leaf: int = LEAF) -> Node | None:
    """Cover tree: the children's centres are points of the node, more than half its radius apart, and
    cover its points within half its radius."""
    return _node(points.astype(float), np.arange(len(points)), 0, leaf) if len(points) else None


def _node(points: np.ndarray, rows: np.ndarray, center: int, leaf: int) -> Node:
    x = points[rows]
    middle = x[center]
    away = np.sqrt(((x - middle) ** 2).sum(axis=1))
    radius = float(away.max()) * (1 + 1e-12)
    longest = float(np.sqrt((x ** 2).sum(axis=1)).max()) * (1 + 1e-12)
    if len(rows) <= leaf or radius == 0:
        return Node(middle, radius, longest, rows, [])
    centers, owner, nearest = [center], np.zeros(len(rows), np.int64), away
    while nearest.max() > radius / 2:
        if len(centers) == MOST:
            return Node(middle, radius, longest, rows, [])
        far = int(nearest.argmax())
        to = np.sqrt(((x - x[far]) ** 2).sum(axis=1))
        owner = np.where(to < nearest, len(centers), owner)
        nearest = np.minimum(nearest, to)
        centers.append(far)
    members = [np.flatnonzero(owner == k) for k in range(len(centers))]
    # single points make up one leaf around the node's centre, unless leaves are to be single points
    single = np.array([m[0] for m in members if len(m) == 1 < leaf], np.int64)
    children = [_node(points, rows[m], int(np.flatnonzero(m == c)[0]), leaf)
                for c, m in zip(centers, members, strict=True) if len(m) > 1 or leaf == 1]
    if len(single):
        children.append(Node(middle, float(away[single].max()) * (1 + 1e-12), longest, rows[single], []))
    return Node(middle, radius, longest, rows, children)


def room(product, distance, q_center, q_radius, q_longest, p_center, p_radius, p_longest, least=np.minimum, most=np.maximum):  # noqa: ANN001, ANN201
    """The largest product that two nodes can hold: by their centres' product and radii, and by the distance
    between them and the lengths of their longest vectors.  ``*_center``: lengths of the centres."""
    by_product = product + q_radius * p_center + p_radius * q_center + q_radius * p_radius
    apart = most(distance - q_radius - p_radius, distance * 0)
    by_distance = (q_longest * q_longest + p_longest * p_longest - apart * apart) / 2
    slack = 1e-9 * ((q_center + q_radius) * (p_center + p_radius) + q_longest * q_longest + p_longest * p_longest)
    return least(by_product, by_distance) + slack + 1e-6


class Search:
    """The best ``k`` points for each query, by score and then by name."""

    def __init__(self, queries: np.ndarray, points: np.ndarray, names: np.ndarray, k: int, floor: np.ndarray) -> None:
        self.queries, self.points, self.names, self.k = queries, points, names, k
        self.floor = floor                                     # per query: scores below it don't matter
        self.score = np.full((len(queries), k), -np.iinfo(np.int64).max)
        self.found = np.full((len(queries), k), -1, np.int64)  # rows of points
        most = max((np.abs(a.astype(float)).max(initial=0) for a in (queries, points)))
        self.exact = most * most * max(queries.shape[1], 1) < EXACT
        self.left, self.right = ((a.astype(float) if self.exact else a) for a in (queries, points))
        self.compared = 0

    def run(self) -> Search:
        q, p = build(self.queries, 1), build(self.points)
        if q is not None and p is not None:
            self._pair(q, p)
        return self

    def _room(self, q: Node, p: Node) -> float:
        away = q.center - p.center
        return float(room(q.center @ p.center, np.sqrt(away @ away), np.sqrt(q.center @ q.center), q.radius, q.longest,
                          np.sqrt(p.center @ p.center), p.radius, p.longest))

    def _pair(self, q: Node, p: Node) -> None:
        if self._room(q, p) < self.floor[q.rows].min():
            return
        # a query node that is small beside the points stays whole: its queries are near to the same of them
        narrow = not q.children or q.radius <= 2 * p.radius
        if narrow and not p.children:
            self._products(q.rows, p.rows)
        elif p.children and (narrow or p.radius >= q.radius):
            # the most promising first: it raises the worst kept scores for the others
            for child in sorted(p.children, key=lambda c: -self._room(q, c)):
                self._pair(q, child)
        else:
            for child in q.children:
                self._pair(child, p)

    def _products(self, q: np.ndarray, p: np.ndarray) -> None:
        self.compared += len(q) * len(p)
        for at in range(0, len(p), 2048):
            some = p[at:at + 2048]
            new = (self.left[q] @ self.right[some].T).astype(np.int64)
            score = np.concatenate([self.score[q], new], axis=1)
            row = np.concatenate([self.found[q], np.broadcast_to(some, new.shape)], axis=1)
            kth = -np.partition(-score, self.k - 1, axis=1)[:, self.k - 1:self.k]
            i, j = np.nonzero(score >= kth)
            name = np.where(row[i, j] >= 0, self.names[row[i, j]], np.iinfo(np.int64).max)
            order = np.lexsort((name, -score[i, j], i))
            i, j = i[order], j[order]
            keep = np.arange(len(i)) - np.searchsorted(i, i) < self.k
            best = j[keep].reshape(len(q), self.k)
            self.score[q], self.found[q] = np.take_along_axis(score, best, axis=1), np.take_along_axis(row, best, axis=1)
            kth = self.score[q, -1]
            self.floor[q] = np.maximum(self.floor[q], np.where(self.found[q, -1] >= 0, kth, self.floor[q]))


def scaled(vector: Column, by: int = 1024) -> Column:
    """floor(by * x) of each component, x as double; null unless all components are finite numbers."""
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.when(vector.isNotNull() & good, F.transform(vector, lambda x: F.floor(x.cast("double") * by)))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), -1)


def top_k(rows: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows for each query.

    rows: vec_id, vector (array of long, or null).
    """
    spark = rows.sparkSession
    known = _kept(spark, rows.where("vec_id IS NOT NULL AND vector IS NOT NULL")
                  .select("vec_id", "vector", is_query.alias("is_query")), "vectors")
    # of equal vectors, the k + 1 smallest ids can be among the best of any query; tasks cut their own groups first
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    points = (known.select("vec_id", "vector").distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
              .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
              .select(F.col("ids")[0].alias("name"), "ids", "vector", F.size("vector").alias("length")))
    points = _kept(spark, points, "points")
    asked = known.where("is_query").select("vec_id", "vector").distinct()
    queries = _kept(spark, asked.join(points.select("vector", "name"), "vector")
                    .select(F.col("vec_id").alias("query_id"), "name"), "queries")
    n = points.count()
    pivots = points.orderBy(F.xxhash64("name"), "name").limit(max(1, min(PIVOTS, n // PER_PIVOT))).select("vector").collect()
    points = _kept(spark, _celled(points, [np.array(r["vector"], float) for r in pivots]), "cells")
    data = _kept(spark, _blocked(points, BLOCK, "block"), "data")
    query_points = points.join(queries.select("name").distinct(), "name", "left_semi")
    query = _kept(spark, _blocked(query_points.select("name", "vector", "length", "cell"), QUERY_BLOCK, "query_block"), "query")

    summaries = [_kept(spark, _summary(x, of), "summary") for x, of in ((query, "query_block"), (data, "block"))]
    q, d = summaries
    same_cell = q.join(d, ["cell", "length"]).select("query_block", "block")
    first = _kept(spark, _searched(same_cell, query, data, None, k), "first")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "name")
    worst = (first.withColumn("nth", F.row_number().over(best)).where(F.col("nth") == k + 1)
             .select(F.col("query").alias("name"), F.col("score").alias("floor")))
    query = query.join(worst, "name", "left")
    floors = query.groupBy("query_block").agg(
        F.when(F.count("*") == F.count("floor"), F.min("floor")).alias("floor"))
    # the stated queries against all rows, in blocks: cells by their summaries, then the blocks of the cells that are left
    asking = q.join(floors, "query_block")
    near = asking.select("query_block", F.explode(_cells_in_reach(_summary(points, "cell"))(
        "center", "radius", "longest", F.col("floor").cast("string"))).alias("d_cell"))
    paired = (asking.join(near, "query_block").join(d.select(
        "block", F.col("cell").alias("d_cell"), F.col("length"), F.col("center").alias("d_center"), F.col("radius").alias("d_radius"),
        F.col("longest").alias("d_longest")), ["d_cell", "length"]))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    a, b = F.sqrt(dot("center", "center")), F.sqrt(dot("d_center", "d_center"))
    away = F.zip_with("center", "d_center", lambda x, y: x - y)
    most = room(dot("center", "d_center"), F.sqrt(dot(away, away)), a, F.col("radius"), F.col("longest"), b, F.col("d_radius"),
                F.col("d_longest"), F.least, F.greatest)
    others = paired.where((F.col("cell") != F.col("d_cell")) & (F.col("floor").isNull() | (most >= F.col("floor"))))
    second = _searched(others.select("query_block", "block"), query, data, "floor", k)
    found = (first.unionByName(second).withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
             .join(data.select("name", "ids"), "name")
             .select("query", F.explode("ids").alias("vec_id"), "score")
             .groupBy("query").agg(F.collect_list(F.struct((-F.col("score")).alias("order"), "vec_id")).alias("found")))
    ranked = queries.join(found, queries["name"] == found["query"]).select("query_id", F.posexplode(F.slice(
        F.array_sort(F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))), 1, k)).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                         (-F.col("x.order")).alias("score"))


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: a table in the shared folder."""
    place = scratch_path(spark, f"search-{name}")
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def _celled(points: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """Points with the number of the nearest pivot of their length (-1: none has it)."""

    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            cell = np.full(len(vectors), -1, np.int32)
            sizes = vectors.map(len).to_numpy()
            for size in np.unique(sizes):
                of = [i for i, p in enumerate(pivots) if len(p) == size]
                rows = np.flatnonzero(sizes == size)
                if of:
                    x, p = _matrix(vectors.iloc[rows]).astype(float), np.stack([pivots[i] for i in of])
                    cell[rows] = np.array(of)[((p * p).sum(1) - 2 * x @ p.T).argmin(axis=1)]
            yield pd.Series(cell)

    return points.withColumn("cell", F.pandas_udf(assign, "int")("vector"))


def _blocked(points: DataFrame, size: int, name: str) -> DataFrame:
    """Points with the block that each belongs to: a cell, or a share of a large one."""
    parts = points.groupBy("cell", "length").agg(F.ceil(F.count("*") / size).cast("long").alias("parts"))
    return points.join(parts, ["cell", "length"]).withColumn(
        name, F.xxhash64("cell", "length", F.pmod(F.xxhash64("name"), "parts"))).drop("parts")


def _summary(points: DataFrame, by: str) -> DataFrame:
    """Centre, covering radius and longest vector of each block, or of each cell's vectors of one length.

    Tasks add up their own rows, so that a cell with most points isn't one group: a cell's centre is its mean, and its radius is
    over all its points.
    """
    keys = ["cell", "length"] if by == "cell" else [by, "cell", "length"]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(*(key if isinstance(key, tuple) else (key,)), len(part), _matrix(part["vector"]).astype(float).sum(axis=0).tolist())
                   for key, part in batch.groupby(keys)]
            yield pd.DataFrame(out, columns=[*keys, "n", "total"])

    types = ", ".join(f"{k} {points.schema[k].dataType.simpleString()}" for k in keys)
    parts = points.select(*keys, "vector").mapInPandas(sums, f"{types}, n long, total array<double>")
    mean = (parts.select(*keys, "n", F.posexplode("total").alias("at", "total")).groupBy(*keys, "at")
            .agg((F.sum("total") / F.sum("n")).alias("mean")))
    centers = mean.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "mean"))).alias("mean")).select(
        *keys, F.col("mean.mean").alias("center"))
    x = F.transform("vector", lambda v: v.cast("double"))
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    away, size = F.sqrt(square(F.zip_with(x, "center", lambda u, v: u - v))), F.sqrt(square(x))
    return points.join(centers, keys).groupBy(*keys).agg(
        F.first("center").alias("center"), (F.max(away) * (1 + 1e-9)).alias("radius"), (F.max(size) * (1 + 1e-9)).alias("longest"))


def _cells_in_reach(cells: DataFrame):  # noqa: ANN202 - a pandas_udf
    """For a query block, the cells that leave room for a better product; at most ``PIVOTS`` cells a length, and a rest."""
    known = [(r["cell"], r["length"], np.array(r["center"]), r["radius"], r["longest"]) for r in cells.collect()]

    @F.pandas_udf("array<int>")
    def reach(center: pd.Series, radius: pd.Series, longest: pd.Series, floor: pd.Series) -> pd.Series:
        out = []
        for c, r, l, low in zip(center, radius, longest, floor, strict=True):
            c = np.asarray(c, float)
            out.append([cell for cell, length, d, s, m in known if length == len(c) and (low is None or room(
                c @ d, np.linalg.norm(c - d), np.linalg.norm(c), r, l, np.linalg.norm(d), s, m) >= float(int(low)))])
        return pd.Series(out)

    return reach


def _searched(pairs: DataFrame, query: DataFrame, data: DataFrame, floor: str | None, k: int) -> DataFrame:
    """(query, name, score): the best ``k`` + 1 points of each pair of blocks."""
    least = -np.iinfo(np.int64).max

    def search(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(d):
            return pd.DataFrame({"query": [], "name": [], "score": []}).astype("int64")
        low = q["floor"].map(lambda x: least if pd.isna(x) else int(x)).to_numpy(np.int64)
        names = d["name"].to_numpy(np.int64)
        done = Search(_matrix(q["vector"]), _matrix(d["vector"]), names, k + 1, low).run()
        at, nth = np.nonzero(done.found >= 0)
        return pd.DataFrame({"query": q["name"].to_numpy()[at], "name": names[done.found[at, nth]], "score": done.score[at, nth]})

    low = F.col(floor).cast("string") if floor else F.lit(None).cast("string")
    left = pairs.join(query.select("query_block", "name", "vector", low.alias("floor")), "query_block")
    right = pairs.select(F.col("query_block").alias("of_query"), F.col("block").alias("of_data")).join(
        data.select(F.col("block").alias("of_data"), "name", "vector"), "of_data")
    return (left.groupBy("query_block", "block").cogroup(right.groupBy("of_query", "of_data"))
            .applyInPandas(search, "query long, name long, score long"))
