"""Clusters from bit planes, whitening and learned partitions, against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ampora.llm import bit_planes as bp
from ampora.llm import learned_partitions as lp
from ampora.llm import whitening
from ampora.llm.cover_tree import scaled


def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, np.floor(np.array(v, float) * 1024).astype(np.int64)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1].tolist()))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((int(((v - c) ** 2).sum()), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            of = [v for (_, v), a in zip(kept, at, strict=True) if a == n]
            if of:
                centroids[n] = np.array([int(s) // len(of) for s in np.sum(of, axis=0)])
    end = [nearest(v) for _, v in kept]
    inertia = {n: sum(d for d, m in end if m == n) for n in range(k)}
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), sha[n]) for (i, _), (d, n) in zip(kept, end, strict=True)), key=str)


def test_products_of_planes_are_exact():
    rng = np.random.default_rng(5)
    for high in (1, 2, 1000, bp.LIMIT - 1):
        x, y = rng.integers(-high, high + 1, (50, 64)), rng.integers(-high, high + 1, (7, 64))
        x[0], x[1] = high, -high
        a, b = bp.pack(x), bp.pack(y)
        assert (bp.products(a, b) == x @ y.T).all() and (bp.squares(a) == (x * x).sum(1)).all()
        assert ((bp.unpack(a) * bp.weights(a.shape[1])[:, None]).sum(1) == x).all()
    assert bp.pack(np.zeros((0, 64), np.int64)).shape[0] == 0
    with pytest.raises(ValueError):
        bp.pack(np.full((1, 64), bp.LIMIT))


def vector_table(n=600):
    rng = np.random.default_rng(6)
    centers = rng.normal(0, 0.5, (6, 64))
    rows = [(i, (centers[i % 6] + rng.normal(0, 0.2, 64)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, [0.5] * 64) for i in range(n // 3)]                                   # a quarter is one vector
    rows += [(5, rows[5][1]), (7, [0.25] * 64), (None, [0.25] * 64), (2000, None), (2001, [1.0] * 63 + [None]),
             (2002, [float("nan")] * 64), (2003, [float("inf")] * 64), (2004, [0.0] * 64)]
    return rows


SCHEMA = "vec_id long, embedding array<float>"


def run_clusters(df):
    rows = df.select("vec_id", scaled(F.col("embedding")).alias("vector"), F.lit("x").alias("cluster"))
    out = bp.clusters(rows, bp.seed_order(F.col("vec_id"))).withColumn("centroid", bp.digest(F.col("centroid")))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_clusters_equal_brute_force(spark):
    rows = [*vector_table(), (3000, [1.0] * 3), (3001, [])]
    assert run_clusters(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute_clusters(rows)


def test_clusters_of_few_vectors(spark):
    rows = [(1, [0.5] * 64), (2, [-0.5] * 64), (2, [-0.5] * 64), (None, [0.0] * 64)]
    assert run_clusters(spark.createDataFrame(rows, SCHEMA)) == brute_clusters(rows)
    assert run_clusters(spark.createDataFrame([(1, None)], SCHEMA)) == []


def brute_whitened(x, k=8):
    n, sums = len(x), x.sum(axis=0)
    off = (n * x - sums).astype(object)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return (off * off).sum(axis=1), centred @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum(), values


def whole_numbers(rows):
    return np.array([np.floor(np.array(v, float) * 1024).astype(np.int64) + 100_000 for _, v in rows
                     if v is not None and all(x is not None and np.isfinite(x) for x in v)])


def shifted(df):
    return df.select("vec_id", F.transform(scaled(F.col("embedding")), lambda x: x + 100_000).alias("vector"), F.lit(1).alias("n"))


@pytest.mark.parametrize("kind", ["clustered", "flat", "hot"])
def test_whitening_equals_eigenvectors(spark, kind):
    rng = np.random.default_rng(7)
    if kind == "clustered":
        rows = vector_table()
    elif kind == "flat":                   # no gap after the wanted components
        rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 0.125, (3000, 64)).astype(np.float32))]
    else:                                  # one direction holds almost all variance
        rows = [(i, (v + np.float32(40.0 * (i % 3 == 0))).tolist()) for i, v in enumerate(rng.normal(0, 0.125, (900, 64)).astype(np.float32))]
    done = whitening.whiten(shifted(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    x = whole_numbers(rows)
    deviation, white, explained, values = brute_whitened(x)
    assert done.moments.n == len(x) and done.identity_error < 1e-9
    assert np.allclose(done.components.variances / done.components.total, explained, rtol=1e-10, atol=0)
    got = done.rows.collect()
    assert sorted(r["deviation"] for r in got) == sorted(str(d) for d in deviation)
    ours, theirs = np.array([r["whitened"] for r in got]), white
    order = [np.lexsort(np.round(np.abs(m) * 1e6).T) for m in (ours, theirs)]
    gap = np.abs(np.diff(values[:9])).min() / values[0]
    assert np.allclose(np.abs(ours[order[0]]), np.abs(theirs[order[1]]), rtol=0, atol=1e-12 / gap)
    assert np.allclose(done.components.vectors.T @ done.components.vectors, np.eye(8), atol=1e-12)


def test_whitening_of_few_rows(spark):
    def run(rows):
        return whitening.whiten(shifted(spark.createDataFrame(rows, SCHEMA)))

    assert run([(1, None)]) is None and run([(1, [0.5] * 64)]) is None and run([(1, [0.5] * 64), (1, [0.5] * 64), (2, [0.5] * 64)]) is None
    two = run([(1, [0.5] * 64), (2, [-0.5] * 64), (None, [-0.5] * 64), (3, [float("nan")] * 64)])
    assert len(two.components.variances) == 1 and two.components.variances[0] / two.components.total == pytest.approx(1)
    assert sorted(round(r["whitened"][0], 9) for r in two.rows.collect()) == sorted(
        round(s * v, 9) for v in (2 ** 0.5, -(0.5 ** 0.5), -(0.5 ** 0.5)) for s in [1 if two.rows.where("vec_id = 1").first()["whitened"][0] > 0 else -1])
    with pytest.raises(ValueError, match="different lengths"):
        run([(1, [0.5] * 64), (2, [0.5] * 63)])


def test_deviation_beyond_63_bits_is_exact():
    x = np.array([[2 ** 40, 5], [-(2 ** 40), 7], [3, 2 ** 35]])
    of = whitening.Moments(3, [int(s) for s in x.sum(axis=0)])
    assert of.deviation(x) == [str(sum((3 * int(v) - s) ** 2 for v, s in zip(row, of.sums, strict=True))) for row in x]


def test_registered_whitening(spark):
    from ampora.llm.queries import QUERIES

    rows = QUERIES["op12_chebyshev_whitening"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 500 * 8 and {r["component"] for r in rows} == set(range(1, 9)) and {r["n"] for r in rows} == {500}
    assert max(r["identity_error"] for r in rows) <= 1e-4 and all(str(r["deviation"]) == r["deviation_text"] for r in rows)


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):      # sum() of floats corrects its rounding
        total += float(x * y)
    return total


def brute_nearest(rows, k=20):
    known = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            known.setdefault(i, np.array(v, np.float32).astype(float))
    out = {}
    for q in (i for i in known if i % 20 == 0):
        scores = []
        for i, v in known.items():
            if i != q and len(v) == len(known[q]):
                scores.append((-dot(known[q], v), i))
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def near_table(n=2400):
    rng = np.random.default_rng(8)
    centers = rng.normal(0, 1, (30, 16))
    rows = [(i, (centers[i % 30] + rng.normal(0, 0.3, 16)).astype(np.float32).tolist()) for i in range(n)]
    near = rng.normal(0, 1, 16)
    rows += [(n + i, (near + rng.normal(0, 1e-3, 16)).astype(np.float32).tolist()) for i in range(n // 3)]       # near copies
    rows += [(2 * n + i, [0.5] * 16) for i in range(n // 3)]                                                     # copies
    return rows


def test_learned_partitions_find_the_nearest(spark, monkeypatch):
    for name, value in (("BLOCK", 64), ("QUERY_BLOCK", 32), ("SHARD", 300), ("SAMPLE", 1500), ("PART", 128)):
        monkeypatch.setattr(lp, name, value)
    rows = near_table()
    rows += [(100, rows[100][1]), (9000, None), (9020, [1.0] * 15 + [None]), (9040, [float("nan")] * 16), (9060, [float("inf")] * 16),
             (9080, [0.0] * 16), (9100, []), (None, [0.5] * 16), (9120, [0.5] * 3), (9121, [1.0, -1.0, 0.25]), (9122, [-0.5] * 3)]
    df = spark.createDataFrame(rows, SCHEMA).select("vec_id", F.col("embedding").alias("vector"), F.lit(1).alias("score")).repartition(5)
    is_query = F.col("vec_id") % 20 == 0
    got = {}
    for r in lp.nearest(df, is_query).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    wanted = brute_nearest(rows)
    assert got.keys() == wanted.keys()
    hits = 0
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v is not None and None not in v}
    for q, best in wanted.items():
        found = [got[q][rank] for rank in range(1, len(got[q]) + 1)]
        assert len(found) == len(best) and len({i for i, _ in found}) == len(found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(s == dot(vectors[q], vectors[i]) for i, s in found)
        hits += len({i for i, _ in found} & {i for i, _ in best})
    share = hits / sum(map(len, wanted.values()))
    assert share >= 0.95
    assert got[9120] == {1: (9121, 0.125), 2: (9122, -0.75)}
    one = df.where("size(vector) = 16")
    assert lp.recall(lp.nearest(one, is_query), one, is_query) >= 0.95


def test_few_vectors_to_search(spark):
    def run(rows):
        df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
        return sorted(tuple(r) for r in lp.nearest(df, F.col("vec_id") % 20 == 0).collect())

    assert run([(1, None)]) == [] and run([(20, [1.0])]) == [] and run([(1, [1.0]), (2, [1.0])]) == []
    assert run([(20, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (3, [-1.0, 2.0])]) == [(20, 1, 1, 0.5), (20, 2, 2, 0.5), (20, 3, 3, -1.0)]


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(9)
    x = np.concatenate([c + rng.normal(0, 0.1, (50, 8)) for c in rng.normal(0, 1, (12, 8))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = lp.neighbours(x, x, 10)
    part = lp.balanced_parts(near, 6)
    assert set(np.bincount(part)) == {100}
    assert (part[near] == part[:, None]).mean() > 0.8
    model = lp.learned(x, np.eye(6)[part])
    assert (model.probabilities(x).argmax(axis=1) == part).mean() > 0.8


def test_registered_search_reaches_its_recall(spark):
    from ampora.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    found = QUERIES["op11_learned_partitions"](spark, "/root/testdata/sf0.001")
    assert found.count() == 25 * 20
    assert lp.recall(found, rows, F.col("vec_id") % 20 == 0) >= 0.9
