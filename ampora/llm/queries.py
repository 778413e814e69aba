"""Registered queries of the pipeline operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from .ship import bound_batches, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op7_bag_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    bound_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    return contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_context_mixing_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_file_digests

    return token_file_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op3_ngram_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .labelled_urls import labelled_urls
    from .url_filter import judge, learn

    labelled = spark.createDataFrame(labelled_urls(), "url string, blocked int")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), learn(spark, labelled)).drop("url")


@query
def op4_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_digests

    return archive_digests(table(spark, sf_dir, "pages"))


# payloads are at least 100 bytes of UTF-8 or less, equal ones go to the smallest page_id
ORACLE["op4_seekable_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, octet_length(encode(payload)) AS payload_bytes,
         min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
"""


@query
def op1_dual_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .cover_tree import scaled, top_k

    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("vector"))
    return top_k(rows, F.col("vec_id") % 100 == 0)


ORACLE["op1_dual_tree_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op8_tfidf_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, which have no path, and pages, whose host and path are a tree: a page named like a licence file
    licenses the pages of its directory and below."""
    from pyspark.sql import functions as F

    from .licenses import license_scan, page_text, url_path

    docs = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("kind"), F.col("doc_id").cast("long").alias("id"), F.lit(None).cast("string").alias("path"), "text")
    pages = table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("kind"), F.col("page_id").cast("long").alias("id"), url_path(F.col("url")).alias("path"),
        page_text(F.col("html")).alias("text"))
    return license_scan(docs.unionByName(pages))


@query
def op13_bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .bit_planes import clusters, digest, seed_order
    from .cover_tree import scaled

    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("vector"))
    return clusters(rows, seed_order(F.col("vec_id"))).withColumn("centroid_sha256", digest(F.col("centroid"))).drop("centroid")


def _rounds_sql(rounds: int) -> str:
    """Ten moves of eight centroids, one common table expression after the other."""
    nearest = """, a{r} AS MATERIALIZED (
  SELECT rn, cluster, distance FROM (
    SELECT v.rn, c.cluster, CAST(list_dot_product(v.q, v.q) - 2 * list_dot_product(v.q, c.q) + list_dot_product(c.q, c.q) AS BIGINT) AS distance,
           row_number() OVER (PARTITION BY v.rn ORDER BY list_dot_product(c.q, c.q) - 2 * list_dot_product(v.q, c.q), c.cluster) AS nth
    FROM v CROSS JOIN c{r} c) WHERE nth = 1)"""
    move = """, c{n} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN (
    SELECT cluster, list(CAST(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END AS DOUBLE) ORDER BY i) AS q FROM (
      SELECT cluster, i, CAST(sum(CAST(v.q[i] AS BIGINT)) AS BIGINT) AS s, count(*) AS n
      FROM a{r} a JOIN v USING (rn) CROSS JOIN range(1, 65) t(i) GROUP BY cluster, i) GROUP BY cluster) m USING (cluster))"""
    return "".join(nearest.format(r=r) + move.format(r=r, n=r + 1) for r in range(rounds)) + nearest.format(r=rounds)


ORACLE["op13_bit_plane_clusters"] = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), q) - 1 AS INTEGER) AS cluster, q
  FROM v QUALIFY cluster < 8
){_rounds_sql(10)}
SELECT v.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(list_transform(c.q, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a10 a JOIN v USING (rn) JOIN c10 c USING (cluster)
"""


@query
def op12_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .cover_tree import scaled
    from .whitening import whiten

    whole = F.transform(scaled(F.col("embedding")), lambda x: x + 100_000)
    done = whiten(table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector")))
    if done is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    share = F.array(*[F.lit(float(e / done.components.total)) for e in done.components.variances])
    # beyond 63 bits the exact sum stays as text, and the number is null
    each = done.rows.select("vec_id", F.expr("try_cast(deviation AS long)").alias("deviation"), "deviation",
                            F.posexplode("whitened").alias("at", "whitened")).toDF("vec_id", "deviation", "exact", "at", "whitened")
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(done.moments.n).cast("long").alias("n"),
                       "deviation", "whitened", share[F.col("at")].alias("explained"),
                       F.lit(done.identity_error).alias("identity_error"), F.col("exact").alias("deviation_text"))


@query
def op11_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .learned_partitions import nearest

    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    return nearest(rows, F.col("vec_id") % 20 == 0)
