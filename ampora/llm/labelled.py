"""Bounded training samples for the classifiers, and the fold that is never learned from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that is kept for testing; null ids don't."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def sample_ids(rows: DataFrame, where: Column | None, bound: int, name: str) -> DataFrame:
    """At most ``bound`` doc_ids outside the held-out fold, the first in the order of their hash.

    Each task keeps its own first ``bound`` before any row moves.
    """
    ids = rows.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    ids = (ids if where is None else ids.where(where)).select("doc_id").distinct()
    return ids.orderBy(F.xxhash64(F.col("doc_id").cast("long")), "doc_id").limit(bound).withColumn("role", F.lit(name))


def sampled(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(role, doc_id, text) of the chosen ids (a bounded number): of the rows that share an id one, the first by a
    hash of its text, so that repeated ids don't swell the sample."""
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("role", "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
