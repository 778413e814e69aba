"""Corpus pipeline: documents through five of the subpackage's operators, one after another.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns
of ``documents``; the last returns a row of token counts and digests per document.  ``run`` writes each
stage's result as Parquet in the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ampora.llm.bpe import bpe_digests
from ampora.llm.decontaminate import remove_contaminated
from ampora.llm.near_dedup import one_of_each
from ampora.llm.quality import keep_good
from ampora.llm.queries import table, tokenizer_path
from ampora.llm.ship import bound_batches, ship
from ampora.llm.toxicity import drop_toxic
from ampora.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bound_batches(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bound_batches(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bound_batches(spark)
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bound_batches(spark)
    return remove_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bound_batches(spark)
    return bpe_digests(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity),
    ("minhash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("bpe encoding and decoding", bpe_encoding),
]

#: The classifiers, signatures and ids can't be expressed in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
