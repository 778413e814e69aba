"""Data tests: not-null checks as one aggregate per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ampora.constants import NOT_NULL_TESTS


def not_null_counts(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """(model, column_name, failures, passed): one scan, one aggregate."""
    a = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(columns))
    s = a.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, failures)")
    return s.select(F.lit(model).alias("model"), "column_name",
                    F.col("failures").cast("long").alias("failures"),
                    (F.col("failures") == 0).alias("passed"))


def observed(df: DataFrame, model: str, columns: list[str]) -> tuple[DataFrame, Observation]:
    """The table with its not-null counts as metrics of whatever job writes it: no scan of its own."""
    obs = Observation(f"not_null_{model}")
    return df.observe(obs, *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), obs


def observed_report(spark: SparkSession, metrics: dict[str, Observation], tests=None) -> DataFrame:
    """(model, column_name, failures, passed) from the metrics of finished writes: a row per data test."""
    rows = [(model, c, int(metrics[model].get[c]), metrics[model].get[c] == 0)
            for model, columns in (tests or NOT_NULL_TESTS) if model in metrics for c in columns]
    return spark.createDataFrame(rows, "model string, column_name string, failures long, passed boolean")


def not_null_report(tables: dict[str, DataFrame], tests=None) -> DataFrame:
    parts = [not_null_counts(tables[m], m, cols) for m, cols in (tests or NOT_NULL_TESTS)
             if m in tables]
    return reduce(DataFrame.unionByName, parts)
