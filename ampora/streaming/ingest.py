"""Incremental append of newly landed documents into a raw table.

The batch flow re-reads the whole landing; this variant picks up only
documents added since the last run (file source + checkpoint).  One stream reads the landing.
Each micro-batch is routed in one pass into valid documents and rejects, the valid ones are flattened
(stateless, per row), and everything is written under the batch's number, overwriting what a failed attempt of the
same batch left: a retried micro-batch never appends twice.
Invalid documents and badly typed measures cannot fail a long-running stream, so they go to a
quarantine table instead of raising.  Monthly roll-up and dedup stay batch
jobs over the raw table (they are full-table rewrites in the original too).

The raw path is owned by the stream (a folder per micro-batch, ``ingest_batch=<n>``); batch appends must
not write into it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ampora.operators.flatten import (balance_envelope, fallback_timestamp, flatten_balance,
                                      flatten_weather, measure_violations, weather_arrays)
from ampora.schemas import BALANCE_RAW
from ampora.sinks.writers import conform, write_routes

LANDING_SCHEMA = "value string, region_slug string"


def landed_documents(spark: SparkSession, landing_root: str, max_files: int | None = None):
    """Streaming DataFrame of (region_slug, doc) from a JSON Lines landing."""
    r = spark.readStream.schema(LANDING_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.text(landing_root).select("region_slug", F.col("value").alias("doc"))


def _routed(docs: DataFrame, violations: DataFrame) -> DataFrame:
    """Documents with the route that their violations give them."""
    reason = F.when(F.size("violations") > 0, F.array_join("violations", "; "))
    return violations.select(*docs.columns, reason.alias("reason")).withColumn(
        "route", F.when(F.col("reason").isNull(), F.lit("good")).otherwise(F.lit("rejects")))


def ingest_balance(spark: SparkSession, landing_root: str, raw_path: str, quarantine_path: str,
                   checkpoint_root: str, available_now: bool = True,
                   fallback_ts: str | None = None) -> list[StreamingQuery]:
    """Start the balance ingestion stream (rows and quarantine)."""
    ts = fallback_ts or fallback_timestamp()

    def flat(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        bad = measure_violations(docs).select(
            "region_slug", F.lit(None).cast("string").alias("doc"),
            F.concat_ws(" ", "metric_id", "violation").alias("reason"))
        return conform(flatten_balance(docs, ts, strict=False), BALANCE_RAW), bad

    return [_ingest(landed_documents(spark, landing_root), lambda docs: _routed(docs, balance_envelope(docs, ts)), flat,
                    raw_path, quarantine_path, f"{checkpoint_root}/balance", available_now)]


def ingest_weather_daily(spark: SparkSession, landing_root: str, daily_path: str,
                         quarantine_path: str, checkpoint_root: str,
                         available_now: bool = True) -> list[StreamingQuery]:
    """Start the weather ingestion stream (daily rows and quarantine)."""
    def route(docs: DataFrame) -> DataFrame:
        named = docs.withColumnRenamed("region_slug", "landing_slug")
        return _routed(named, weather_arrays(named)).withColumnRenamed("landing_slug", "region_slug")

    return [_ingest(landed_documents(spark, landing_root), route, lambda docs: (flatten_weather(docs, strict=False), None),
                    daily_path, quarantine_path, f"{checkpoint_root}/weather", available_now)]


def _ingest(docs: DataFrame, route: Callable[[DataFrame], DataFrame],
            flat: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]], rows_path: str, quarantine_path: str,
            checkpoint: str, available_now: bool) -> StreamingQuery:
    def batch(part: DataFrame, number: int) -> None:
        routes = write_routes(route(part), f"{checkpoint}-routed/{number}")
        rows, refused = flat(routes.good)
        rows.write.mode("overwrite").parquet(f"{rows_path}/ingest_batch={number}")
        bad = routes.rejects
        if refused is not None:
            bad = bad.unionByName(refused)
        bad.write.mode("overwrite").parquet(f"{quarantine_path}/ingest_batch={number}")

    w = docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
