"""End-to-end batch flow: landed documents -> curated mart.

Each stage writes a table under the shared root; those writes double as
lineage cuts, so a lost executor only recomputes from the last table.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampora.constants import BALANCE_KEY, WEATHER_MONTHLY_KEY
from ampora.operators.aggregate import daily_to_monthly
from ampora.operators.flatten import fallback_timestamp
from ampora.operators.merge import merge_balance_years, merge_weather_years
from ampora.operators.models import curate, mart_energy_weather
from ampora.plans import fixtures as fx
from ampora.schemas import (BALANCE_FLAT, BALANCE_RAW, WEATHER_DAILY, WEATHER_MONTHLY_FLAT,
                            WEATHER_MONTHLY_RAW)
from ampora.session import ensure_utc, scratch_path
from ampora.sinks import tables
from ampora.sinks import writers as wr
from ampora.sources.documents import scan_documents

# --- fixed values: names of the raw tables and models ------------------------
RAW_BALANCE, RAW_WEATHER = "redata_balance_electrico", "openmeteo_monthly"
STG_BALANCE, STG_WEATHER = "stg_redata_balance_electrico", "stg_openmeteo_monthly"
MART, CURATED = "mart_energy_weather_monthly", "mart_energy_weather_monthly_curated"


@dataclass
class BatchResult:
    root: str
    database: str
    stg_balance: DataFrame
    stg_weather: DataFrame
    mart: DataFrame
    curated: DataFrame


def land_fixture_documents(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Land one balance and one weather document per region and year."""
    wr.write_landing(fx.balance_documents(spark, sf_dir), f"{root}/landing/balance")
    wr.write_landing(fx.weather_documents(spark, sf_dir), f"{root}/landing/weather")


def database_of(root: str) -> str:
    """Database of the raw tables and models of a flow under ``root``."""
    return f"ampora_{hashlib.sha256(root.encode()).hexdigest()[:12]}"


def run_from_landing(spark: SparkSession, root: str, curated_metrics: list[str] | None = None,
                     region_slugs: list[str] | None = None,
                     processed_format: str = "parquet", raw_mode: str = "rewrite") -> BatchResult:
    """Merge years and flatten -> monthly -> append -> dedup rewrite -> staging -> marts.

    The landed years of a region are merged before they are flattened, so a record that several
    deliveries hold has no ``total`` and ``total_percentage``.

    ``processed_format="csv"`` hands the flat tables over as CSV with a
    header, like the original; they are read back with the fixed schemas
    (never inferred), and blank fields load as NULL.

    ``raw_mode="rewrite"`` appends to each raw table and then rewrites it deduplicated under its
    name (the original's two jobs); ``"upsert"`` keeps month-partitioned raw tables and
    rewrites only the months a load touches.

    Raw tables, staging views and mart tables are in the catalog, in the database
    ``database_of(root)``; a rerun loads into the same tables.
    """
    ensure_utc(spark)
    p = f"{root}/processed"

    def processed(name, schema):
        path = f"{p}/{name}"
        if processed_format == "csv":
            return spark.read.schema(schema).option("header", True).csv(path)
        return spark.read.schema(schema).parquet(path)

    # merge the years of each region, flatten -> processed tables
    bal_docs = scan_documents(spark, f"{root}/landing/balance", region_slugs)
    merged = merge_balance_years(bal_docs, fallback_ts=fallback_timestamp())
    wr.write_processed(merged.select(*BALANCE_FLAT.fieldNames()), f"{p}/balance", processed_format)
    w_docs = scan_documents(spark, f"{root}/landing/weather", region_slugs)
    wr.write_processed(merge_weather_years(w_docs), f"{p}/weather_daily", processed_format)
    # daily -> monthly (map-side partial aggregation)
    monthly = daily_to_monthly(processed("weather_daily", WEATHER_DAILY))
    wr.write_processed(monthly, f"{p}/weather_monthly", processed_format)
    # append into the raw tables, then rewrite them deduplicated under their names
    db = database_of(root)
    tables.create_database(spark, db, f"{root}/tables")
    raw_b, raw_w = f"{db}.{RAW_BALANCE}", f"{db}.{RAW_WEATHER}"
    bal_load = processed("balance", BALANCE_FLAT)
    wm_load = processed("weather_monthly", WEATHER_MONTHLY_FLAT)
    if raw_mode == "upsert":
        wr.upsert_latest(spark, wr.conform(bal_load, BALANCE_RAW), raw_b, BALANCE_KEY, wr.utc_month("datetime"))
        wr.upsert_latest(spark, wr.conform(wm_load, WEATHER_MONTHLY_RAW), raw_w,
                         WEATHER_MONTHLY_KEY, F.col("year_month"))
    else:
        wr.append_load_table(spark, bal_load, RAW_BALANCE, BALANCE_RAW, db)
        wr.append_load_table(spark, wm_load, RAW_WEATHER, WEATHER_MONTHLY_RAW, db)
        wr.dedup_table(spark, raw_b, BALANCE_KEY)
        wr.dedup_table(spark, raw_w, WEATHER_MONTHLY_KEY)
    # models: staging is a view (the raw tables were just deduplicated on the
    # same keys, so the staging dedup is skipped); marts are tables
    stg_b = wr.create_staging_view(spark, f"{db}.{STG_BALANCE}", raw_b, BALANCE_RAW)
    stg_w = wr.create_staging_view(spark, f"{db}.{STG_WEATHER}", raw_w, WEATHER_MONTHLY_RAW)
    mart = wr.save_mart(spark, mart_energy_weather(stg_b, stg_w), f"{db}.{MART}")
    curated = wr.save_mart(spark, curate(mart, curated_metrics), f"{db}.{CURATED}")
    return BatchResult(root, db, stg_b, stg_w, mart, curated)


def run_batch(spark: SparkSession, sf_dir: str, root: str | None = None,
              curated_metrics: list[str] | None = None,
              processed_format: str = "parquet", raw_mode: str = "rewrite") -> BatchResult:
    root = root or scratch_path(spark, "batch")
    land_fixture_documents(spark, sf_dir, root)
    return run_from_landing(spark, root, curated_metrics or fx.FIXTURE_CURATED,
                            processed_format=processed_format, raw_mode=raw_mode)


def publish_models(spark: SparkSession, result: BatchResult, prefix: str = "") -> None:
    """The persistent staging views and mart tables under session-wide names without a database."""
    for name in (STG_BALANCE, STG_WEATHER, MART, CURATED):
        spark.table(tables.quoted(f"{result.database}.{name}")).createOrReplaceTempView(f"{prefix}{name}")
