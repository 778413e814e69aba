"""Staging views and marts: typed projections, the energy-weather join and
the curated filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampora.constants import BALANCE_KEY, CURATED_METRICS, MONTHLY_MEASURES, WEATHER_MONTHLY_KEY
from ampora.operators.dedup import dedup_latest
from ampora.schemas import BALANCE_RAW, MART_COLUMNS, WEATHER_MONTHLY_RAW


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stage_balance(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """Newest row per (region, metric id, datetime), cast to the 22 typed columns.

    Pass ``dedup=False`` when the raw table was just rewritten by
    ``sinks.dedup_rewrite`` on the same keys (the second pass is a no-op).
    """
    src = dedup_latest(raw, BALANCE_KEY) if dedup else raw
    return _typed(src, BALANCE_RAW)


def stage_weather(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """Newest row per (region, month), cast to the 16 typed columns."""
    src = dedup_latest(raw, WEATHER_MONTHLY_KEY) if dedup else raw
    return _typed(src, WEATHER_MONTHLY_RAW)


def mart_energy_weather(stg_balance: DataFrame, stg_weather: DataFrame) -> DataFrame:
    """LEFT join energy -> weather on (region_slug, year_month); 13 columns.

    Energy rows without weather are kept with NULL measures; the energy
    side's ``region_name`` wins.  The weather side is one row per region and
    month after staging, so the planner's size checks (static file stats,
    then AQE's runtime stats) broadcast it when it is small and fall back to
    a sort-merge join on the same keys when it is not.
    """
    e = stg_balance.select("region_slug", "region_name", "year_month", "group_type",
                           "metric_type", "value", "percentage")
    w = stg_weather.select("region_slug", "year_month", *MONTHLY_MEASURES)
    return e.join(w, ["region_slug", "year_month"], "left").select(*MART_COLUMNS)


def curate(mart: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Keep the configured metrics (exact text); NULL metrics drop out."""
    keep = list(CURATED_METRICS if metrics is None else metrics)
    return mart.where(F.col("metric_type").isin(keep)).select(*MART_COLUMNS)
