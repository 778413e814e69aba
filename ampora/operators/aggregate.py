"""Daily weather -> monthly weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampora.functions.columns import nan_to_null, year_month_of_date
from ampora.schemas import WEATHER_ENVELOPE

MONTHLY_KEYS = WEATHER_ENVELOPE + ["year_month"]


def daily_to_monthly(daily: DataFrame) -> DataFrame:
    """Aggregate daily rows to one row per 9 envelope columns + month.

    Matches the pandas original: rows with a NULL key are dropped (pandas
    ``groupby`` default), NaN counts as missing, sums over no values are 0.0
    and means over no values are NULL.  ``ingestion_timestamp`` is a key, so
    two loads of one month stay two rows until the dedup picks the newest.
    The hash aggregate combines map-side, so a hot region shrinks to one
    partial row per task before the shuffle.
    """
    d = daily.withColumn("year_month", year_month_of_date(F.col("date"))).dropna(subset=MONTHLY_KEYS)
    m = {c: nan_to_null(F.col(c).cast("double")) for c in
         ["temperature_2m_max", "temperature_2m_mean", "temperature_2m_min",
          "precipitation_sum", "wind_speed_10m_max", "shortwave_radiation_sum"]}
    return d.groupBy(*MONTHLY_KEYS).agg(
        F.avg(m["temperature_2m_max"]).alias("temperature_2m_max_avg"),
        F.avg(m["temperature_2m_mean"]).alias("temperature_2m_mean_avg"),
        F.avg(m["temperature_2m_min"]).alias("temperature_2m_min_avg"),
        F.coalesce(F.sum(m["precipitation_sum"]), F.lit(0.0)).alias("precipitation_sum_total"),
        F.avg(m["wind_speed_10m_max"]).alias("wind_speed_10m_max_avg"),
        F.coalesce(F.sum(m["shortwave_radiation_sum"]), F.lit(0.0)).alias("shortwave_radiation_sum_total"),
    )
