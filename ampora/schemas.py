"""Fixed table schemas (field order is significant for positional formats)."""

from pyspark.sql import types as T

S, D, L, I, B, TS = (T.StringType(), T.DoubleType(), T.LongType(),
                     T.IntegerType(), T.BooleanType(), T.TimestampType())


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Region catalogue as it sits in the CSV: every field is text.
REGION_CATALOG_RAW = _struct([(n, S) for n in [
    "region_slug", "display_name", "region_type", "redata_geo_limit", "redata_geo_id",
    "weather_location_name", "latitude", "longitude", "timezone",
    "weather_point_type", "is_active"]])

REGION_CATALOG = _struct([
    ("region_slug", S), ("display_name", S), ("region_type", S), ("redata_geo_limit", S),
    ("redata_geo_id", I), ("weather_location_name", S), ("latitude", D), ("longitude", D),
    ("timezone", S), ("weather_point_type", S), ("is_active", B)])

# Flattened balance rows (output of the document flatten; times still text).
BALANCE_FLAT = _struct([
    ("source", S), ("endpoint", S), ("region_slug", S), ("region_name", S),
    ("redata_geo_id", L), ("ingestion_timestamp", S), ("group_type", S), ("group_id", S),
    ("group_title", S), ("metric_type", S), ("metric_id", S), ("metric_group_id", S),
    ("metric_title", S), ("metric_description", S), ("is_composite", B), ("last_update", S),
    ("total", D), ("total_percentage", D), ("year_month", S), ("datetime", S),
    ("value", D), ("percentage", D)])

# Raw warehouse balance table: same 22 columns, times typed.
BALANCE_RAW = _struct([
    (f.name, TS if f.name in ("ingestion_timestamp", "last_update", "datetime") else f.dataType)
    for f in BALANCE_FLAT.fields])

WEATHER_ENVELOPE = ["source", "ingestion_timestamp", "region_slug", "region_name",
                    "location_name", "latitude", "longitude", "timezone", "weather_point_type"]

WEATHER_DAILY = _struct([
    ("source", S), ("ingestion_timestamp", S), ("region_slug", S), ("region_name", S),
    ("location_name", S), ("latitude", D), ("longitude", D), ("timezone", S),
    ("weather_point_type", S), ("date", S),
    ("temperature_2m_max", D), ("temperature_2m_mean", D), ("temperature_2m_min", D),
    ("precipitation_sum", D), ("weather_code", L), ("wind_speed_10m_max", D),
    ("shortwave_radiation_sum", D)])

WEATHER_MONTHLY_FLAT = _struct([
    ("source", S), ("ingestion_timestamp", S), ("region_slug", S), ("region_name", S),
    ("location_name", S), ("latitude", D), ("longitude", D), ("timezone", S),
    ("weather_point_type", S), ("year_month", S),
    ("temperature_2m_max_avg", D), ("temperature_2m_mean_avg", D),
    ("temperature_2m_min_avg", D), ("precipitation_sum_total", D),
    ("wind_speed_10m_max_avg", D), ("shortwave_radiation_sum_total", D)])

WEATHER_MONTHLY_RAW = _struct([
    (f.name, TS if f.name == "ingestion_timestamp" else f.dataType)
    for f in WEATHER_MONTHLY_FLAT.fields])

MART_COLUMNS = ["region_slug", "region_name", "year_month", "group_type", "metric_type",
                "value", "percentage", "temperature_2m_max_avg", "temperature_2m_mean_avg",
                "temperature_2m_min_avg", "precipitation_sum_total", "wind_speed_10m_max_avg",
                "shortwave_radiation_sum_total"]
