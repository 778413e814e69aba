"""Region catalogue scan (CSV with a header, every field text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampora.schemas import REGION_CATALOG, REGION_CATALOG_RAW


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw catalogue rows; a missing file fails at analysis (PATH_NOT_FOUND)."""
    return spark.read.schema(REGION_CATALOG_RAW).option("header", True).csv(path)


def catalog_all(raw: DataFrame) -> DataFrame:
    """Typed catalogue, inactive rows included (``is_active`` as BOOLEAN).
    Casts are ANSI: a non-numeric id or coordinate is an error."""
    active = F.lower(F.trim(F.col("is_active"))) == "true"
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in REGION_CATALOG.fields
            if f.name != "is_active"]
    return raw.select(*cols, F.coalesce(active, F.lit(False)).alias("is_active"))


def region_catalog(raw: DataFrame) -> DataFrame:
    """Active regions only: ``trim(lower(is_active)) = 'true'``."""
    return catalog_all(raw).where(F.col("is_active"))


def load_regions(spark: SparkSession, path: str) -> DataFrame:
    return region_catalog(read_catalog_csv(spark, path))
