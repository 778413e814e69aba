"""Coverage and conformance checks, as table work over facts and documents.

The original runs these as list checks around HTTP calls; here they are
joins and aggregates, so they scale with the number of regions and months.
Only error *lists* bounded by a request (e.g. unknown requested slugs) ever
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_regions(facts: DataFrame, catalog: DataFrame, slugs: list[str]) -> DataFrame:
    """Facts of the requested regions; a requested slug missing from the
    catalogue is an error.  Order and repeats of the request carry no meaning
    for a table, so this is a filter, which reaches the scan."""
    wanted = sorted(set(slugs))
    known = {r.region_slug for r in catalog.where(F.col("region_slug").isin(wanted))
             .select("region_slug").distinct().collect()}
    missing = [s for s in wanted if s not in known]
    if missing:
        raise ValueError(f"region not in the catalogue: {missing[0]}")
    return facts.where(F.col("region_slug").isin(wanted))


def unknown_regions(facts: DataFrame, catalog: DataFrame) -> DataFrame:
    """Facts whose region is not in the (active) catalogue."""
    return facts.join(catalog.select("region_slug"), "region_slug", "left_anti")


def coverage_grid(catalog: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Expected requests: one row per region and year, with per-year date
    bounds for both sources and each source's request fields.  A generator
    over the (small) catalogue, not a cross join."""
    if start_year > end_year:
        raise ValueError("start year must not be after end year")
    y = F.col("year").cast("string")
    return catalog.select(
        "region_slug", "redata_geo_id", "latitude", "longitude", "timezone",
        F.explode(F.sequence(F.lit(start_year), F.lit(end_year))).alias("year")).select(
        "region_slug", "year",
        F.concat(y, F.lit("-01-01T00:00")).alias("balance_start"),
        F.concat(y, F.lit("-12-31T23:59")).alias("balance_end"),
        F.concat(y, F.lit("-01-01")).alias("weather_start"),
        F.concat(y, F.lit("-12-31")).alias("weather_end"),
        "redata_geo_id", "latitude", "longitude", "timezone")


def coverage_gaps(catalog: DataFrame, facts: DataFrame, start_year: int, end_year: int,
                  month_col: str = "year_month") -> DataFrame:
    """(region, month) pairs of the expected grid missing from ``facts``."""
    months = F.sequence(F.make_date(F.lit(start_year), F.lit(1), F.lit(1)),
                        F.make_date(F.lit(end_year), F.lit(12), F.lit(1)),
                        F.expr("interval 1 month"))
    grid = catalog.select("region_slug", F.explode(months).alias("_m")).select(
        "region_slug", F.date_format("_m", "yyyy-MM").alias("year_month"))
    # distinct keys first: the aggregate combines map-side, so the anti join
    # shuffles one row per (region, month) and task instead of every fact row
    have = facts.select("region_slug", F.col(month_col).alias("year_month")).distinct()
    return grid.join(have, ["region_slug", "year_month"], "left_anti")


def range_violations(requests: DataFrame, variables: list[str]) -> DataFrame:
    """One row per (request, failed rule): latitude in [-90, 90], longitude in
    [-180, 180], non-empty dates and zone, at least one variable."""
    rules = [
        ("latitude", ~F.col("latitude").between(-90, 90)),
        ("longitude", ~F.col("longitude").between(-180, 180)),
        ("start_date", F.coalesce(F.col("weather_start"), F.lit("")) == ""),
        ("end_date", F.coalesce(F.col("weather_end"), F.lit("")) == ""),
        ("timezone", F.coalesce(F.col("timezone"), F.lit("")) == ""),
        ("daily", F.lit(len(variables) == 0)),
    ]
    flags = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules]))
    return requests.select("region_slug", "year", F.explode(flags).alias("rule"))


def extract_completeness(requested: DataFrame, delivered: DataFrame,
                         key: str = "region_slug") -> DataFrame:
    """Multiset check: per key, how often it was requested vs delivered;
    only mismatching keys are returned."""
    r = requested.groupBy(key).agg(F.count(F.lit(1)).alias("requested_n"))
    d = delivered.groupBy(key).agg(F.count(F.lit(1)).alias("delivered_n"))
    j = r.join(d, key, "full_outer").select(
        key, F.coalesce("requested_n", F.lit(0)).alias("requested_n"),
        F.coalesce("delivered_n", F.lit(0)).alias("delivered_n"))
    return j.where(F.col("requested_n") != F.col("delivered_n"))
