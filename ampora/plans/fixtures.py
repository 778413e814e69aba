"""Domain tables bound onto the driver's TPC-H-style tables.

E  energy fact      orders x customer x nation, per nation, month, priority
WD daily weather    lineitem x supplier x nation, per day; nations >= 20 under a station slug
C  catalogue        nation x region (nations >= 23 inactive)
   sites            the same facts per customer (energy) and per supplier (weather), so that regions and rows
                    grow with the tables
plus documents built from E and WD, so the document operators have real,
data-sized input whose flattened form is known exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampora.constants import BALANCE_ENDPOINT, BALANCE_SOURCE, WEATHER_SOURCE

# --- fixed values: fixture constants --------------------------------------
INGESTED_AT = "2024-01-01T00:00:00+00:00"
REINGESTED_AT = "2024-02-01T00:00:00+00:00"
LAST_UPDATE = "2024-06-30T12:00:00.000+02:00"
DATETIME_SUFFIX = "-01T00:00:00.000+01:00"
YEAR_END_STAMP = "-12-31T23:59:59+00:00"
FALLBACK_TS = "2024-03-01T00:00:00+00:00"
FIXTURE_CURATED = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
FIXTURE_RELATIONSHIPS = [
    ("1-URGENT", "A", "temperature_2m_mean_avg", "Average temperature", True),
    ("2-HIGH", "A", "wind_speed_10m_max_avg", "Average maximum wind speed", True),
    ("3-MEDIUM", "B", "precipitation_sum_total", "Total precipitation", True),
]
FIXTURE_LABELS = [("1-URGENT", "Urgent"), ("3-MEDIUM", "Medium")]
STATION_FROM_NATION = 20
INACTIVE_FROM_NATION = 23
COVERAGE_START_YEAR = 1995
COVERAGE_END_YEAR = 2001


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ym(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def energy_fact_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E plus ``n_nationkey`` (used as the geo id of a region)."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority",
                                                  "o_totalprice")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    m = (orders.join(customer, orders.o_custkey == customer.c_custkey)
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .groupBy(F.lower("n_name").alias("region_slug"), F.col("n_name").alias("region_name"),
                  "n_nationkey", _ym(F.col("o_orderdate")).alias("year_month"),
                  F.col("o_orderpriority").alias("metric_type"))
         .agg(F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 0)
              .alias("value")))
    w = Window.partitionBy("region_slug", "year_month")
    return m.select(
        "region_slug", "region_name", "n_nationkey", "year_month",
        F.when(F.col("metric_type").isin("1-URGENT", "2-HIGH"), F.lit("high"))
        .otherwise(F.lit("normal")).alias("group_type"),
        "metric_type", "value",
        F.round(F.col("value") / F.sum("value").over(w), 6).alias("percentage"))


def site_energy_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E with a region per customer, whose key is the geo id; the columns of ``energy_fact_ext``."""
    m = read(spark, sf_dir, "orders").groupBy(
        F.concat(F.lit("site_"), "o_custkey").alias("region_slug"), F.concat(F.lit("Site "), "o_custkey").alias("region_name"),
        F.col("o_custkey").alias("n_nationkey"), _ym(F.col("o_orderdate")).alias("year_month"),
        F.col("o_orderpriority").alias("metric_type")).agg(
        F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 0).alias("value"))
    w = Window.partitionBy("region_slug", "year_month")
    return m.select(
        "region_slug", "region_name", "n_nationkey", "year_month",
        F.when(F.col("metric_type").isin("1-URGENT", "2-HIGH"), F.lit("high")).otherwise(F.lit("normal")).alias("group_type"),
        "metric_type", "value", F.round(F.col("value") / F.sum("value").over(w), 6).alias("percentage"))


def site_weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WD with a region per supplier; the columns of ``weather_daily``."""
    li = read(spark, sf_dir, "lineitem")
    tmax, tmin = (F.round(f("l_discount") * 100, 0) for f in (F.max, F.min))
    k = F.col("l_suppkey")
    g = li.groupBy(k, F.to_date("l_shipdate").alias("d")).agg(
        tmax.alias("temperature_2m_max"), ((tmax + tmin) / 2).alias("temperature_2m_mean"), tmin.alias("temperature_2m_min"),
        F.round(F.sum("l_quantity"), 0).alias("precipitation_sum"), F.min("l_linenumber").cast("long").alias("weather_code"),
        F.round(F.max("l_tax") * 100, 0).alias("wind_speed_10m_max"),
        F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double"), 0).alias("shortwave_radiation_sum"))
    return g.select(
        F.lit(WEATHER_SOURCE).alias("source"), F.lit(INGESTED_AT).alias("ingestion_timestamp"),
        F.concat(F.lit("site_"), k).alias("region_slug"), F.concat(F.lit("Site "), k).alias("region_name"),
        F.concat(F.lit("Supplier "), k).alias("location_name"), (k % 180 - 90).cast("double").alias("latitude"),
        (k % 360 - 180).cast("double").alias("longitude"), F.lit("Europe/Madrid").alias("timezone"),
        F.lit("site").alias("weather_point_type"), F.date_format("d", "yyyy-MM-dd").alias("date"),
        "temperature_2m_max", "temperature_2m_mean", "temperature_2m_min", "precipitation_sum", "weather_code",
        "wind_speed_10m_max", "shortwave_radiation_sum")


def energy_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return energy_fact_ext(spark, sf_dir).drop("n_nationkey")


def weather_slug() -> Column:
    """Region of a nation's weather.  Nations from ``STATION_FROM_NATION`` on report
    under a station's slug, which no energy region has: left joins miss there."""
    slug = F.lower("n_name")
    return F.when(F.col("n_nationkey") < STATION_FROM_NATION, slug).otherwise(
        F.concat(slug, F.lit("_station")))


def weather_daily_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WD: one row per nation and ship date."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_discount", "l_quantity", "l_linenumber", "l_tax",
        "l_extendedprice")
    sup = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey"))
    tmax = F.round(F.max("l_discount") * 100, 0)
    tmin = F.round(F.min("l_discount") * 100, 0)
    return j.groupBy(weather_slug().alias("region_slug"), F.col("n_name").alias("region_name"),
                     F.to_date("l_shipdate").alias("date")).agg(
        tmax.alias("temperature_2m_max"),
        ((tmax + tmin) / 2).alias("temperature_2m_mean"),
        tmin.alias("temperature_2m_min"),
        F.round(F.sum("l_quantity"), 0).alias("precipitation_sum"),
        F.min("l_linenumber").cast("long").alias("weather_code"),
        F.round(F.max("l_tax") * 100, 0).alias("wind_speed_10m_max"),
        F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double"), 0)
        .alias("shortwave_radiation_sum"))


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region catalogue as text columns, the way a CSV with a header reads.

    The weather location of a region is named after its first supplier (a
    grouped ``min`` of the numeric key over ``supplier``, so the catalogue
    scan grows with the data and stays a hash aggregate), or
    '<nation> capital' when the nation has no supplier.
    """
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    loc = read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")) \
        .agg(F.concat(F.lit("Supplier "), F.min("s_suppkey").cast("string")).alias("_loc"))
    n = n.join(loc, "n_nationkey", "left")
    k = F.col("n_nationkey")
    active = (F.when(k >= INACTIVE_FROM_NATION, F.lit("FALSE"))
              .when(F.col("n_regionkey") == 0, F.lit(" True "))
              .when(F.col("n_regionkey") == 1, F.lit("TRUE"))
              .otherwise(F.lit("true")))
    tz = (F.when(F.col("r_name") == "EUROPE", F.lit("Europe/Madrid"))
          .when(F.col("r_name") == "AFRICA", F.lit("Africa/Ceuta"))
          .otherwise(F.lit("Atlantic/Canary")))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.lower("n_name").alias("region_slug"),
        F.col("n_name").alias("display_name"),
        F.lower("r_name").alias("region_type"),
        F.lit("ccaa").alias("redata_geo_limit"),
        k.cast("string").alias("redata_geo_id"),
        F.coalesce(F.col("_loc"), F.concat(F.col("n_name"), F.lit(" capital")))
        .alias("weather_location_name"),
        (k * 7.5 - 60.0).cast("string").alias("latitude"),
        (F.col("n_regionkey") * 45.0 - 90.0 + k * 0.5).cast("string").alias("longitude"),
        tz.alias("timezone"),
        F.lit("regional_capital").alias("weather_point_type"),
        active.alias("is_active"))


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WD with the nine envelope columns of a flattened weather document."""
    from ampora.sources.catalog import catalog_all
    cat = catalog_all(catalog_raw(spark, sf_dir)).select(
        F.col("display_name").alias("region_name"), F.col("weather_location_name").alias("location_name"), "latitude",
        "longitude", "timezone", "weather_point_type")
    wd = weather_daily_core(spark, sf_dir).join(cat, "region_name")
    return wd.select(
        F.lit(WEATHER_SOURCE).alias("source"), F.lit(INGESTED_AT).alias("ingestion_timestamp"),
        "region_slug", "region_name", "location_name", "latitude", "longitude", "timezone",
        "weather_point_type", F.date_format("date", "yyyy-MM-dd").alias("date"),
        "temperature_2m_max", "temperature_2m_mean", "temperature_2m_min", "precipitation_sum",
        "weather_code", "wind_speed_10m_max", "shortwave_radiation_sum")


# ---------------------------------------------------------------------------
# Documents.  One document per region and year: a bounded unit (12 months x
# metrics, or <= 366 days), so the collect_list calls below never gather an
# unbounded group.


def balance_payloads(spark: SparkSession, sf_dir: str, bad_measures: bool = False, energy: DataFrame | None = None) -> DataFrame:
    """Yearly balance payloads: (region_slug, region_name, geo_id, year, payload struct).

    ``bad_measures``: values and totals are delivered as text; '5-LOW' has no number in June, nor a total '2-HIGH' in 1993.
    ``energy``: the facts, by default those of the nations.
    """
    e = (energy_fact_ext(spark, sf_dir) if energy is None else energy).withColumn("year", F.substring("year_month", 1, 4))

    def value(c):
        if not bad_measures:
            return c
        return F.when((F.col("metric_type") == "5-LOW") & F.col("year_month").endswith("-06"), F.lit("abc")).otherwise(c.cast("string"))

    def total(c):
        if not bad_measures:
            return c
        return F.when((F.col("metric_type") == "2-HIGH") & (F.col("year") == "1993"), F.lit("n/a")).otherwise(c.cast("string"))

    rec_keys = ["region_slug", "region_name", "n_nationkey", "year", "group_type", "metric_type"]
    # records, blocks and payloads are all of one region and year: one shuffle serves the three.  Rows are few bytes but costly
    # to make documents of, so where regions grow with the tables the session's full width is used, not a task for each core
    width = [] if energy is None else [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    recs = e.repartition(*width, "region_slug", "year").groupBy(*rec_keys).agg(
        F.sort_array(F.collect_list(F.struct(
            F.concat("year_month", F.lit(DATETIME_SUFFIX)).alias("datetime"),
            value(F.col("value")).alias("value"), F.col("percentage")))).alias("values"),
        F.sum("value").alias("total"),
        F.count(F.lit(1)).cast("double").alias("total_percentage"))
    record = F.struct(
        F.col("metric_type").alias("type"), F.col("metric_type").alias("id"),
        F.col("group_type").alias("groupId"),
        F.struct(
            F.concat_ws(" ", "metric_type", "year").alias("title"),
            F.when(F.col("group_type") == "high", F.concat(F.lit("priority "), "metric_type"))
            .alias("description"),
            (F.col("group_type") == "high").alias("composite"),
            F.lit(LAST_UPDATE).alias("last-update"),
            total(F.col("total")).alias("total"), F.col("total_percentage").alias("total-percentage"),
            F.col("values")).alias("attributes"))
    blocks = recs.groupBy("region_slug", "region_name", "n_nationkey", "year", "group_type").agg(
        F.sort_array(F.collect_list(F.struct(F.col("metric_type").alias("_k"), record.alias("r"))))
        .alias("rs"))
    block = F.struct(
        F.col("group_type").alias("type"), F.col("group_type").alias("id"),
        F.struct(F.upper("group_type").alias("title"),
                 F.transform("rs", lambda x: x["r"]).alias("content")).alias("attributes"))
    return blocks.groupBy("region_slug", "region_name", "n_nationkey", "year").agg(
        F.sort_array(F.collect_list(F.struct(F.col("group_type").alias("_k"), block.alias("b"))))
        .alias("bs")).select(
        "region_slug", "region_name", F.col("n_nationkey").alias("geo_id"), "year",
        F.struct(F.transform("bs", lambda x: x["b"]).alias("included")).alias("payload"))


def balance_documents(spark: SparkSession, sf_dir: str, bad_measures: bool = False, energy: DataFrame | None = None) -> DataFrame:
    """Landed balance documents (JSON text), one per region and year; options: see ``balance_payloads``."""
    p = balance_payloads(spark, sf_dir, bad_measures, energy)
    env = F.struct(
        F.lit(BALANCE_SOURCE).alias("source"), F.lit(BALANCE_ENDPOINT).alias("endpoint"),
        "region_slug", "region_name", F.col("geo_id").alias("redata_geo_id"),
        F.concat(F.col("year"), F.lit("-01-01T00:00")).alias("requested_start_date"),
        F.concat(F.col("year"), F.lit("-12-31T23:59")).alias("requested_end_date"),
        F.array(F.col("year").cast("int")).alias("requested_years"),
        F.lit(INGESTED_AT).alias("extracted_at"), "payload")
    return p.select("region_slug", "year", F.to_json(env).alias("doc"))


def whole_balance_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One balance document per region with all its months, as a landing of one file per region holds."""
    flat = balance_flat(spark, sf_dir)
    value = F.struct("datetime", "value", "percentage")
    recs = flat.groupBy("region_slug", "region_name", "redata_geo_id", "group_id", "metric_id").agg(
        F.sort_array(F.collect_list(value)).alias("values"))
    record = F.struct(F.col("metric_id").alias("id"), F.col("metric_id").alias("type"), F.struct("values").alias("attributes"))
    blocks = recs.groupBy("region_slug", "region_name", "redata_geo_id", "group_id").agg(
        F.sort_array(F.collect_list(record)).alias("content"))
    block = F.struct(F.col("group_id").alias("id"), F.col("group_id").alias("type"), F.struct("content").alias("attributes"))
    docs = blocks.groupBy("region_slug", "region_name", "redata_geo_id").agg(F.sort_array(F.collect_list(block)).alias("included"))
    env = F.struct(F.lit(BALANCE_SOURCE).alias("source"), F.lit(BALANCE_ENDPOINT).alias("endpoint"), "region_slug", "region_name",
                   "redata_geo_id", F.lit(INGESTED_AT).alias("extracted_at"), F.struct("included").alias("payload"))
    return docs.select("region_slug", F.to_json(env, {"pretty": "true"}).alias("doc"))


def whole_weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather document per region with all its days."""
    from ampora.constants import DAILY_SERIES
    env = ["source", "region_slug", "region_name", "location_name", "latitude", "longitude", "timezone", "weather_point_type"]
    g = weather_daily(spark, sf_dir).groupBy(*env).agg(F.sort_array(F.collect_list(F.struct("date", *DAILY_SERIES))).alias("days"))
    daily = F.struct(F.transform("days", lambda d: d["date"]).alias("time"),
                     *[_series("days", s) for s in DAILY_SERIES])
    doc = F.struct(*env, F.lit(INGESTED_AT).alias("extracted_at"), F.struct(daily.alias("daily")).alias("payload"))
    return g.select("region_slug", F.to_json(doc, {"pretty": "true"}).alias("doc"))


def _series(days: str, name: str) -> Column:
    return F.transform(days, lambda d: d[name]).alias(name)


def weather_payload_columns(wd: DataFrame) -> DataFrame:
    """Per region and year: the envelope plus the daily arrays sorted by date."""
    from ampora.constants import DAILY_SERIES
    env = ["source", "ingestion_timestamp", "region_slug", "region_name", "location_name",
           "latitude", "longitude", "timezone", "weather_point_type"]
    g = (wd.withColumn("year", F.substring("date", 1, 4))
         .groupBy(*env, "year")
         .agg(F.sort_array(F.collect_list(F.struct("date", *DAILY_SERIES))).alias("days")))
    def field(name):
        return F.transform("days", lambda d: d[name])

    daily = [field("date").alias("time")] + [field(s).alias(s) for s in DAILY_SERIES]
    return g.select(*env, "year", *daily)


def weather_documents(spark: SparkSession, sf_dir: str, broken_region_key: int | None = None,
                      bad_elements: bool = False, daily: DataFrame | None = None) -> DataFrame:
    """Landed weather documents, one per region and year; ``daily``: the days, by default those of the nations.

    ``broken_region_key``: for nations of that TPC-H region the
    ``wind_speed_10m_max`` series loses its last element (a length defect).
    ``bad_elements``: on the 15th of a month of 1995 the ``temperature_2m_max`` is "bad", on the 20th of one of 1997 the
    ``weather_code`` is a fraction; on other days one is delivered as text, the other as a decimal.
    """
    from ampora.constants import DAILY_SERIES
    p = weather_payload_columns(weather_daily(spark, sf_dir) if daily is None else daily)
    if broken_region_key is not None:
        nation = read(spark, sf_dir, "nation").select(weather_slug().alias("region_slug"), "n_regionkey")
        p = p.join(nation, "region_slug")
        cut = F.slice("wind_speed_10m_max", 1, F.size("wind_speed_10m_max") - 1)
        p = p.withColumn("wind_speed_10m_max",
                         F.when(F.col("n_regionkey") == broken_region_key, cut)
                         .otherwise(F.col("wind_speed_10m_max"))).drop("n_regionkey")
    if bad_elements:
        p = p.withColumn("temperature_2m_max", F.transform(F.arrays_zip("time", "temperature_2m_max"), lambda x: F.when(
            x["time"].rlike("^1995-..-15"), F.lit("bad")).otherwise(x["temperature_2m_max"].cast("string"))))
        p = p.withColumn("weather_code", F.transform(F.arrays_zip("time", "weather_code"), lambda x: F.when(
            x["time"].rlike("^1997-..-20"), F.lit(1.5)).otherwise(x["weather_code"].cast("double"))))
    units = F.struct(*[F.lit("unit").alias(s) for s in DAILY_SERIES])
    payload = F.struct(F.struct("time", *DAILY_SERIES).alias("daily"), units.alias("daily_units"))
    env = F.struct(
        "source", "region_slug", "region_name", "location_name", "latitude", "longitude",
        "timezone", "weather_point_type",
        F.array(F.col("year").cast("int")).alias("requested_years"),
        F.concat(F.col("year"), F.lit(YEAR_END_STAMP)).alias("extracted_at"),
        payload.alias("payload"))
    return p.select("region_slug", "year", F.to_json(env).alias("doc"))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of mixed quality derived from ``events.props``.

    error -> object with an ``errors`` member, signup -> truncated (broken)
    JSON, click -> top-level array, view -> ``errors: null`` member,
    anything else -> the plain object.
    """
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "event_type", "props")
    p = F.col("props")
    doc = (F.when(F.col("event_type") == "error", F.concat(F.lit('{"errors": ['), p, F.lit("]}")))
           .when(F.col("event_type") == "signup", F.expr("substring(props, 1, length(props) - 1)"))
           .when(F.col("event_type") == "click", F.concat(F.lit("["), p, F.lit("]")))
           .when(F.col("event_type") == "view", F.concat(F.lit('{"errors": null, "data": '), p, F.lit("}")))
           .otherwise(p))
    return ev.select("event_id", "ts", "event_type", doc.alias("doc"))


def two_ingestions(flat: DataFrame) -> DataFrame:
    """First load of every row, then a re-delivery of '1-URGENT' with value + 1."""
    first = flat.withColumn("ingestion_timestamp", F.lit(INGESTED_AT))
    again = (flat.where(F.col("metric_type") == "1-URGENT")
             .withColumn("ingestion_timestamp", F.lit(REINGESTED_AT))
             .withColumn("value", F.col("value") + 1))
    return reduce(DataFrame.unionByName, [first, again])


def balance_flat(spark: SparkSession, sf_dir: str, energy: DataFrame | None = None) -> DataFrame:
    """The 22-column flat balance table that flattening ``balance_documents``
    yields, built directly from E (for load / dedup / staging jobs)."""
    e = (energy_fact_ext(spark, sf_dir) if energy is None else energy).withColumn("year", F.substring("year_month", 1, 4))
    w = Window.partitionBy("region_slug", "year", "metric_type")
    return e.select(
        F.lit(BALANCE_SOURCE).alias("source"), F.lit(BALANCE_ENDPOINT).alias("endpoint"),
        "region_slug", "region_name", F.col("n_nationkey").cast("long").alias("redata_geo_id"),
        F.lit(INGESTED_AT).alias("ingestion_timestamp"), "group_type",
        F.col("group_type").alias("group_id"), F.upper("group_type").alias("group_title"),
        "metric_type", F.col("metric_type").alias("metric_id"),
        F.col("group_type").alias("metric_group_id"),
        F.concat_ws(" ", "metric_type", "year").alias("metric_title"),
        F.when(F.col("group_type") == "high", F.concat(F.lit("priority "), "metric_type"))
        .alias("metric_description"),
        (F.col("group_type") == "high").alias("is_composite"),
        F.lit(LAST_UPDATE).alias("last_update"),
        F.sum("value").over(w).alias("total"),
        F.count(F.lit(1)).over(w).cast("double").alias("total_percentage"),
        "year_month", F.concat("year_month", F.lit(DATETIME_SUFFIX)).alias("datetime"),
        "value", "percentage")


def envelope_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance documents with envelope variants chosen by the nation's region:
    4 -> no wrapper (the payload is the document), 3 -> wrapper without
    source / endpoint / extracted_at, 2 -> wrapper without region_name,
    others -> full wrapper."""
    p = balance_payloads(spark, sf_dir)
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("geo_id"), "n_regionkey")
    p = p.join(nation, "geo_id")
    rk = F.col("n_regionkey")
    full = F.struct(F.lit(BALANCE_SOURCE).alias("source"), F.lit(BALANCE_ENDPOINT).alias("endpoint"),
                    "region_slug", "region_name", F.col("geo_id").alias("redata_geo_id"),
                    F.lit(INGESTED_AT).alias("extracted_at"), "payload")
    no_meta = F.struct("region_slug", "region_name", F.col("geo_id").alias("redata_geo_id"), "payload")
    no_name = F.struct(F.lit(BALANCE_SOURCE).alias("source"), F.lit(BALANCE_ENDPOINT).alias("endpoint"),
                       "region_slug", F.col("geo_id").alias("redata_geo_id"),
                       F.lit(INGESTED_AT).alias("extracted_at"), "payload")
    doc = (F.when(rk == 4, F.to_json("payload")).when(rk == 3, F.to_json(no_meta))
           .when(rk == 2, F.to_json(no_name)).otherwise(F.to_json(full)))
    return p.select("region_slug", "year", "geo_id", doc.alias("doc"))
