"""Registered queries: one per operator of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the driver's tables, plus the DuckDB
oracle SQL with identical column names."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampora.constants import BALANCE_KEY, DAILY_SERIES, NOT_NULL_TESTS
from ampora.functions.columns import round6, ts_text
from ampora.operators import analysis as an
from ampora.operators import coverage as cov
from ampora.operators.aggregate import daily_to_monthly
from ampora.operators.dedup import dedup_latest
from ampora.operators.flatten import (balance_envelope, flatten_balance, flatten_weather,
                                      measure_violations, weather_violations)
from ampora.operators.merge import merge_balance_years, merge_weather_years
from ampora.operators.models import curate, mart_energy_weather, stage_balance, stage_weather
from ampora.operators.quality import observed, observed_report
from ampora.plans import fixtures as fx
from ampora.plans import oracle as o
from ampora.plans.batch import CURATED, MART, RAW_BALANCE, STG_BALANCE, STG_WEATHER, run_batch
from ampora.schemas import BALANCE_FLAT, BALANCE_RAW, WEATHER_MONTHLY_RAW
from ampora.session import ensure_utc, scratch_path
from ampora.sinks import tables
from ampora.sinks import writers as wr
from ampora.sources import documents as docs_src
from ampora.sources.catalog import region_catalog
from ampora.sources.config import label_rows, relationship_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query (and its oracle).  Every query pins the session zone
    to UTC first: warehouse timestamps are instants rendered in UTC."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- shared building blocks ------------------------------------------------

def _catalog(spark, sf):
    return region_catalog(fx.catalog_raw(spark, sf))


def _monthly(spark, sf):
    return daily_to_monthly(fx.weather_daily(spark, sf))


def _mart(spark, sf):
    return mart_energy_weather(fx.energy_fact(spark, sf), _monthly(spark, sf))


def _curated(spark, sf):
    return curate(_mart(spark, sf), fx.FIXTURE_CURATED)


def _curated_w(spark, sf, extract=False):
    cur = _curated(spark, sf)
    if extract:
        cur = an.curated_extract(cur)
    return an.with_weather_value(cur, relationship_rows(fx.FIXTURE_RELATIONSHIPS))


_ECW = o.with_(o.E_EXT, o.C, o.WD, o.W, o.M, o.REL, o.CURW)
_MEASURE_LIST = [m.strip() for m in o.MEASURES.split(",")]

# --- sources ----------------------------------------------------------------


@register("region_catalog", o.with_(o.C) + "select * from c")
def q_region_catalog(spark, sf):
    return _catalog(spark, sf)


@register("latest_document", "select event_id, ts from events order by ts desc, event_id desc limit 1")
def q_latest_document(spark, sf):
    ev = fx.read(spark, sf, "events").select("event_id", "ts")
    return docs_src.latest_document(ev, "ts", "event_id")


_EVDOCS = """
with d as (
  select event_id, case
    when event_type = 'error' then '{"errors": [' || props || ']}'
    when event_type = 'signup' then substring(props, 1, length(props) - 1)
    when event_type = 'click' then '[' || props || ']'
    when event_type = 'view' then '{"errors": null, "data": ' || props || '}'
    else props end as doc
  from events),
p as (select event_id, doc, json_valid(doc) as parse_ok,
             case when json_valid(doc) then json_type(doc) = 'OBJECT' else false end as is_object
      from d)
"""


@register("parse_documents", _EVDOCS + "select event_id, parse_ok, is_object from p")
def q_parse_documents(spark, sf):
    d = docs_src.parse_documents(fx.event_documents(spark, sf))
    return d.select("event_id", "parse_ok", "is_object")


@register("payload_errors", _EVDOCS + """
select event_id, case when is_object then list_contains(json_keys(doc), 'errors') else false end
       as has_errors from p""")
def q_payload_errors(spark, sf):
    return docs_src.payload_errors(fx.event_documents(spark, sf)).select("event_id", "has_errors")


_REASON = """
, r as (select p.*, events.event_type, case when not parse_ok then 'invalid_json' when not is_object then 'not_an_object'
                    when list_contains(json_keys(case when is_object then doc else '{}' end), 'errors') then 'errors_member' end as reason
        from p join events using (event_id))
"""


def _routes(spark, sf):
    docs = docs_src.routed_documents(fx.event_documents(spark, sf).drop("ts"))
    return wr.write_routes(docs, scratch_path(spark, "routes"))


@register("routed_documents", _EVDOCS + _REASON + "select event_id, event_type, doc from r where reason is null")
def q_routed_documents(spark, sf):
    """The table of good documents of a write that fills it and the rejects in one pass."""
    return _routes(spark, sf).good


@register("routed_rejects", _EVDOCS + _REASON + "select event_id, event_type, doc, reason from r where reason is not null")
def q_routed_rejects(spark, sf):
    return _routes(spark, sf).rejects


# --- flatten ----------------------------------------------------------------

@register("envelope_defaults", o.with_(o.E_EXT) + f"""
select region_slug as doc_region, substr(year_month, 1, 4) as year,
       'redata' as source,
       '{o.BALANCE_ENDPOINT}' as endpoint,
       case when n_regionkey = 4 then '' else region_slug end as region_slug,
       case when n_regionkey in (2, 4) then '' else region_name end as region_name,
       case when n_regionkey = 4 then null else cast(e_ext.n_nationkey as bigint) end as redata_geo_id,
       case when n_regionkey in (3, 4) then '{fx.FALLBACK_TS}' else '{fx.INGESTED_AT}' end
         as ingestion_timestamp
from e_ext join nation on e_ext.n_nationkey = nation.n_nationkey
group by all""")
def q_envelope_defaults(spark, sf):
    env = balance_envelope(fx.envelope_documents(spark, sf), fx.FALLBACK_TS)
    return env.select(F.col("region_slug").alias("doc_region"), "year", "source", "endpoint",
                      F.col("region_slug_doc").alias("region_slug"), "region_name",
                      "redata_geo_id", "ingestion_timestamp")


_FLAT_COLS = ("source, endpoint, region_slug, region_name, redata_geo_id, ingestion_timestamp, "
              "group_type, group_id, group_title, metric_type, metric_id, metric_group_id, "
              "metric_title, metric_description, is_composite, last_update, total, "
              "total_percentage, year_month, datetime, value, percentage")


@register("flatten_balance", o.with_(o.E_EXT, o.FLAT) + f"select {_FLAT_COLS} from flat")
def q_flatten_balance(spark, sf):
    return flatten_balance(fx.balance_documents(spark, sf), fx.FALLBACK_TS)


@register("year_month_key", o.with_(o.E_EXT) + f"""
select distinct year_month || '{fx.DATETIME_SUFFIX}' as datetime, year_month,
       strftime({o.UTC_DT}, '%Y-%m') as utc_cast_month
from e_ext""")
def q_year_month_key(spark, sf):
    ensure_utc(spark)
    f = flatten_balance(fx.balance_documents(spark, sf), fx.FALLBACK_TS)
    return f.select("datetime", "year_month",
                    F.date_format(F.col("datetime").cast("timestamp"), "yyyy-MM")
                    .alias("utc_cast_month")).distinct()


_WD_COLS = ("source, ingestion_timestamp, region_slug, region_name, location_name, latitude, "
            "longitude, timezone, weather_point_type, date, temperature_2m_max, "
            "temperature_2m_mean, temperature_2m_min, precipitation_sum, weather_code, "
            "wind_speed_10m_max, shortwave_radiation_sum")
_WD_YEAR_TS = _WD_COLS.replace("ingestion_timestamp,",
                               f"substr(date, 1, 4) || '{fx.YEAR_END_STAMP}' as ingestion_timestamp,")


@register("flatten_weather", o.with_(o.C, o.WD) + f"select {_WD_YEAR_TS} from wd")
def q_flatten_weather(spark, sf):
    return flatten_weather(fx.weather_documents(spark, sf))


@register("series_length_violations", o.with_(o.C, o.WD) + """
select region_slug, substr(date, 1, 4) as year,
       '''payload.daily.wind_speed_10m_max'' has ' || cast(count(*) - 1 as varchar)
         || ' values, expected ' || cast(count(*) as varchar) as violation
from wd where n_regionkey = 1
group by region_slug, substr(date, 1, 4)""")
def q_series_length_violations(spark, sf):
    v = weather_violations(fx.weather_documents(spark, sf, broken_region_key=1))
    return v.select("region_slug", "year", "violation")


@register("typed_measure_violations", o.with_(o.E_EXT, o.FLAT) + """
, d as (select *, substr(year_month, 1, 4) as yr,
               row_number() over (partition by region_slug, metric_id, substr(year_month, 1, 4) order by year_month) - 1 as nth
        from flat)
select region_slug, yr as year, group_id, metric_id,
       'values[' || cast(nth as varchar) || '].value is not a number: "abc"' as violation
from d where metric_type = '5-LOW' and year_month like '%-06'
union all
select distinct region_slug, yr, group_id, metric_id, 'total is not a number: "n/a"'
from d where metric_type = '2-HIGH' and yr = '1993'""")
def q_typed_measure_violations(spark, sf):
    return measure_violations(fx.balance_documents(spark, sf, bad_measures=True))


@register("typed_measures_left_out", o.with_(o.E_EXT, o.FLAT) + f"""
select {_FLAT_COLS} from flat
where not (metric_type = '5-LOW' and year_month like '%-06') and not (metric_type = '2-HIGH' and year_month like '1993%')""")
def q_typed_measures_left_out(spark, sf):
    """Numbers that come as text load; values that are none are left out, all of them where a total is none."""
    return flatten_balance(fx.balance_documents(spark, sf, bad_measures=True), fx.FALLBACK_TS, strict=False)


@register("typed_series_violations", o.with_(o.C, o.WD) + """
, d as (select region_slug, substr(date, 1, 4) as year, date,
               cast(row_number() over (partition by region_slug, substr(date, 1, 4) order by date) - 1 as varchar) as nth
        from wd)
select region_slug, year, '''payload.daily.temperature_2m_max[' || nth || ']'' is not a number: "bad"' as violation
from d where date like '1995-%-15'
union all
select region_slug, year, '''payload.daily.weather_code[' || nth || ']'' is not a whole number: 1.5'
from d where date like '1997-%-20'""")
def q_typed_series_violations(spark, sf):
    v = weather_violations(fx.weather_documents(spark, sf, bad_elements=True))
    return v.select("region_slug", "year", "violation")


@register("typed_series_flatten", o.with_(o.C, o.WD) + f"""
select {_WD_YEAR_TS} from wd where substr(date, 1, 4) || region_slug not in (
  select substr(date, 1, 4) || region_slug from wd where date like '1995-%-15' or date like '1997-%-20')""")
def q_typed_series_flatten(spark, sf):
    """Documents whose series hold elements that are no numbers yield no rows; others' text and decimals load as numbers."""
    return flatten_weather(fx.weather_documents(spark, sf, bad_elements=True), strict=False)


# --- merge --------------------------------------------------------------------

@register("merge_balance_years", o.with_(o.E_EXT, o.FLAT) + """
, d as (select *, substr(year_month, 1, 4) as yr from flat),
two as (select * from d union all select * from d where n_nationkey = 1 and yr = '1996'),
ry as (select n_nationkey, group_id, metric_id, min(yr) as first_year,
              count(distinct yr) + max(case when n_nationkey = 1 and yr = '1996' then 1 else 0 end) as n_payloads
       from d group by n_nationkey, group_id, metric_id)
select source, endpoint, case when f.n_nationkey = 2 then '' else region_slug end as region_slug, region_name,
       redata_geo_id, ingestion_timestamp, group_type, f.group_id, group_title, metric_type, f.metric_id,
       metric_group_id, metric_type || ' ' || first_year as metric_title, metric_description,
       is_composite, last_update,
       case when n_payloads = 1 then total end as total,
       case when n_payloads = 1 then total_percentage end as total_percentage,
       year_month, datetime, value, percentage
from two f join ry on f.n_nationkey = ry.n_nationkey and f.group_id = ry.group_id
                  and f.metric_id = ry.metric_id""")
def q_merge_balance_years(spark, sf):
    """One region's documents have no slug, neither in the landing nor inside, and one region delivers a year twice."""
    d = fx.balance_documents(spark, sf).select(
        F.when(F.col("region_slug") != "nation_2", F.col("region_slug")).alias("region_slug"), "year",
        F.replace("doc", F.lit('"region_slug":"nation_2",'), F.lit("")).alias("doc"))
    again = d.where("region_slug = 'nation_1' AND year = '1996'")
    docs = d.unionByName(again).drop("year")
    return merge_balance_years(docs, fallback_ts=fx.FALLBACK_TS).select(*BALANCE_FLAT.fieldNames())


@register("merge_weather_years", o.with_(o.C, o.WD) + f"""
, fy as (select region_slug as rs, min(substr(date, 1, 4)) as fy from wd group by region_slug)
select * replace (case when region_slug <> 'nation_3' then region_slug end as region_slug) from (
select {_WD_COLS.replace('ingestion_timestamp,', "fy || '" + fx.YEAR_END_STAMP + "' as ingestion_timestamp,")}
from wd join fy on wd.region_slug = fy.rs)""")
def q_merge_weather_years(spark, sf):
    """One region's documents have no slug."""
    docs = fx.weather_documents(spark, sf)
    return merge_weather_years(docs.withColumn("doc", F.replace("doc", F.lit('"region_slug":"nation_3",'), F.lit("")))
                               .drop("region_slug", "year"))


# --- aggregation, dedup, staging, loads -------------------------------------

_W_COLS = ("source, ingestion_timestamp, region_slug, region_name, location_name, latitude, "
           "longitude, timezone, weather_point_type, year_month, " + o.MEASURES)


@register("monthly_weather", o.with_(o.C, o.WD, o.W) + f"select {_W_COLS} from w")
def q_monthly_weather(spark, sf):
    return _monthly(spark, sf)


_TWO_LOADS = o.with_(o.E_EXT, o.FLAT) + f"""
, two as (
  select region_slug, metric_id, datetime, metric_type, group_type, year_month,
         '{fx.INGESTED_AT}' as ingestion_timestamp, value from flat
  union all
  select region_slug, metric_id, datetime, metric_type, group_type, year_month,
         '{fx.REINGESTED_AT}' as ingestion_timestamp, value + 1 from flat where metric_type = '1-URGENT')
"""
_NEWEST_PER_KEY = o.with_(o.E_EXT, o.FLAT) + f"""
select region_slug, metric_id, datetime,
       case when metric_type = '1-URGENT' then '{fx.REINGESTED_AT}' else '{fx.INGESTED_AT}' end
         as ingestion_timestamp,
       case when metric_type = '1-URGENT' then value + 1 else value end as value
from flat"""


def _two_ingestions(spark, sf):
    return fx.two_ingestions(fx.balance_flat(spark, sf))


@register("dedup_latest", _NEWEST_PER_KEY)
def q_dedup_latest(spark, sf):
    d = dedup_latest(_two_ingestions(spark, sf), BALANCE_KEY)
    return d.select("region_slug", "metric_id", "datetime", "ingestion_timestamp", "value")


@register("stg_balance", o.with_(o.E_EXT, o.FLAT) + f"""
select region_slug, metric_id, metric_type, group_type, year_month,
       {o.ts_text(o.UTC_DT)} as datetime,
       case when metric_type = '1-URGENT' then '2024-02-01 00:00:00' else '2024-01-01 00:00:00' end
         as ingestion_timestamp,
       case when metric_type = '1-URGENT' then value + 1 else value end as value,
       percentage, redata_geo_id
from flat""")
def q_stg_balance(spark, sf):
    ensure_utc(spark)
    raw = wr.conform(_two_ingestions(spark, sf), BALANCE_RAW)
    s = stage_balance(raw)
    return s.select("region_slug", "metric_id", "metric_type", "group_type", "year_month",
                    ts_text(F.col("datetime")).alias("datetime"),
                    ts_text(F.col("ingestion_timestamp")).alias("ingestion_timestamp"),
                    "value", "percentage", "redata_geo_id")


def _two_monthly(spark, sf):
    w = _monthly(spark, sf)
    again = (w.where(F.col("year_month") >= "1998-01")
             .withColumn("ingestion_timestamp", F.lit(fx.REINGESTED_AT))
             .withColumn("precipitation_sum_total", F.col("precipitation_sum_total") + 1))
    return w.unionByName(again)


@register("stg_weather", o.with_(o.C, o.WD, o.W) + f"""
select source, case when year_month >= '1998-01' then '2024-02-01 00:00:00'
                    else '2024-01-01 00:00:00' end as ingestion_timestamp,
       region_slug, region_name, location_name, latitude, longitude, timezone,
       weather_point_type, year_month, temperature_2m_max_avg, temperature_2m_mean_avg,
       temperature_2m_min_avg,
       case when year_month >= '1998-01' then precipitation_sum_total + 1
            else precipitation_sum_total end as precipitation_sum_total,
       wind_speed_10m_max_avg, shortwave_radiation_sum_total
from w""")
def q_stg_weather(spark, sf):
    ensure_utc(spark)
    s = stage_weather(wr.conform(_two_monthly(spark, sf), WEATHER_MONTHLY_RAW))
    return s.withColumn("ingestion_timestamp", ts_text(F.col("ingestion_timestamp")))


def _loaded_raw(spark, sf):
    path = scratch_path(spark, "raw_balance")
    flat = _two_ingestions(spark, sf)
    wr.append_load(flat.where(F.col("ingestion_timestamp") == fx.INGESTED_AT), path, BALANCE_RAW)
    wr.append_load(flat.where(F.col("ingestion_timestamp") == fx.REINGESTED_AT), path, BALANCE_RAW)
    return path


@register("append_load", _TWO_LOADS + """
select region_slug, metric_id, year_month,
       case when ingestion_timestamp = '2024-01-01T00:00:00+00:00' then '2024-01-01 00:00:00'
            else '2024-02-01 00:00:00' end as ingestion_timestamp, value from two""")
def q_append_load(spark, sf):
    ensure_utc(spark)
    t = wr.read_table(spark, _loaded_raw(spark, sf), BALANCE_RAW)
    return t.select("region_slug", "metric_id", "year_month",
                    ts_text(F.col("ingestion_timestamp")).alias("ingestion_timestamp"), "value")


@register("load_row_count", _TWO_LOADS + """
select 'redata_balance_electrico' as table_name, count(*) as n_rows from two""")
def q_load_row_count(spark, sf):
    t = wr.read_table(spark, _loaded_raw(spark, sf), BALANCE_RAW)
    return t.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("redata_balance_electrico").alias("table_name"), "n_rows")


@register("dedup_rewrite", o.with_(o.E_EXT, o.FLAT) + """
select region_slug, metric_id, year_month,
       case when metric_type = '1-URGENT' then '2024-02-01 00:00:00' else '2024-01-01 00:00:00' end
         as ingestion_timestamp,
       case when metric_type = '1-URGENT' then value + 1 else value end as value
from flat""")
def q_dedup_rewrite(spark, sf):
    ensure_utc(spark)
    src = _loaded_raw(spark, sf)
    t = wr.dedup_rewrite(spark, src, scratch_path(spark, "raw_balance_dedup"), BALANCE_KEY, BALANCE_RAW)
    return t.select("region_slug", "metric_id", "year_month",
                    ts_text(F.col("ingestion_timestamp")).alias("ingestion_timestamp"), "value")


def _database(spark):
    """A new database, under the shared folder."""
    name = f"ampora_query_{uuid.uuid4().hex[:12]}"
    tables.create_database(spark, name)
    return name


@register("dedup_table", ORACLE["dedup_rewrite"])
def q_dedup_table(spark, sf):
    """Load, rewrite, load again and rewrite again, all under one table name."""
    db = _database(spark)
    flat = _two_ingestions(spark, sf)
    for stamp in (fx.INGESTED_AT, fx.REINGESTED_AT):
        wr.append_load_table(spark, flat.where(F.col("ingestion_timestamp") == stamp), RAW_BALANCE, BALANCE_RAW, db)
        wr.dedup_table(spark, f"{db}.{RAW_BALANCE}", BALANCE_KEY)
    t = spark.table(f"{db}.{RAW_BALANCE}")
    return t.select("region_slug", "metric_id", "year_month",
                    ts_text(F.col("ingestion_timestamp")).alias("ingestion_timestamp"), "value")


@register("append_load_table", _TWO_LOADS + """
select region_slug, metric_id, year_month,
       case when ingestion_timestamp = '2024-01-01T00:00:00+00:00' then '2024-01-01 00:00:00'
            else '2024-02-01 00:00:00' end as ingestion_timestamp, value,
       case when ingestion_timestamp <> '2024-01-01T00:00:00+00:00' then metric_id || '!' end as checked_by
from two""")
def q_append_load_table(spark, sf):
    """Two loads into a catalog table; the second has a column that the table lacks."""
    db = _database(spark)
    flat = _two_ingestions(spark, sf)
    wr.append_load_table(spark, flat.where(F.col("ingestion_timestamp") == fx.INGESTED_AT), RAW_BALANCE, BALANCE_RAW, db)
    more = flat.where(F.col("ingestion_timestamp") == fx.REINGESTED_AT).withColumn("checked_by", F.concat("metric_id", F.lit("!")))
    wr.append_load_table(spark, more, RAW_BALANCE, BALANCE_RAW, db)
    t = spark.table(f"{db}.{RAW_BALANCE}")
    return t.select("region_slug", "metric_id", "year_month",
                    ts_text(F.col("ingestion_timestamp")).alias("ingestion_timestamp"), "value", "checked_by")


_UPSERT_SQL = o.with_(o.E_EXT, o.FLAT) + """
select region_slug, metric_id, year_month,
       case when metric_type = '1-URGENT' then '2024-02-01 00:00:00' else '2024-01-01 00:00:00' end
         as ingestion_timestamp,
       case when metric_type = '1-URGENT' then value + 1 else value end as value
from flat"""


@register("upsert_rewrite", _UPSERT_SQL + """
union all
select region_slug, metric_id, nullif(year_month, year_month), '2024-02-01 00:00:00', value + 1
from flat where metric_type = '1-URGENT' and n_nationkey = 0 and year_month = '1995-03'""")
def q_upsert_rewrite(spark, sf):
    """Two loads upserted into a month-partitioned raw table: only the months
    each load touches are rewritten.  The second load delivers the same instants in another
    offset, and one value without a datetime, twice."""
    name = f"{_database(spark)}.{RAW_BALANCE}"
    # loads arrive as processed tables (written once), as in the batch flow
    processed = scratch_path(spark, "processed_balance_loads")
    wr.write_processed(_two_ingestions(spark, sf), processed)
    flat = spark.read.parquet(processed)
    again = flat.where(F.col("ingestion_timestamp") == fx.REINGESTED_AT)
    undated = again.where("redata_geo_id = 0 AND year_month = '1995-03'").withColumns(
        {"year_month": F.lit(None).cast("string"), "datetime": F.lit(None).cast("string")})
    # the month starts an hour earlier in UTC
    shifted = again.withColumn("datetime", F.date_format(
        F.to_timestamp("datetime"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    loads = (flat.where(F.col("ingestion_timestamp") == fx.INGESTED_AT),
             shifted.unionByName(undated).unionByName(undated))
    for rows in loads:
        wr.upsert_latest(spark, wr.conform(rows, BALANCE_RAW), name, BALANCE_KEY, wr.utc_month("datetime"))
    t = spark.table(name)
    return t.select("region_slug", "metric_id", F.col("year_month").cast("string").alias("year_month"),
                    ts_text(F.col("ingestion_timestamp")).alias("ingestion_timestamp"), "value")


@register("processed_roundtrip", o.with_(o.E_EXT, o.FLAT) + f"select {_FLAT_COLS} from flat")
def q_processed_roundtrip(spark, sf):
    path = scratch_path(spark, "processed_balance")
    wr.write_processed(flatten_balance(fx.balance_documents(spark, sf), fx.FALLBACK_TS), path)
    return spark.read.parquet(path)


@register("landing_replace", o.with_(o.E_EXT) + f"""
select e_ext.region_slug, year_month, metric_type, value,
       case when n_regionkey = 0 then '{fx.REINGESTED_AT}' else '{fx.INGESTED_AT}' end
         as ingestion_timestamp
from e_ext join nation on e_ext.n_nationkey = nation.n_nationkey""")
def q_landing_replace(spark, sf):
    root = scratch_path(spark, "landing_balance")
    d = fx.balance_documents(spark, sf)
    wr.write_landing(d, root)
    nation = fx.read(spark, sf, "nation").select(F.lower("n_name").alias("region_slug"), "n_regionkey")
    redo = (d.join(nation.where(F.col("n_regionkey") == 0), "region_slug", "left_semi")
            .withColumn("doc", F.replace("doc", F.lit(fx.INGESTED_AT), F.lit(fx.REINGESTED_AT))))
    wr.write_landing(redo, root)
    f = flatten_balance(docs_src.scan_documents(spark, root), fx.FALLBACK_TS)
    return f.select("region_slug", "year_month", "metric_type", "value", "ingestion_timestamp")


@register("scan_raw_balance", o.with_(o.E_EXT, o.FLAT) + f"select {_FLAT_COLS} from flat")
def q_scan_raw_balance(spark, sf):
    root = scratch_path(spark, "landing_balance")
    wr.write_landing(fx.balance_documents(spark, sf), root)
    return flatten_balance(docs_src.scan_documents(spark, root), fx.FALLBACK_TS)


@register("scan_raw_weather", o.with_(o.C, o.WD) + f"select {_WD_YEAR_TS} from wd")
def q_scan_raw_weather(spark, sf):
    root = scratch_path(spark, "landing_weather")
    wr.write_landing(fx.weather_documents(spark, sf), root)
    return flatten_weather(docs_src.scan_documents(spark, root))


_THREE_WAYS = """
select 'all' as chosen_by, * from {0} union all
select 'regions', * from {0} where region_slug in ('nation_3', 'nation_8') union all
select 'file', * from {0} where region_slug = 'nation_12'"""


def _three_ways(spark, folder, pattern, flat):
    """A landing of one file per region read whole, by a list of regions, and by a file's name."""
    ways = {"all": {}, "regions": {"region_slugs": ["nation_8", "nation_3", "nation_8"]},
            "file": {"file_name": pattern.format(slug="nation_12")}}
    parts = [flat(docs_src.scan_named_documents(spark, folder, pattern, **how)).select(F.lit(by).alias("chosen_by"), "*")
             for by, how in ways.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("scan_named_balance", o.with_(o.E_EXT, o.FLAT) + """
, b as (select region_slug, region_name, redata_geo_id, ingestion_timestamp, group_id, metric_id, year_month, datetime, value, percentage
        from flat)""" + _THREE_WAYS.format("b"))
def q_scan_named_balance(spark, sf):
    """One pretty-printed document per file, named after its region; the second write replaces the files of some regions."""
    folder = scratch_path(spark, "named_balance")
    docs = fx.whole_balance_documents(spark, sf)
    stale = docs.where(F.col("region_slug").like("nation_1%")).withColumn("doc", F.lit("{}"))
    wr.write_named_documents(stale, folder, docs_src.BALANCE_FILE_PATTERN)
    wr.write_named_documents(docs, folder, docs_src.BALANCE_FILE_PATTERN)
    return _three_ways(spark, folder, docs_src.BALANCE_FILE_PATTERN, lambda d: flatten_balance(d, fx.FALLBACK_TS).select(
        "region_slug", "region_name", "redata_geo_id", "ingestion_timestamp", "group_id", "metric_id", "year_month", "datetime",
        "value", "percentage"))


@register("scan_named_weather", o.with_(o.C, o.WD) + f", b as (select {_WD_COLS} from wd)" + _THREE_WAYS.format("b"))
def q_scan_named_weather(spark, sf):
    folder = scratch_path(spark, "named_weather")
    wr.write_named_documents(fx.whole_weather_documents(spark, sf), folder, docs_src.WEATHER_FILE_PATTERN)
    return _three_ways(spark, folder, docs_src.WEATHER_FILE_PATTERN, flatten_weather)


# --- coverage and conformance --------------------------------------------------

_SELECTED = ["nation_1", "nation_6", "nation_11", "nation_16", "nation_21"]
_SEL_SQL = ", ".join(f"'{s}'" for s in _SELECTED)
_E7 = "region_slug, region_name, year_month, group_type, metric_type, value, percentage"


@register("select_regions", o.with_(o.E_EXT, o.C) + f"""
select {_E7} from e where region_slug in ({_SEL_SQL})""")
def q_select_regions(spark, sf):
    return cov.select_regions(fx.energy_fact(spark, sf), _catalog(spark, sf), _SELECTED)


@register("unknown_regions", o.with_(o.E_EXT, o.C) + f"""
select {_E7} from e where region_slug not in (select region_slug from c)""")
def q_unknown_regions(spark, sf):
    return cov.unknown_regions(fx.energy_fact(spark, sf), _catalog(spark, sf))


_GRID = o.with_(o.C) + f"""
, grid as (
  select region_slug, cast(y.year as integer) as year,
         cast(y.year as varchar) || '-01-01T00:00' as balance_start,
         cast(y.year as varchar) || '-12-31T23:59' as balance_end,
         cast(y.year as varchar) || '-01-01' as weather_start,
         cast(y.year as varchar) || '-12-31' as weather_end,
         redata_geo_id, latitude, longitude, timezone
  from c, range({fx.COVERAGE_START_YEAR}, {fx.COVERAGE_END_YEAR + 1}) y(year))
"""


def _grid(spark, sf):
    return cov.coverage_grid(_catalog(spark, sf), fx.COVERAGE_START_YEAR, fx.COVERAGE_END_YEAR)


@register("coverage_grid", _GRID + "select * from grid")
def q_coverage_grid(spark, sf):
    return _grid(spark, sf)


@register("coverage_gaps", o.with_(o.C, o.WD, o.W) + f"""
, months as (
  select region_slug, strftime(m, '%Y-%m') as year_month
  from c, range(date '{fx.COVERAGE_START_YEAR}-01-01', date '{fx.COVERAGE_END_YEAR}-12-02',
                interval 1 month) t(m))
select region_slug, year_month from months
where not exists (select 1 from w where w.region_slug = months.region_slug
                                   and w.year_month = months.year_month)""")
def q_coverage_gaps(spark, sf):
    return cov.coverage_gaps(_catalog(spark, sf), _monthly(spark, sf),
                             fx.COVERAGE_START_YEAR, fx.COVERAGE_END_YEAR)


@register("range_violations", _GRID + """
select region_slug, year, 'latitude' as rule from grid where not (latitude between -90 and 90)
union all
select region_slug, year, 'longitude' as rule from grid where not (longitude between -180 and 180)""")
def q_range_violations(spark, sf):
    return cov.range_violations(_grid(spark, sf), DAILY_SERIES)


@register("extract_completeness", _GRID + "," + o.WD + """
, req as (select region_slug, count(*) as requested_n from grid group by region_slug),
dl as (select region_slug, count(distinct substr(date, 1, 4)) as delivered_n from wd
       group by region_slug),
j as (select coalesce(req.region_slug, dl.region_slug) as region_slug,
             coalesce(requested_n, 0) as requested_n, coalesce(delivered_n, 0) as delivered_n
      from req full outer join dl on req.region_slug = dl.region_slug)
select region_slug, cast(requested_n as bigint) as requested_n,
       cast(delivered_n as bigint) as delivered_n
from j where requested_n <> delivered_n""")
def q_extract_completeness(spark, sf):
    delivered = fx.weather_documents(spark, sf).select("region_slug")
    return cov.extract_completeness(_grid(spark, sf).select("region_slug"), delivered)


# --- models -------------------------------------------------------------------


@register("mart_energy_weather", _ECW + "select * from m")
def q_mart(spark, sf):
    return _mart(spark, sf)


@register("mart_curated", _ECW + "select * from cur")
def q_mart_curated(spark, sf):
    return _curated(spark, sf)


@register("curated_extract", _ECW + f"""
select region_slug, region_name, cast(year_month || '-01' as date) as year_month, group_type,
       metric_type, value, percentage, {o.MEASURES}
from cur order by region_name, year_month, metric_type""")
def q_curated_extract(spark, sf):
    return an.curated_extract(_curated(spark, sf))


@register("relationship_lookup", _ECW + """
select distinct m.metric_type, coalesce(rel.relationship_group, 'C') as relationship_group,
       coalesce(rel.weather_column, 'temperature_2m_mean_avg') as weather_column,
       coalesce(rel.weather_label, 'Average temperature') as weather_label,
       coalesce(rel.show_scatter, false) as show_scatter
from m left join rel on m.metric_type = rel.metric_type""")
def q_relationship_lookup(spark, sf):
    metrics = _mart(spark, sf).select("metric_type").distinct()
    return an.with_relationship(metrics, relationship_rows(fx.FIXTURE_RELATIONSHIPS))


@register("metric_weather_value", _ECW + """
select region_slug, year_month, metric_type, weather_column, weather_value from cv""")
def q_metric_weather_value(spark, sf):
    return _curated_w(spark, sf).select("region_slug", "year_month", "metric_type",
                                        "weather_column", "weather_value")


# --- analysis -----------------------------------------------------------------

_SLICE = ("NATION_7", "1-URGENT", "1996-01", "1998-12")


@register("slice_filter", _ECW + f"""
select region_slug, region_name, cast(year_month || '-01' as date) as year_month, group_type,
       metric_type, value, percentage, {o.MEASURES}
from cur where region_name = '{_SLICE[0]}' and metric_type = '{_SLICE[1]}'
  and year_month between '{_SLICE[2]}' and '{_SLICE[3]}'""")
def q_slice_filter(spark, sf):
    ext = an.curated_extract(_curated(spark, sf))
    return an.slice_filter(ext, _SLICE[0], _SLICE[1], F.to_date(F.lit(_SLICE[2] + "-01")),
                           F.to_date(F.lit(_SLICE[3] + "-01")))


@register("slice_kpis", _ECW + """
select region_name, metric_type, count(distinct year_month) as n_months,
       round(avg(value), 6) as avg_value, round(avg(weather_value), 6) as avg_weather,
       format('{:,.1f}', avg(value)) as avg_value_text, format('{:,.1f}', avg(weather_value)) as avg_weather_text
from cv group by region_name, metric_type""")
def q_slice_kpis(spark, sf):
    k = an.slice_kpis(_curated_w(spark, sf))
    return k.select("region_name", "metric_type", "n_months", round6(F.col("avg_value")).alias("avg_value"),
                    round6(F.col("avg_weather")).alias("avg_weather"), "avg_value_text", "avg_weather_text")


@register("share_kpi", _ECW + """
, p as (select region_name, metric_type,
               case when metric_type = '2-HIGH' then percentage * 100 else percentage end as percentage
        from cv where percentage is not null),
a as (select region_name, metric_type, avg(percentage) as mn, max(abs(percentage)) as mx
        from p group by region_name, metric_type)
select region_name, metric_type,
       round(case when mx <= 1 then mn * 100 else mn end, 6) as share_pct,
       format('{:,.1f}', case when mx <= 1 then mn * 100 else mn end) || '%' as share_text
from a""")
def q_share_kpi(spark, sf):
    """One metric delivers percentages, so both branches of the scale rule run."""
    rows = _curated_w(spark, sf).withColumn("percentage", F.when(
        F.col("metric_type") == "2-HIGH", F.col("percentage") * 100).otherwise(F.col("percentage")))
    s = an.share_kpi(rows)
    return s.select("region_name", "metric_type", round6(F.col("share_pct")).alias("share_pct"), "share_text")


@register("summary_stats", _ECW + """
select region_name, metric_type, 'energy' as series, round(avg(value), 6) as mean,
       min(value) as min, max(value) as max, round(stddev_samp(value), 6) as std
from cv group by region_name, metric_type
union all
select region_name, metric_type, 'weather' as series, round(avg(weather_value), 6) as mean,
       min(weather_value) as min, max(weather_value) as max,
       round(stddev_samp(weather_value), 6) as std
from cv group by region_name, metric_type""")
def q_summary_stats(spark, sf):
    s = an.summary_stats(_curated_w(spark, sf))
    return s.select("region_name", "metric_type", "series", round6(F.col("mean")).alias("mean"),
                    "min", "max", round6(F.col("std")).alias("std"))


_CORR_SQL = _ECW + """
, g as (
  select region_name, metric_type, min(weather_column) as weather_column,
         count(case when value is not null and weather_value is not null then 1 end) as n_pairs,
         covar_samp(value, weather_value) as cv_,
         stddev_samp(case when weather_value is not null then value end) as sx,
         stddev_samp(case when value is not null then weather_value end) as sy
  from cv group by region_name, metric_type)
select region_name, metric_type, weather_column, n_pairs,
       round(case when sx * sy = 0 then null else cv_ / (sx * sy) end, 6) as pearson_correlation
from g"""


@register("energy_weather_corr", _CORR_SQL)
def q_energy_weather_corr(spark, sf):
    c = an.energy_weather_corr(_curated_w(spark, sf))
    return c.select("region_name", "metric_type", "weather_column", "n_pairs",
                    round6(F.col("pearson_correlation")).alias("pearson_correlation"))


@register("filter_options", _ECW + """
select distinct 'region' as option_kind, region_name as option_value from cur where region_name is not null
union all
select distinct 'metric', metric_type from cur where metric_type is not null
union all
select distinct 'month', year_month from cur where year_month is not null""")
def q_filter_options(spark, sf):
    return an.filter_options(_curated(spark, sf))


@register("period_bounds", _ECW + """
select min(year_month) as first_month, max(year_month) as last_month from cur""")
def q_period_bounds(spark, sf):
    return an.period_bounds(_curated(spark, sf))


@register("monthly_detail", _ECW + """
select year_month, region_name,
       case metric_type when '1-URGENT' then 'Urgent' when '3-MEDIUM' then 'Medium' else metric_type end
         as metric_label, value, weather_label, weather_value
from cv""")
def q_monthly_detail(spark, sf):
    return an.monthly_detail(_curated_w(spark, sf, extract=True), label_rows(fx.FIXTURE_LABELS))


@register("series_long", _ECW + """
select region_name, metric_type, cast(year_month || '-01' as date) as year_month,
       'energy' as series, value as y from cv
union all
select region_name, metric_type, cast(year_month || '-01' as date) as year_month,
       'weather' as series, weather_value as y from cv""")
def q_series_long(spark, sf):
    return an.series_long(_curated_w(spark, sf, extract=True))


@register("scatter_pairs", _ECW + """
select region_name, cast(year_month || '-01' as date) as year_month, metric_type,
       weather_column, weather_value, value
from cv where show_scatter""")
def q_scatter_pairs(spark, sf):
    return an.scatter_pairs(_curated_w(spark, sf, extract=True))


@register("metric_labels", o.with_(o.E_EXT) + """
select distinct nullif(metric_type, '5-LOW') as metric_type,
       case metric_type when '1-URGENT' then 'Urgent' when '3-MEDIUM' then 'Medium' when '5-LOW' then ''
                        else metric_type end as metric_label
from e""")
def q_metric_labels(spark, sf):
    e = fx.energy_fact(spark, sf).select(
        F.when(F.col("metric_type") != "5-LOW", F.col("metric_type")).alias("metric_type")).distinct()
    return an.metric_labels(e, label_rows(fx.FIXTURE_LABELS))


# --- data quality -------------------------------------------------------------


@register("not_null_report", _ECW + """
, s as (select count(*) filter (where metric_type = '5-LOW') as n_low from e)
select 'stg_redata_balance_electrico' as model, col as column_name,
       case when col = 'metric_type' then n_low else 0 end as failures,
       case when col = 'metric_type' then n_low = 0 else true end as passed
from s, (values ('region_slug'), ('year_month'), ('datetime'), ('metric_type'), ('group_type')) t(col)
union all
select 'stg_openmeteo_monthly', col, 0, true
from (values ('region_slug'), ('year_month'), ('location_name')) t(col)
union all
select 'mart_energy_weather_monthly', col,
       case when col = 'metric_type' then n_low else 0 end,
       case when col = 'metric_type' then n_low = 0 else true end
from s, (values ('region_slug'), ('year_month'), ('metric_type')) t(col)
union all
select 'mart_energy_weather_monthly_curated', col, 0, true
from (values ('region_slug'), ('year_month'), ('metric_type'), ('value')) t(col)""")
def q_not_null_report(spark, sf):
    """Data tests over the four models: the counts are metrics of the writes of the staging tables and marts, so no
    table is scanned for them."""
    flat = fx.balance_flat(spark, sf).withColumn(
        "metric_type", F.when(F.col("metric_type") != "5-LOW", F.col("metric_type")))
    metrics = {}

    def saved(df, model):
        df, metrics[model] = observed(df, model, dict(NOT_NULL_TESTS)[model])
        path = scratch_path(spark, model)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    stg_b = saved(stage_balance(wr.conform(flat, BALANCE_RAW)), STG_BALANCE)
    stg_w = saved(stage_weather(wr.conform(_monthly(spark, sf), WEATHER_MONTHLY_RAW)), STG_WEATHER)
    mart = saved(mart_energy_weather(stg_b, stg_w), MART)
    saved(curate(mart, fx.FIXTURE_CURATED), CURATED)
    return observed_report(spark, metrics)


# --- sites: regions and rows that grow with the tables -----------------------------


@register("site_flatten_balance", o.with_(o.E_SITE, o.FLAT) + f"select {_FLAT_COLS} from flat")
def q_site_flatten_balance(spark, sf):
    return flatten_balance(fx.balance_documents(spark, sf, energy=fx.site_energy_ext(spark, sf)), fx.FALLBACK_TS)


@register("site_flatten_weather", o.with_(o.WD_SITE) + f"select {_WD_YEAR_TS} from wd")
def q_site_flatten_weather(spark, sf):
    return flatten_weather(fx.weather_documents(spark, sf, daily=fx.site_weather_daily(spark, sf)))


@register("site_merge_balance_years", o.with_(o.E_SITE, o.FLAT) + """
, n as (select region_slug as rs, metric_id as mid, count(distinct substr(year_month, 1, 4)) as n_payloads,
               min(substr(year_month, 1, 4)) as first_year
        from flat group by region_slug, metric_id)
select region_slug, metric_id, year_month, metric_type || ' ' || first_year as metric_title, value, percentage,
       case when n_payloads = 1 then total end as total
from flat join n on region_slug = rs and metric_id = mid""")
def q_site_merge_balance_years(spark, sf):
    docs = fx.balance_documents(spark, sf, energy=fx.site_energy_ext(spark, sf))
    return merge_balance_years(docs, fallback_ts=fx.FALLBACK_TS).select(
        "region_slug", "metric_id", "year_month", "metric_title", "value", "percentage", "total")


@register("site_dedup_latest", o.with_(o.E_SITE, o.FLAT) + f"""
select region_slug, metric_id, datetime,
       case when metric_type = '1-URGENT' then '{fx.REINGESTED_AT}' else '{fx.INGESTED_AT}' end as ingestion_timestamp,
       case when metric_type = '1-URGENT' then value + 1 else value end as value
from flat""")
def q_site_dedup_latest(spark, sf):
    d = dedup_latest(fx.two_ingestions(fx.balance_flat(spark, sf, fx.site_energy_ext(spark, sf))), BALANCE_KEY)
    return d.select("region_slug", "metric_id", "datetime", "ingestion_timestamp", "value")


@register("site_energy_weather_corr", o.with_(o.E_SITE, o.WD_SITE, o.W, o.M, o.REL, o.CURW) + _CORR_SQL.removeprefix(_ECW))
def q_site_energy_weather_corr(spark, sf):
    """Monthly rollup, join, curated filter and correlation for each site and metric."""
    mart = mart_energy_weather(fx.site_energy_ext(spark, sf), daily_to_monthly(fx.site_weather_daily(spark, sf)))
    cw = an.with_weather_value(curate(mart, fx.FIXTURE_CURATED), relationship_rows(fx.FIXTURE_RELATIONSHIPS))
    c = an.energy_weather_corr(cw)
    return c.select("region_name", "metric_type", "weather_column", "n_pairs",
                    round6(F.col("pearson_correlation")).alias("pearson_correlation"))


# --- whole batch flow -------------------------------------------------------------


@register("end_to_end_curated", _ECW + "select * from cur")
def q_end_to_end_curated(spark, sf):
    return run_batch(spark, sf).curated


@register("end_to_end_raw", o.with_(o.E_EXT, o.FLAT) + """
, n as (select region_slug as rs, metric_id as mid, count(distinct substr(year_month, 1, 4)) as n_payloads,
               min(substr(year_month, 1, 4)) as first_year
        from flat group by region_slug, metric_id)
select region_slug, metric_id, year_month, metric_type || ' ' || first_year as metric_title, value,
       case when n_payloads = 1 then total end as total,
       case when n_payloads = 1 then total_percentage end as total_percentage
from flat join n on region_slug = rs and metric_id = mid""")
def q_end_to_end_raw(spark, sf):
    """The raw balance table of the whole flow, by name: a record that several years' payloads hold has no total."""
    result = run_batch(spark, sf)
    return spark.table(f"{result.database}.{RAW_BALANCE}").select(
        "region_slug", "metric_id", "year_month", "metric_title", "value", "total", "total_percentage")


@register("models_by_name", _ECW + """
select m.region_slug, m.year_month, m.metric_type, m.value, m.precipitation_sum_total,
       m.metric_type in ('1-URGENT', '2-HIGH', '3-MEDIUM') as is_curated, w.location_name
from m left join w on m.region_slug = w.region_slug and m.year_month = w.year_month""")
def q_models_by_name(spark, sf):
    """SQL over the persistent staging view and mart tables of the whole flow, by their catalog names."""
    db = run_batch(spark, sf).database
    return spark.sql(f"""
        select m.region_slug, m.year_month, m.metric_type, m.value, m.precipitation_sum_total,
               c.metric_type is not null as is_curated, w.location_name
        from {db}.{MART} m
        left join {db}.{CURATED} c on m.region_slug = c.region_slug and m.year_month = c.year_month and m.metric_type = c.metric_type
        left join {db}.{STG_WEATHER} w on m.region_slug = w.region_slug and m.year_month = w.year_month""")
