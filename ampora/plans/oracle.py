"""DuckDB oracle SQL for every registered query.

The oracle recomputes each result straight from the driver's tables, with
plain SQL and without any of the library's code, so a match means the
Spark operators agree with an independent engine.
"""

from __future__ import annotations

from ampora.constants import BALANCE_ENDPOINT
from ampora.plans import fixtures as fx

_SUFFIX = fx.DATETIME_SUFFIX

E_EXT = f"""
e_m as (
  select lower(n_name) as region_slug, n_name as region_name, n_nationkey,
         strftime(o_orderdate, '%Y-%m') as year_month, o_orderpriority as metric_type,
         round(cast(sum(cast(o_totalprice as decimal(18,2))) as double), 0) as value
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  group by lower(n_name), n_name, n_nationkey, strftime(o_orderdate, '%Y-%m'), o_orderpriority),
e_ext as (
  select region_slug, region_name, n_nationkey, year_month,
         case when metric_type in ('1-URGENT','2-HIGH') then 'high' else 'normal' end as group_type,
         metric_type, value,
         round(value / sum(value) over (partition by region_slug, year_month), 6) as percentage
  from e_m),
e as (select region_slug, region_name, year_month, group_type, metric_type, value, percentage from e_ext)"""

C = f"""
c_all as (
  select lower(n_name) as region_slug, n_name as display_name, lower(r_name) as region_type,
         'ccaa' as redata_geo_limit, n_nationkey as redata_geo_id,
         coalesce(sl.loc, n_name || ' capital') as weather_location_name,
         cast(n_nationkey * 7.5 - 60.0 as double) as latitude,
         cast(n_regionkey * 45.0 - 90.0 + n_nationkey * 0.5 as double) as longitude,
         case when r_name = 'EUROPE' then 'Europe/Madrid' when r_name = 'AFRICA' then 'Africa/Ceuta'
              else 'Atlantic/Canary' end as timezone,
         'regional_capital' as weather_point_type,
         n_nationkey < {fx.INACTIVE_FROM_NATION} as is_active, n_regionkey
  from nation join region on n_regionkey = r_regionkey
       left join (select s_nationkey, 'Supplier ' || cast(min(s_suppkey) as varchar) as loc
                  from supplier group by s_nationkey) sl
         on sl.s_nationkey = n_nationkey),
c as (select * exclude (n_regionkey) from c_all where is_active)"""

WD = f"""
wd_core as (
  select case when n_nationkey < {fx.STATION_FROM_NATION} then lower(n_name)
              else lower(n_name) || '_station' end as region_slug, n_name as region_name, cast(l_shipdate as date) as d,
         round(max(l_discount)*100, 0) as temperature_2m_max,
         (round(max(l_discount)*100, 0) + round(min(l_discount)*100, 0)) / 2 as temperature_2m_mean,
         round(min(l_discount)*100, 0) as temperature_2m_min,
         round(sum(l_quantity), 0) as precipitation_sum,
         cast(min(l_linenumber) as bigint) as weather_code,
         round(max(l_tax)*100, 0) as wind_speed_10m_max,
         round(cast(sum(cast(l_extendedprice as decimal(18,2))) as double), 0) as shortwave_radiation_sum
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  group by n_nationkey, n_name, cast(l_shipdate as date)),
wd as (
  select 'open_meteo' as source, '{fx.INGESTED_AT}' as ingestion_timestamp,
         w.region_slug, w.region_name, c_all.weather_location_name as location_name,
         c_all.latitude, c_all.longitude, c_all.timezone, c_all.weather_point_type,
         strftime(d, '%Y-%m-%d') as date,
         temperature_2m_max, temperature_2m_mean, temperature_2m_min, precipitation_sum,
         weather_code, wind_speed_10m_max, shortwave_radiation_sum, c_all.n_regionkey
  from wd_core w join c_all on w.region_name = c_all.display_name)"""

W = """
w as (
  select source, ingestion_timestamp, region_slug, region_name, location_name, latitude, longitude,
         timezone, weather_point_type, substr(date, 1, 7) as year_month,
         avg(temperature_2m_max) as temperature_2m_max_avg,
         avg(temperature_2m_mean) as temperature_2m_mean_avg,
         avg(temperature_2m_min) as temperature_2m_min_avg,
         coalesce(sum(precipitation_sum), 0.0) as precipitation_sum_total,
         avg(wind_speed_10m_max) as wind_speed_10m_max_avg,
         coalesce(sum(shortwave_radiation_sum), 0.0) as shortwave_radiation_sum_total
  from wd
  group by source, ingestion_timestamp, region_slug, region_name, location_name, latitude,
           longitude, timezone, weather_point_type, substr(date, 1, 7))"""

MEASURES = ("temperature_2m_max_avg, temperature_2m_mean_avg, temperature_2m_min_avg, "
            "precipitation_sum_total, wind_speed_10m_max_avg, shortwave_radiation_sum_total")

M = f"""
m as (
  select e.region_slug, e.region_name, e.year_month, e.group_type, e.metric_type, e.value,
         e.percentage, w.temperature_2m_max_avg, w.temperature_2m_mean_avg,
         w.temperature_2m_min_avg, w.precipitation_sum_total, w.wind_speed_10m_max_avg,
         w.shortwave_radiation_sum_total
  from e left join w on e.region_slug = w.region_slug and e.year_month = w.year_month),
cur as (select * from m where metric_type in ('1-URGENT', '2-HIGH', '3-MEDIUM'))"""

REL = """
rel(metric_type, relationship_group, weather_column, weather_label, show_scatter) as (
  values ('1-URGENT', 'A', 'temperature_2m_mean_avg', 'Average temperature', true),
         ('2-HIGH', 'A', 'wind_speed_10m_max_avg', 'Average maximum wind speed', true),
         ('3-MEDIUM', 'B', 'precipitation_sum_total', 'Total precipitation', true))"""

CURW = """
curw as (
  select cur.*,
         coalesce(rel.relationship_group, 'C') as relationship_group,
         coalesce(rel.weather_column, 'temperature_2m_mean_avg') as weather_column,
         coalesce(rel.weather_label, 'Average temperature') as weather_label,
         coalesce(rel.show_scatter, false) as show_scatter
  from cur left join rel on cur.metric_type = rel.metric_type),
cv as (
  select *, case weather_column
      when 'temperature_2m_max_avg' then temperature_2m_max_avg
      when 'temperature_2m_mean_avg' then temperature_2m_mean_avg
      when 'temperature_2m_min_avg' then temperature_2m_min_avg
      when 'precipitation_sum_total' then precipitation_sum_total
      when 'wind_speed_10m_max_avg' then wind_speed_10m_max_avg
      when 'shortwave_radiation_sum_total' then shortwave_radiation_sum_total end as weather_value
  from curw)"""

FLAT = f"""
flat as (
  select 'redata' as source, '{BALANCE_ENDPOINT}' as endpoint,
         region_slug, region_name, cast(n_nationkey as bigint) as redata_geo_id,
         '{fx.INGESTED_AT}' as ingestion_timestamp, group_type, group_type as group_id,
         upper(group_type) as group_title, metric_type, metric_type as metric_id,
         group_type as metric_group_id, metric_type || ' ' || substr(year_month, 1, 4) as metric_title,
         case when group_type = 'high' then 'priority ' || metric_type end as metric_description,
         group_type = 'high' as is_composite, '{fx.LAST_UPDATE}' as last_update,
         sum(value) over (partition by region_slug, substr(year_month, 1, 4), metric_type) as total,
         cast(count(*) over (partition by region_slug, substr(year_month, 1, 4), metric_type) as double)
           as total_percentage,
         year_month, year_month || '{_SUFFIX}' as datetime, value, percentage, n_nationkey
  from e_ext)"""


E_SITE = """
e_m as (
  select 'site_' || o_custkey as region_slug, 'Site ' || o_custkey as region_name, o_custkey as n_nationkey,
         strftime(o_orderdate, '%Y-%m') as year_month, o_orderpriority as metric_type,
         round(cast(sum(cast(o_totalprice as decimal(18,2))) as double), 0) as value
  from orders group by all),
e_ext as (
  select region_slug, region_name, n_nationkey, year_month,
         case when metric_type in ('1-URGENT','2-HIGH') then 'high' else 'normal' end as group_type,
         metric_type, value,
         round(value / sum(value) over (partition by region_slug, year_month), 6) as percentage
  from e_m),
e as (select region_slug, region_name, year_month, group_type, metric_type, value, percentage from e_ext)"""

WD_SITE = f"""
wd as (
  select 'open_meteo' as source, '{fx.INGESTED_AT}' as ingestion_timestamp, 'site_' || l_suppkey as region_slug,
         'Site ' || l_suppkey as region_name, 'Supplier ' || l_suppkey as location_name,
         cast(l_suppkey % 180 - 90 as double) as latitude, cast(l_suppkey % 360 - 180 as double) as longitude,
         'Europe/Madrid' as timezone, 'site' as weather_point_type, strftime(cast(l_shipdate as date), '%Y-%m-%d') as date,
         round(max(l_discount)*100, 0) as temperature_2m_max,
         (round(max(l_discount)*100, 0) + round(min(l_discount)*100, 0)) / 2 as temperature_2m_mean,
         round(min(l_discount)*100, 0) as temperature_2m_min, round(sum(l_quantity), 0) as precipitation_sum,
         cast(min(l_linenumber) as bigint) as weather_code, round(max(l_tax)*100, 0) as wind_speed_10m_max,
         round(cast(sum(cast(l_extendedprice as decimal(18,2))) as double), 0) as shortwave_radiation_sum
  from lineitem group by l_suppkey, cast(l_shipdate as date))"""


def with_(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


UTC_DT = "(cast(year_month || '-01' as timestamp) - interval 1 hour)"
