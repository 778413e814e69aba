"""Catalogue, dedup, monthly aggregate, models, analysis, coverage, quality."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ampora.functions.columns import safe_pearson
from ampora.operators import analysis as an
from ampora.operators import coverage as cov
from ampora.operators.aggregate import daily_to_monthly
from ampora.operators.dedup import dedup_latest
from ampora.operators.models import curate, mart_energy_weather
from ampora.operators.quality import not_null_counts
from ampora.sources.catalog import load_regions
from ampora.sources.config import relationship_rows


def test_catalog_keeps_active_rows(spark, tmp_dir):
    os.makedirs(tmp_dir)
    path = f"{tmp_dir}/regions.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("region_slug,display_name,region_type,redata_geo_limit,redata_geo_id,"
                "weather_location_name,latitude,longitude,timezone,weather_point_type,is_active\n")
        f.write("madrid,Comunidad de Madrid,community,ccaa,13,Madrid,40.4,-3.7,Europe/Madrid,capital, TRUE \n")
        f.write("x,X,community,ccaa,1,X,1,1,Europe/Madrid,capital,false\n")
    rows = load_regions(spark, path).collect()
    assert len(rows) == 1 and rows[0].redata_geo_id == 13 and rows[0].latitude == 40.4
    assert rows[0].is_active is True


def test_catalog_missing_file_is_an_error(spark, tmp_dir):
    with pytest.raises(Exception):
        load_regions(spark, f"{tmp_dir}/nope.csv").collect()


def _raw(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    return spark.createDataFrame(
        [("a", "m", t1, 1.0), ("a", "m", t2, 2.0), ("a", "m", None, 9.0),
         ("b", "m", t1, 3.0), ("b", "m", t1, 4.0), ("c", "m", None, 5.0)],
        "region_slug string, metric_id string, ingestion_timestamp timestamp, value double")


def test_dedup_newest_nulls_last_total_tiebreak(spark):
    d = {r.region_slug: r.value for r in
         dedup_latest(_raw(spark), ["region_slug", "metric_id"]).collect()}
    assert d == {"a": 2.0, "b": 4.0, "c": 5.0}


def test_dedup_idempotent_and_key_required(spark):
    keys = ["region_slug", "metric_id"]
    once = dedup_latest(_raw(spark), keys)
    assert sorted(once.collect()) == sorted(dedup_latest(once, keys).collect())
    with pytest.raises(ValueError):
        dedup_latest(_raw(spark), [])


def test_dedup_plan_limits_before_shuffle(spark):
    plan = dedup_latest(_raw(spark), ["region_slug"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_monthly_aggregate_pandas_semantics(spark):
    env = ("s", "t", "r", "R", "L", 1.0, 2.0, "tz", "p")
    rows = [env + ("2024-01-01", 10.0, 5.0, 0.0, None, 1, 3.0, None),
            env + ("2024-01-02", float("nan"), 7.0, 2.0, None, 1, 5.0, None),
            ("s", "t", None, "R", "L", 1.0, 2.0, "tz", "p", "2024-01-03", 1.0, 1.0, 1.0, 1.0, 1, 1.0, 1.0)]
    schema = ("source string, ingestion_timestamp string, region_slug string, region_name string, "
              "location_name string, latitude double, longitude double, timezone string, "
              "weather_point_type string, date string, temperature_2m_max double, "
              "temperature_2m_mean double, temperature_2m_min double, precipitation_sum double, "
              "weather_code long, wind_speed_10m_max double, shortwave_radiation_sum double")
    out = daily_to_monthly(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 1  # the NULL-key row is dropped
    r = out[0]
    assert r.year_month == "2024-01" and r.temperature_2m_max_avg == 10.0  # NaN is missing
    assert r.temperature_2m_mean_avg == 6.0 and r.precipitation_sum_total == 0.0
    assert r.shortwave_radiation_sum_total == 0.0 and r.wind_speed_10m_max_avg == 4.0


def test_safe_pearson_never_raises(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 2.0, 5.0), (2, 1.0, 1.0), (3, 1.0, 2.0),
                                (3, 2.0, 4.0), (3, 3.0, None), (3, 4.0, 7.0)],
                               "g int, x double, y double")
    r = {x.g: x.c for x in df.groupBy("g").agg(safe_pearson(F.col("x"), F.col("y")).alias("c")).collect()}
    assert r[1] is None and r[2] is None
    import pandas as pd
    expected = pd.Series([1.0, 2.0, 3.0, 4.0]).corr(pd.Series([2.0, 4.0, None, 7.0]))
    assert abs(r[3] - expected) < 1e-12  # pairwise complete, like pandas


def _mart(spark):
    e = spark.createDataFrame(
        [("r", "R", "2024-01", "g", "Eólica", 10.0, 0.5), ("r", "R", "2024-02", "g", "Eólica", 20.0, 0.7),
         ("r", "R", "2024-03", "g", "Eólica", 30.0, None), ("r", "R", "2024-01", "g", "Otra", 1.0, 50.0)],
        "region_slug string, region_name string, year_month string, group_type string, "
        "metric_type string, value double, percentage double")
    w = spark.createDataFrame(
        [("r", "2024-01", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0), ("r", "2024-02", 1.0, 2.0, 3.0, 4.0, 7.0, 6.0)],
        "region_slug string, year_month string, temperature_2m_max_avg double, "
        "temperature_2m_mean_avg double, temperature_2m_min_avg double, "
        "precipitation_sum_total double, wind_speed_10m_max_avg double, "
        "shortwave_radiation_sum_total double")
    return mart_energy_weather(e, w)


def test_mart_keeps_energy_rows_and_curates(spark):
    m = _mart(spark)
    assert m.count() == 4 and m.where(F.col("wind_speed_10m_max_avg").isNull()).count() == 1
    assert {r.metric_type for r in curate(m).collect()} == {"Eólica"}


def test_grouped_kpis_follow_relationships(spark):
    cw = an.with_weather_value(_mart(spark), relationship_rows())
    wind = cw.where(F.col("metric_type") == "Eólica")
    assert {r.weather_column for r in wind.collect()} == {"wind_speed_10m_max_avg"}
    other = cw.where(F.col("metric_type") == "Otra").first()
    assert other.weather_column == "temperature_2m_mean_avg" and other.show_scatter is False
    k = {r.metric_type: r for r in an.slice_kpis(cw).collect()}
    assert k["Eólica"].n_months == 3 and k["Eólica"].avg_value == 20.0 and k["Eólica"].avg_weather == 6.0
    s = {r.metric_type: r for r in an.share_kpi(cw).collect()}
    assert abs(s["Eólica"].share_pct - 60.0) < 1e-9 and s["Eólica"].share_text == "60.0%"
    assert s["Otra"].share_pct == 50.0  # > 1, kept as is
    c = {r.metric_type: r for r in an.energy_weather_corr(cw).collect()}
    assert c["Eólica"].n_pairs == 2 and abs(c["Eólica"].pearson_correlation - 1.0) < 1e-12
    assert an.scatter_pairs(cw).count() == 3
    st = {(r.metric_type, r.series): r for r in an.summary_stats(cw).collect()}
    assert st[("Eólica", "energy")].std == 10.0 and st[("Eólica", "weather")].max == 7.0


def test_select_regions_unknown_slug(spark):
    cat = spark.createDataFrame([("a",), ("b",)], "region_slug string")
    facts = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "region_slug string, v int")
    assert [r.v for r in cov.select_regions(facts, cat, ["a", "a"]).collect()] == [1]
    with pytest.raises(ValueError, match="region not in the catalogue: z"):
        cov.select_regions(facts, cat, ["a", "z"])
    assert [r.v for r in cov.unknown_regions(facts, cat).collect()] == [3]


def test_coverage_grid_and_checks(spark):
    cat = spark.createDataFrame([("a", 1, 95.0, 0.0, "Europe/Madrid"), ("b", 2, 10.0, 0.0, "")],
                                "region_slug string, redata_geo_id int, latitude double, "
                                "longitude double, timezone string")
    g = cov.coverage_grid(cat, 2023, 2024)
    assert g.count() == 4
    r = g.where("region_slug = 'a' and year = 2024").first()
    assert (r.balance_start, r.balance_end, r.weather_start, r.weather_end) == (
        "2024-01-01T00:00", "2024-12-31T23:59", "2024-01-01", "2024-12-31")
    v = {(x.region_slug, x.rule) for x in cov.range_violations(g, ["t"]).collect()}
    assert v == {("a", "latitude"), ("b", "timezone")}
    facts = spark.createDataFrame([("a", "2023-05")], "region_slug string, year_month string")
    assert cov.coverage_gaps(cat, facts, 2023, 2023).count() == 23
    req = spark.createDataFrame([("a",), ("a",), ("b",)], "region_slug string")
    dl = spark.createDataFrame([("a",), ("b",), ("c",)], "region_slug string")
    m = {x.region_slug: (x.requested_n, x.delivered_n) for x in cov.extract_completeness(req, dl).collect()}
    assert m == {"a": (2, 1), "c": (0, 1)}


def test_not_null_counts(spark):
    df = spark.createDataFrame([(None, 1), ("x", None), (None, 2)], "a string, b int")
    r = {x.column_name: (x.failures, x.passed) for x in not_null_counts(df, "t", ["a", "b"]).collect()}
    assert r == {"a": (2, False), "b": (1, False)}


def test_presentation_tables_spanish(spark):
    from ampora.sources.config import label_rows
    cw = an.with_weather_value(_mart(spark), relationship_rows(language="es"), "es")
    assert {r.weather_label for r in cw.collect()} == {"Viento máximo medio", "Temperatura media"}
    st = an.present_summary(an.summary_stats(cw, ["region_name", "metric_type", "weather_label"]), "es")
    assert "desviación estándar" in st.columns
    assert {r["serie"] for r in st.collect()} == {"Valor energético", "Viento máximo medio",
                                                  "Temperatura media"}
    c = an.present_correlation(an.energy_weather_corr(cw), "es").collect()
    assert {r["variable_climática"] for r in c} == {"Viento máximo medio", "Temperatura media"}
    det = an.present_detail(an.monthly_detail(an.curated_extract(curate(_mart(spark))).transform(
        lambda d: an.with_weather_value(d, relationship_rows())), label_rows()), "en")
    assert det.columns[:4] == ["Year-month", "Region", "Energy metric", "Energy value"]
    assert {r["Energy metric"] for r in det.collect()} == {"Wind"}


def test_scale_conf_widths():
    from ampora.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(10, 8)["spark.sql.shuffle.partitions"]) == 16


def _daily_row(ts, date, v):
    return ("s", ts, "r", "R", "L", 1.0, 2.0, "tz", "p", date, v, v, v, v, 1, v, v)


_DAILY_SCHEMA = ("source string, ingestion_timestamp string, region_slug string, region_name string, "
                 "location_name string, latitude double, longitude double, timezone string, "
                 "weather_point_type string, date string, temperature_2m_max double, "
                 "temperature_2m_mean double, temperature_2m_min double, precipitation_sum double, "
                 "weather_code long, wind_speed_10m_max double, shortwave_radiation_sum double")


def test_t6_two_loads_of_a_month_stay_two_rows_until_dedup(spark):
    from ampora.operators.models import stage_weather
    from ampora.schemas import WEATHER_MONTHLY_RAW
    from ampora.sinks.writers import conform
    d = spark.createDataFrame([_daily_row("2024-01-01T00:00:00+00:00", "2024-01-01", 1.0),
                               _daily_row("2024-02-01T00:00:00+00:00", "2024-01-01", 3.0)], _DAILY_SCHEMA)
    m = daily_to_monthly(d)
    assert m.count() == 2
    s = stage_weather(conform(m, WEATHER_MONTHLY_RAW)).collect()
    assert len(s) == 1 and s[0].temperature_2m_max_avg == 3.0


def test_t10_blank_text_loads_as_null(spark):
    from ampora.operators.quality import not_null_counts
    from ampora.schemas import BALANCE_RAW
    from ampora.sinks.writers import conform
    df = spark.createDataFrame([("", "m", "2025-01-01T00:00:00.000+01:00")],
                               "region_slug string, metric_id string, datetime string")
    c = conform(df, BALANCE_RAW)
    assert c.first().region_slug is None
    r = {x.column_name: x.failures for x in not_null_counts(c, "t", ["region_slug"]).collect()}
    assert r == {"region_slug": 1}


def test_t12_same_metric_in_two_groups_collapses(spark):
    from ampora.operators.models import stage_balance
    from ampora.schemas import BALANCE_RAW
    from ampora.sinks.writers import conform
    rows = [("r", "g1", "m", "2025-01-01T00:00:00.000+01:00", "2024-01-01T00:00:00+00:00", 1.0),
            ("r", "g2", "m", "2025-01-01T00:00:00.000+01:00", "2024-02-01T00:00:00+00:00", 2.0)]
    df = spark.createDataFrame(rows, "region_slug string, group_id string, metric_id string, "
                                     "datetime string, ingestion_timestamp string, value double")
    s = stage_balance(conform(df, BALANCE_RAW)).collect()
    assert len(s) == 1 and s[0].group_id == "g2" and s[0].value == 2.0


def test_argument_errors(spark):
    cat = spark.createDataFrame([("a", 1, 1.0, 1.0, "tz")],
                                "region_slug string, redata_geo_id int, latitude double, "
                                "longitude double, timezone string")
    with pytest.raises(ValueError, match="start year"):
        cov.coverage_grid(cat, 2025, 2024)
    with pytest.raises(ValueError, match="Unknown columns"):
        dedup_latest(_raw(spark), ["nope"])
    with pytest.raises(ValueError, match="Unknown columns"):
        dedup_latest(_raw(spark), ["region_slug"], order_by="missing_ts")


def test_shared_root_needs_a_setting_off_local():
    from ampora.session import shared_root

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf, sparkContext = Conf(), None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_statistics_over_a_written_mart_join_nothing_and_combine_on_the_scan(spark, tmp_dir):
    _mart(spark).write.parquet(tmp_dir)
    stats = an.summary_stats(an.with_weather_value(spark.read.parquet(tmp_dir), relationship_rows()))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert plan.index("partial_") < plan.index("Scan parquet") and "region_name" in plan.split("Exchange")[1].split("\n")[0]
    chosen = cov.select_regions(spark.read.parquet(tmp_dir), _mart(spark).select("region_slug").distinct(),
                                [_mart(spark).first().region_slug])
    assert "Exchange" not in chosen._jdf.queryExecution().executedPlan().toString()
