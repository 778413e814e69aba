"""Yearly payload merges."""

import json

import pytest

from ampora.operators.merge import merge_balance_years, merge_weather_years
from tests.test_flatten import weather_doc


def payload(year, records):
    return {"included": [{"type": "G", "id": "g1", "attributes": {"title": f"G{year}", "content": [
        {"type": f"T{year}", "id": rid, "groupId": "g1",
         "attributes": {"title": f"{rid} {year}", "total": tot, "total-percentage": 0.5,
                        "values": [{"datetime": f"{year}-0{m}-01T00:00:00.000+01:00",
                                    "value": float(m)} for m in (1, 2)]}}
        for rid, tot in records]}}]}


def test_totals_null_when_record_in_two_years(spark):
    rows = [("madrid", "2023", json.dumps(payload("2023", [("a", 10.0), ("b", 5.0)]))),
            ("madrid", "2024", json.dumps(payload("2024", [("a", 11.0), ("c", 7.0)])))]
    df = spark.createDataFrame(rows, "region_slug string, year string, payload string")
    out = {(r.metric_id, r.year_month): r for r in merge_balance_years(df, "payload").collect()}
    assert len(out) == 8
    a = out[("a", "2024-02")]
    assert a.total is None and a.total_percentage is None and a.n_payloads == 2
    assert a.metric_title == "a 2023" and a.metric_type == "T2023" and a.group_title == "G2023"
    assert out[("b", "2023-01")].total == 5.0 and out[("c", "2024-01")].total == 7.0


def test_included_not_list_is_error(spark):
    df = spark.createDataFrame([("r", "2024", '{"included": 5}')],
                               "region_slug string, year string, payload string")
    with pytest.raises(Exception, match="not a list"):
        merge_balance_years(df, "payload").collect()


def test_weather_merge_appends_and_keeps_first_envelope(spark):
    d1 = weather_doc()
    d2 = weather_doc()
    d2["extracted_at"] = "later"
    d2["payload"]["daily"]["time"] = ["2026-01-01", "2026-01-02"]
    df = spark.createDataFrame([("madrid", "2025", json.dumps(d1)), ("madrid", "2026", json.dumps(d2))],
                               "region_slug string, year string, doc string")
    rows = merge_weather_years(df).collect()
    assert len(rows) == 4 and {r.ingestion_timestamp for r in rows} == {d1["extracted_at"]}


def test_weather_merge_scalar_series_is_error(spark):
    d = weather_doc(precipitation_sum=3.0)
    df = spark.createDataFrame([("madrid", "2025", json.dumps(d))],
                               "region_slug string, year string, doc string")
    with pytest.raises(Exception, match="precipitation_sum' is not a list"):
        merge_weather_years(df).collect()


def test_missing_record_ids_still_merge(spark):
    p1 = payload("2023", [(None, 1.0)])
    p2 = payload("2024", [(None, 2.0)])
    df = spark.createDataFrame([("r", "2023", json.dumps(p1)), ("r", "2024", json.dumps(p2))],
                               "region_slug string, year string, payload string")
    rows = merge_balance_years(df, "payload").collect()
    assert len(rows) == 4 and {r.n_payloads for r in rows} == {2} and {r.total for r in rows} == {None}


def test_block_attributes_from_first_year_even_without_records(spark):
    p1 = {"included": [{"id": "g1", "type": "G", "attributes": {"title": "first", "content": "x"}}]}
    p2 = payload("2024", [("a", 3.0)])
    df = spark.createDataFrame([("r", "2023", json.dumps(p1)), ("r", "2024", json.dumps(p2))],
                               "region_slug string, year string, payload string")
    rows = merge_balance_years(df, "payload").collect()
    assert len(rows) == 2 and {r.group_title for r in rows} == {"first"}
    assert {r.total for r in rows} == {3.0}


def test_merge_keeps_the_first_envelope_and_all_columns(spark):
    from ampora.schemas import BALANCE_FLAT
    docs = [{"source": f"s{y}", "endpoint": "e", "region_slug": "madrid", "region_name": f"M{y}", "redata_geo_id": 13,
             "requested_years": [y], "extracted_at": f"{y}-12-31T00:00:00+00:00", "payload": payload(str(y), [("a", 1.0)])}
            for y in (2024, 2023)]
    docs.append({"region_slug": "lugo", "requested_start_date": "2024-01-01T00:00", "payload": payload("2024", [("a", 4.0)])})
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    out = merge_balance_years(df, fallback_ts="now")
    assert out.columns == [*BALANCE_FLAT.fieldNames(), "n_payloads"]
    rows = {(r.region_slug, r.year_month): r for r in out.collect()}
    assert len(rows) == 6
    for month in ("2023-01", "2024-02"):
        r = rows["madrid", month]
        assert (r.source, r.region_name, r.redata_geo_id, r.ingestion_timestamp, r.total) == (
            "s2023", "M2023", 13, "2023-12-31T00:00:00+00:00", None)
    assert rows["lugo", "2024-01"].total == 4.0 and rows["lugo", "2024-01"].ingestion_timestamp == "now"


def test_merge_refuses_badly_typed_measures(spark):
    p = payload("2024", [("a", 1.0), ("b", 2.0)])
    p["included"][0]["attributes"]["content"][0]["attributes"]["values"][1]["value"] = "abc"
    df = spark.createDataFrame([("r", json.dumps(p))], "region_slug string, payload string")
    with pytest.raises(Exception, match="value is not a number"):
        merge_balance_years(df, "payload")
    assert len(merge_balance_years(df, "payload", strict=False).collect()) == 3


def test_documents_of_sites_take_one_shuffle_after_the_facts(spark):
    """Records, blocks and payloads share a shuffle by region and year, of the session's full width."""
    from ampora.plans import fixtures as fx
    from tests.conftest import SF001

    docs = fx.balance_documents(spark, SF001, energy=fx.site_energy_ext(spark, SF001))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("REPARTITION_BY_NUM") == 1


def test_members_of_values_that_are_missing_null_or_of_another_type(spark):
    values = [{}, {"datetime": None, "value": None}, {"datetime": 2024, "value": "5.5"}, None, 7, "x", [1],
              {"datetime": "2024-03-01", "value": 1, "percentage": 0.25}]
    record = {"id": "m", "attributes": {"values": values, "total": 3}}
    doc = {"region_slug": "r", "payload": {"included": [{"id": "g", "attributes": {"content": [record]}}]}}
    rows = merge_balance_years(spark.createDataFrame([(json.dumps(doc),)], "doc string"), fallback_ts="x").collect()
    assert sorted(((r.year_month, r.datetime, r.value, r.percentage, r.total) for r in rows), key=str) == sorted([
        ("", None, None, None, 3.0), (None, None, None, None, 3.0), ("2024", "2024", 5.5, None, 3.0),
        ("2024-03", "2024-03-01", 1.0, 0.25, 3.0)], key=str)
