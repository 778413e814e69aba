"""Hand-made document cases for the flatten operators."""

import json

import pytest

from ampora.constants import BALANCE_ENDPOINT, BALANCE_SOURCE, DAILY_SERIES
from ampora.operators.flatten import (balance_envelope, balance_violations, flatten_balance,
                                      flatten_weather, weather_violations)
from ampora.sources.documents import parse_documents, payload_errors

TS = "2024-05-01T00:00:00+00:00"


def docs(spark, *objs):
    rows = [(i, o if isinstance(o, str) else json.dumps(o)) for i, o in enumerate(objs)]
    return spark.createDataFrame(rows, "id int, doc string")


def balance_doc(values, **env):
    d = {"source": "redata", "endpoint": "/x", "region_slug": "madrid",
         "region_name": "Comunidad de Madrid", "redata_geo_id": 13, "extracted_at": TS,
         "payload": {"included": [{"type": "Demanda", "id": "dem", "attributes": {
             "title": "Demanda", "content": [{"type": "Demanda en b.c.", "id": "m1",
                                              "groupId": "dem", "attributes": {
                                                  "title": "Demanda en b.c.", "description": "d",
                                                  "composite": False,
                                                  "last-update": "2025-02-01T10:00:00.000+01:00",
                                                  "total": 42.0, "total-percentage": 1.0,
                                                  "values": values}}]}}]}}
    d.update(env)
    return d


def test_one_value_gives_one_row_with_string_month(spark):
    v = [{"datetime": "2025-01-01T00:00:00.000+01:00", "value": 42.0, "percentage": 1.0}]
    rows = flatten_balance(docs(spark, balance_doc(v)), TS).collect()
    assert len(rows) == 1
    r = rows[0]
    # month from the text prefix, not from a UTC cast (which gives 2024-12)
    assert r.year_month == "2025-01" and r.value == 42.0
    assert r.region_slug == "madrid" and r.redata_geo_id == 13 and r.ingestion_timestamp == TS
    assert r.metric_id == "m1" and r.group_id == "dem" and r.last_update.startswith("2025-02")
    assert r.total == 42.0 and r.total_percentage == 1.0 and r.is_composite is False


def test_invalid_values_and_string_records_are_skipped(spark):
    d = balance_doc("invalid")
    d["payload"]["included"][0]["attributes"]["content"].append("a string record")
    d["payload"]["included"].append(7)
    assert flatten_balance(docs(spark, d), TS).count() == 0


def test_bad_items_skip_only_themselves(spark):
    v = [{"datetime": "2025-01-01T00:00:00.000+01:00", "value": 1.0}, "bad", 3,
         {"datetime": "2025-02-01T00:00:00.000+01:00", "value": 2.0}]
    rows = flatten_balance(docs(spark, balance_doc(v)), TS).orderBy("year_month").collect()
    assert [r.value for r in rows] == [1.0, 2.0]


def test_included_not_a_list_is_an_error(spark):
    d = docs(spark, {"payload": {"included": {}}})
    with pytest.raises(Exception, match="'included' is not a list"):
        flatten_balance(d, TS).collect()
    assert flatten_balance(d, TS, strict=False).count() == 0
    assert balance_violations(d).count() == 1


def test_top_level_must_be_an_object(spark):
    d = docs(spark, "[]")
    with pytest.raises(Exception, match="not a JSON object"):
        flatten_balance(d, TS).count()


def test_no_wrapper_defaults(spark):
    e = balance_envelope(docs(spark, {"included": []}), TS).first()
    assert e.region_slug_doc == "" and e.region_name == "" and e.redata_geo_id is None
    assert e.ingestion_timestamp == TS and e.source == BALANCE_SOURCE
    assert e.endpoint == BALANCE_ENDPOINT


def test_wrapper_defaults_only_for_absent_members(spark):
    d = {"payload": {"included": []}, "region_name": None}
    e = balance_envelope(docs(spark, d), TS).first()
    assert e.source == BALANCE_SOURCE and e.region_slug_doc == ""
    assert e.region_name is None  # explicit null stays NULL
    assert e.ingestion_timestamp == TS


def test_missing_datetime_gives_empty_month(spark):
    v = [{"value": 5.0}]
    r = flatten_balance(docs(spark, balance_doc(v)), TS).first()
    assert r.year_month == "" and r.datetime is None


def test_errors_member_and_parse(spark):
    d = docs(spark, {"errors": [{"code": 500}]}, {"errors": None}, {"included": []}, "[1]", "{bad")
    flags = [r.has_errors for r in payload_errors(d).orderBy("id").collect()]
    assert flags == [True, True, False, False, False]
    p = parse_documents(d).orderBy("id").collect()
    assert [r.is_object for r in p] == [True, True, True, False, False]
    assert [r.parse_ok for r in p] == [True, True, True, True, False]


def weather_doc(n=2, **over):
    daily = {"time": [f"2025-01-0{i + 1}" for i in range(n)]}
    for k, s in enumerate(DAILY_SERIES):
        daily[s] = [float(k * 10 + i) for i in range(n)]
    daily["weather_code"] = [1] * n
    daily["shortwave_radiation_sum"] = [100.0 + 20 * i for i in range(n)]
    daily.update(over)
    return {"source": "open_meteo", "extracted_at": TS, "region_slug": "madrid",
            "region_name": "Comunidad de Madrid", "location_name": "Madrid", "latitude": 40.4,
            "longitude": -3.7, "timezone": "Europe/Madrid", "weather_point_type": "capital",
            "payload": {"daily": daily, "daily_units": {}}}


def test_weather_two_days(spark):
    rows = flatten_weather(docs(spark, weather_doc())).orderBy("date").collect()
    assert len(rows) == 2
    assert rows[1].shortwave_radiation_sum == 120.0 and rows[1].date == "2025-01-02"
    assert rows[0].weather_code == 1 and rows[0].location_name == "Madrid"


def test_weather_short_series_is_an_error(spark):
    d = docs(spark, weather_doc(temperature_2m_max=[1.0]))
    with pytest.raises(Exception, match="temperature_2m_max' has 1 values, expected 2"):
        flatten_weather(d).collect()
    v = weather_violations(d).collect()
    assert len(v) == 1 and "expected 2" in v[0].violation


def test_weather_no_dates_no_checks(spark):
    d = docs(spark, weather_doc(n=0, temperature_2m_max="scalar"))
    assert flatten_weather(d).count() == 0


def test_weather_top_level_array_is_an_error(spark):
    with pytest.raises(Exception, match="not a JSON object"):
        flatten_weather(docs(spark, "[]")).collect()


def test_weather_payload_not_object_is_an_error(spark):
    with pytest.raises(Exception, match="'payload' is not an object"):
        flatten_weather(docs(spark, {"payload": [1]})).collect()
    assert flatten_weather(docs(spark, {"source": "x"})).count() == 0


def test_split_error_payloads(spark):
    from ampora.sources.documents import split_error_payloads
    good, bad = split_error_payloads(docs(spark, {"errors": []}, {"included": []}, "x"))
    assert sorted(r.id for r in good.collect()) == [1, 2] and [r.id for r in bad.collect()] == [0]


def test_non_object_attributes_are_skipped(spark):
    v = [{"datetime": "2025-01-01T00:00:00.000+01:00", "value": 1.0}]
    d = balance_doc(v)
    d["payload"]["included"].append({"type": "X", "id": "x", "attributes": [1, 2]})
    d["payload"]["included"][0]["attributes"]["content"].append({"id": "r", "attributes": "text"})
    rows = flatten_balance(docs(spark, d), TS).collect()
    assert [(r.group_id, r.metric_id) for r in rows] == [("dem", "m1")]


def test_badly_typed_measures(spark):
    from ampora.operators.flatten import measure_violations
    stamp = "2025-0{}-01T00:00:00.000+01:00"
    kinds = [1.5, "2.5", None, "abc", True, {"x": 1}, [1], "", "1e3"]
    doc = balance_doc([{"datetime": stamp.format(i + 1), "value": v} for i, v in enumerate(kinds)])
    doc["payload"]["included"][0]["attributes"]["content"][0]["attributes"]["values"].append({"datetime": stamp.format(9)})
    d = docs(spark, doc)
    bad = [r.violation for r in measure_violations(d).collect()]
    assert [b.split(" ")[0] for b in bad] == [f"values[{i}].value" for i in (3, 4, 5, 6)]
    assert bad[0].endswith('"abc"') and bad[1].endswith("true")
    good = flatten_balance(d, "t", strict=False).collect()
    assert sorted((r.value for r in good), key=str) == sorted([1.5, 2.5, None, None, 1000.0, None], key=str)
    with pytest.raises(Exception, match="values\\[3\\].value is not a number"):
        flatten_balance(d, "t").count()


def test_badly_typed_series(spark):
    from ampora.operators.flatten import flatten_weather, weather_violations
    ok = weather_doc(temperature_2m_max=["1.5", None], weather_code=[3.0, "4"])
    rows = flatten_weather(docs(spark, ok)).collect()
    assert [(r.temperature_2m_max, r.weather_code) for r in rows] == [(1.5, 3), (None, 4)]
    bad = weather_doc(temperature_2m_max=[1.0, "bad"], weather_code=[1.5, True])
    found = sorted(r.violation for r in weather_violations(docs(spark, bad)).collect())
    assert found == ["'payload.daily.temperature_2m_max[1]' is not a number: \"bad\"",
                     "'payload.daily.weather_code[0]' is not a whole number: 1.5",
                     "'payload.daily.weather_code[1]' is not a whole number: true"]
    assert flatten_weather(docs(spark, bad), strict=False).collect() == []
    with pytest.raises(Exception, match="is not a number"):
        flatten_weather(docs(spark, bad)).count()
