"""The README usage example runs as written, on documents in the
one-document-per-file layout."""

import json
import os

from ampora.constants import DAILY_SERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _balance(slug):
    values = [{"datetime": f"2024-0{m}-01T00:00:00.000+01:00", "value": 100.0 + m * m,
               "percentage": 1.0} for m in range(1, 4)]
    return {"region_slug": slug, "region_name": "Comunidad de Madrid",
            "extracted_at": "2024-01-01T00:00:00+00:00",
            "payload": {"included": [{"type": "Demanda", "id": "d", "attributes": {
                "title": "D", "content": [{"type": "Demanda en b.c.", "id": "m",
                                           "attributes": {"values": values}}]}}]}}


def _weather(slug):
    days = [f"2024-0{m}-{d:02d}" for m in range(1, 4) for d in (1, 2)]
    daily = {"time": days, **{s: [float(i) for i in range(len(days))] for s in DAILY_SERIES}}
    return {"source": "open_meteo", "extracted_at": "2024-01-01T00:00:00+00:00",
            "region_slug": slug, "region_name": "Comunidad de Madrid", "location_name": "Madrid",
            "latitude": 40.4, "longitude": -3.7, "timezone": "Europe/Madrid",
            "weather_point_type": "capital", "payload": {"daily": daily}}


def test_readme_example(spark, tmp_dir, capsys):
    for sub in ("landing/redata", "landing/openmeteo"):
        os.makedirs(f"{tmp_dir}/{sub}")
    with open(f"{tmp_dir}/landing/redata/redata_madrid_monthly_sample.json", "w") as f:
        json.dump(_balance("madrid"), f, indent=2)
    with open(f"{tmp_dir}/landing/openmeteo/openmeteo_madrid_daily_sample.json", "w") as f:
        json.dump(_weather("madrid"), f, indent=2)
    readme = open(f"{ROOT}/README.md", encoding="utf-8").read()
    code = readme.split("```python\n", 1)[1].split("```", 1)[0]
    code = (code.replace("am.build_session()", "spark")
            .replace('"landing/', f'"{tmp_dir}/landing/').replace('"raw/', f'"{tmp_dir}/raw/'))
    exec(code, {"spark": spark})
    out = capsys.readouterr().out
    assert "Temperatura media" in out and "104.66666666666667" in out
