"""Fixed values that must equal the reference's for equal results.

They are configuration, not data: each table is tiny and is turned into a
DataFrame on demand (see ``ampora.sources.config``).
"""

# --- fixed values: source identifiers written into flattened rows ---------
BALANCE_SOURCE = "redata"
BALANCE_ENDPOINT = "/es/datos/balance/balance-electrico"
WEATHER_SOURCE = "open_meteo"

# --- fixed values: the seven daily weather series, in payload order -------
DAILY_SERIES = [
    "temperature_2m_max",
    "temperature_2m_mean",
    "temperature_2m_min",
    "precipitation_sum",
    "weather_code",
    "wind_speed_10m_max",
    "shortwave_radiation_sum",
]

# --- fixed values: the six monthly weather measures, in table order -------
MONTHLY_MEASURES = [
    "temperature_2m_max_avg",
    "temperature_2m_mean_avg",
    "temperature_2m_min_avg",
    "precipitation_sum_total",
    "wind_speed_10m_max_avg",
    "shortwave_radiation_sum_total",
]

# --- fixed values: metrics kept by the curated mart (exact text) ----------
CURATED_METRICS = [
    "Demanda en b.c.",
    "Generación renovable",
    "Generación no renovable",
    "Eólica",
    "Solar fotovoltaica",
    "Solar térmica",
    "Hidráulica",
    "Ciclo combinado",
    "Cogeneración",
]

# --- fixed values: metric labels, Spanish name -> English label -----------
METRIC_LABELS_EN = [
    ("Demanda en b.c.", "Demand at busbars"),
    ("Generación renovable", "Renewable generation"),
    ("Generación no renovable", "Non-renewable generation"),
    ("Eólica", "Wind"),
    ("Solar fotovoltaica", "Solar photovoltaic"),
    ("Solar térmica", "Solar thermal"),
    ("Hidráulica", "Hydro"),
    ("Ciclo combinado", "Combined cycle"),
    ("Cogeneración", "Cogeneration"),
]

# --- fixed values: Spanish weather labels per metric (English ones are in
#     RELATIONSHIPS); the default relationship uses "Temperatura media" ------
WEATHER_LABELS_ES = [
    ("Demanda en b.c.", "Temperatura media"),
    ("Generación renovable", "Radiación solar total"),
    ("Generación no renovable", "Temperatura media"),
    ("Eólica", "Viento máximo medio"),
    ("Solar fotovoltaica", "Radiación total"),
    ("Solar térmica", "Radiación total"),
    ("Hidráulica", "Precipitación total"),
    ("Ciclo combinado", "Temperatura media"),
    ("Cogeneración", "Temperatura media"),
]
DEFAULT_WEATHER_LABEL = {"es": "Temperatura media", "en": "Average temperature"}

# --- fixed values: table headers of the analysis outputs, per language ------
UI_LABELS = {
    "es": {"year_month": "Año-mes", "region": "Comunidad", "metric": "Métrica energética",
           "energy_value": "Valor energético", "series": "serie", "mean": "media",
           "min": "mínimo", "max": "máximo", "std": "desviación estándar",
           "energy_variable": "variable_energética", "weather_variable": "variable_climática",
           "pearson": "correlación_pearson"},
    "en": {"year_month": "Year-month", "region": "Region", "metric": "Energy metric",
           "energy_value": "Energy value", "series": "series", "mean": "mean", "min": "min",
           "max": "max", "std": "standard deviation", "energy_variable": "energy_variable",
           "weather_variable": "weather_variable", "pearson": "pearson_correlation"},
}

# --- fixed values: metric -> (group, weather column, English weather label,
#     show scatter); metrics not listed fall back to RELATIONSHIP_DEFAULT ---
RELATIONSHIPS = [
    ("Demanda en b.c.", "A", "temperature_2m_mean_avg", "Average temperature", True),
    ("Generación renovable", "C", "shortwave_radiation_sum_total", "Total solar radiation", False),
    ("Generación no renovable", "C", "temperature_2m_mean_avg", "Average temperature", False),
    ("Eólica", "A", "wind_speed_10m_max_avg", "Average maximum wind speed", True),
    ("Solar fotovoltaica", "A", "shortwave_radiation_sum_total", "Total radiation", True),
    ("Solar térmica", "A", "shortwave_radiation_sum_total", "Total radiation", True),
    ("Hidráulica", "B", "precipitation_sum_total", "Total precipitation", True),
    ("Ciclo combinado", "C", "temperature_2m_mean_avg", "Average temperature", False),
    ("Cogeneración", "C", "temperature_2m_mean_avg", "Average temperature", False),
]
RELATIONSHIP_DEFAULT = ("C", "temperature_2m_mean_avg", "Average temperature", False)

# --- fixed values: natural keys ------------------------------------------
BALANCE_KEY = ["region_slug", "metric_id", "datetime"]
WEATHER_MONTHLY_KEY = ["region_slug", "year_month"]
DEDUP_ORDER_COLUMN = "ingestion_timestamp"

# --- fixed values: not-null data tests per model ----------------------------
NOT_NULL_TESTS = [
    ("stg_redata_balance_electrico", ["region_slug", "year_month", "datetime", "metric_type", "group_type"]),
    ("stg_openmeteo_monthly", ["region_slug", "year_month", "location_name"]),
    ("mart_energy_weather_monthly", ["region_slug", "year_month", "metric_type"]),
    ("mart_energy_weather_monthly_curated", ["region_slug", "year_month", "metric_type", "value"]),
]
