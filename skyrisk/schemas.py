"""Declared contracts: column names, types and fixed domain values.

Nothing is inferred from data: every reader takes one of these schemas.
"""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import types as T

# --- Fixed values: the data contract of the source and of the published tables ---------

# Raw weather variable -> name in the published tables, in published order.
# ``weather_code`` is an integer code, the others are doubles.
WEATHER_NAMES = {
    "weather_code": "code_meteo",
    "temperature_2m_mean": "temperature_moyenne",
    "temperature_2m_min": "temperature_minimale",
    "temperature_2m_max": "temperature_maximale",
    "apparent_temperature_mean": "temperature_ressentie_moyenne",
    "apparent_temperature_min": "temperature_ressentie_minimale",
    "apparent_temperature_max": "temperature_ressentie_maximale",
    "relative_humidity_2m_mean": "humidite_moyenne",
    "relative_humidity_2m_min": "humidite_minimale",
    "relative_humidity_2m_max": "humidite_maximale",
    "dew_point_2m_mean": "point_de_rosee_moyen",
    "precipitation_sum": "precipitations_totales",
    "rain_sum": "pluie_totale",
    "snowfall_sum": "neige_totale",
    "precipitation_hours": "heures_de_precipitations",
    "wind_speed_10m_mean": "vitesse_vent_moyenne",
    "wind_speed_10m_max": "vitesse_vent_maximale",
    "wind_gusts_10m_max": "rafale_vent_maximale",
    "wind_direction_10m_dominant": "direction_vent_dominante",
    "cloud_cover_mean": "couverture_nuageuse_moyenne",
    "pressure_msl_mean": "pression_moyenne",
    "sunshine_duration": "duree_ensoleillement",
    "shortwave_radiation_sum": "rayonnement_solaire_total",
    "et0_fao_evapotranspiration": "evapotranspiration",
    "vapour_pressure_deficit_max": "deficit_pression_vapeur_maximal",
    "soil_moisture_0_to_7cm_mean": "humidite_sol_0_7cm",
    "soil_moisture_7_to_28cm_mean": "humidite_sol_7_28cm",
    "soil_moisture_28_to_100cm_mean": "humidite_sol_28_100cm",
    "soil_temperature_0_to_7cm_mean": "temperature_sol_0_7cm",
}

# Raw variables that must be present in every loaded observation.
REQUIRED_VARIABLES = [
    "temperature_2m_mean",
    "temperature_2m_max",
    "relative_humidity_2m_mean",
    "precipitation_sum",
    "wind_gusts_10m_max",
    "vapour_pressure_deficit_max",
]

# Places and bulletins.
POINT_COUNT = 360
AREA_CODES = [f"{n:02d}" for n in range(1, 96) if n != 20] + ["2A", "2B"]
HORIZONS = {"J1": 1, "J2": 2}
LEVELS = [1, 2, 3, 4]
LEVEL_NAMES = {1: "Faible", 2: "Modéré", 3: "Élevé", 4: "Très élevé"}
UNKNOWN_LEVEL = "Inconnu"

# Header names met in yearly archives -> contract names.
ARCHIVE_RENAMES = {"date": "reference_time", "num_dep": "dep_code", "dep_nom": "nom_dep"}
ARCHIVE_COLUMNS = ["reference_time", "dep_code", "nom_dep", "niveau_j1", "niveau_j2"]

# Calendar names.
MONTH_NAMES = [
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
]
WEEKDAY_NAMES = ["Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi"]
SEASONS = {
    "Hiver": [12, 1, 2],
    "Printemps": [3, 4, 5],
    "Été": [6, 7, 8],
    "Automne": [9, 10, 11],
}

# Model inputs, in order, and the temporal split.
MODEL_FEATURES = [
    "horizon_jours",
    "temperature_moyenne",
    "temperature_maximale",
    "humidite_moyenne",
    "precipitations_moyennes",
    "rafale_vent_maximale",
    "deficit_pression_vapeur_maximal",
    "temperature_moyenne_7j",
    "temperature_maximale_7j",
    "humidite_moyenne_7j",
    "precipitations_moyennes_7j",
    "rafale_vent_maximale_7j",
    "deficit_pression_vapeur_maximal_7j",
    "jours_sans_pluie_7j",
]
MODEL_CONTEXT = ["date_publication", "date_prevision", "numero_departement", "departement", "echeance"]
MODEL_TARGET = "cible_niveau_danger"
TRAIN_YEARS = (2024, 2025)
TEST_YEAR = 2026
TEST_END = date(2026, 10, 2)
WINDOW_DAYS = 7
# Another list of features, window or split gives another version, so that a stored model
# is never applied to inputs it was not trained on.
FEATURE_VERSION = hashlib.sha256(
    repr((MODEL_FEATURES, WINDOW_DAYS, TRAIN_YEARS, TEST_YEAR, TEST_END.isoformat())).encode()
).hexdigest()[:16]

# Refresh calendar.
REFRESH_START = date(2026, 8, 1)
WEATHER_LAG_DAYS = 6
LOCAL_ZONE = "Europe/Paris"

# --- Derived lists --------------------------------------------------------------------

WEATHER_VARIABLES = list(WEATHER_NAMES)
WEATHER_MEASURES = list(WEATHER_NAMES.values())
WEATHER_FEATURES = [name for name in MODEL_FEATURES if name != "horizon_jours"]
AREA_COUNT = len(AREA_CODES)
HISTORY_KEY = "row_hash"

# --- Schemas --------------------------------------------------------------------------


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


POINTS = _struct(
    commune=T.StringType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
    region=T.StringType(),
    departement=T.StringType(),
    numero_departement=T.StringType(),
    service=T.StringType(),
    code_insee=T.StringType(),
    centroide=T.BooleanType(),
)

RAW_WEATHER = _struct(
    time=T.TimestampType(),
    code_insee=T.StringType(),
    row_hash=T.StringType(),
    insere_a=T.TimestampType(),
    **{name: T.DoubleType() for name in WEATHER_VARIABLES},
)

RAW_BULLETINS = _struct(
    reference_time=T.TimestampType(),
    dep_code=T.StringType(),
    nom_dep=T.StringType(),
    niveau_j1=T.LongType(),
    niveau_j2=T.LongType(),
    row_hash=T.StringType(),
    insere_a=T.TimestampType(),
)

# Levels are read as text so that 2.5 is refused by a rule and not cut to 2 by a cast.
BULLETIN_JSON = _struct(
    reference_time=T.StringType(),
    dep_code=T.StringType(),
    dep_nom=T.StringType(),
    niveau_j1=T.StringType(),
    niveau_j2=T.StringType(),
)

MANIFEST = _struct(
    batch_id=T.LongType(),
    pos=T.IntegerType(),
    code_insee=T.StringType(),
    requested_day=T.DateType(),
)
