"""Declared contracts of the published tables, checked by the rules of the quality operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from skyrisk.operators import quality as Q
from skyrisk.schemas import HORIZONS, LEVELS

# What each table promises.
NOT_NULL = {
    "referentiel_communes": ["commune", "code_insee", "numero_departement", "latitude", "longitude"],
    "stg_meteo_journaliere": ["row_hash", "date", "code_insee"],
    "stg_meteo_forets": [
        "row_hash", "reference_time", "numero_departement", "departement", "niveau_j1", "niveau_j2",
    ],
    "int_meteo_communes": [
        "row_hash", "date", "code_insee", "commune", "numero_departement", "region", "latitude", "longitude",
    ],
    "int_meteo_departement_jour": ["date", "numero_departement", "nombre_points_meteo"],
    "dim_commune": ["code_insee", "commune", "numero_departement", "region", "latitude", "longitude"],
    "dim_departement": ["numero_departement", "departement", "region"],
    "dim_date": ["date", "annee", "numero_mois", "saison"],
    "fact_meteo": ["id_observation_meteo", "date", "code_insee"],
    "fact_danger_incendie": [
        "id_danger_incendie", "reference_time", "numero_departement", "date_prevision", "echeance", "niveau_danger",
    ],
    "pbi_risque_incendie": [
        "id_danger_incendie", "date_publication", "date_prevision", "numero_departement", "echeance", "niveau_danger",
    ],
    "ml_features_incendie": ["meteo_disponible", "id_feature", "date_publication", "numero_departement"],
    "ml_train_incendie": [
        "id_apprentissage", "date_publication", "date_prevision", "numero_departement", "echeance",
        "cible_niveau_danger",
    ],
}
UNIQUE = {
    "referentiel_communes": "code_insee",
    "stg_meteo_journaliere": "row_hash",
    "stg_meteo_forets": "row_hash",
    "int_meteo_communes": "row_hash",
    "dim_commune": "code_insee",
    "dim_departement": "numero_departement",
    "dim_date": "date",
    "fact_meteo": "id_observation_meteo",
    "fact_danger_incendie": "id_danger_incendie",
    "pbi_risque_incendie": "id_danger_incendie",
    "ml_features_incendie": "id_feature",
    "ml_train_incendie": "id_apprentissage",
}
ACCEPTED = {
    "stg_meteo_forets": {"niveau_j1": LEVELS, "niveau_j2": LEVELS},
    "fact_danger_incendie": {"echeance": list(HORIZONS), "niveau_danger": LEVELS},
    "ml_train_incendie": {"echeance": list(HORIZONS), "cible_niveau_danger": LEVELS},
}
REFERENCES = {
    "fact_meteo": {"date": ("dim_date", "date"), "code_insee": ("dim_commune", "code_insee")},
    "fact_danger_incendie": {
        "numero_departement": ("dim_departement", "numero_departement"),
        "date_prevision": ("dim_date", "date"),
    },
}


def rules_for(table: str, tables: Mapping[str, DataFrame]) -> list[Q.Rule]:
    rules = Q.not_null(*NOT_NULL.get(table, []))
    rules += [Q.accepted(column, values) for column, values in ACCEPTED.get(table, {}).items()]
    if table in UNIQUE:
        rules.append(Q.unique(UNIQUE[table]))
    for column, (parent, key) in REFERENCES.get(table, {}).items():
        rules.append(Q.references(column, tables[parent], key))
    return rules


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Report (table, rule, violations) over every table that is given and declared. Each table
    is read twice, once for its rows and once for its keys, so write expensive ones first."""
    return Q.validate_all({name: (df, rules_for(name, tables)) for name, df in tables.items() if name in NOT_NULL})
