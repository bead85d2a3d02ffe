"""Raw history to clean, named columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.functions.scalars import nan_to_null, safe_double, safe_long
from skyrisk.operators.windows import dedupe_latest


def stage_weather(raw: DataFrame) -> DataFrame:
    """One row per observation with published names; a value that is no number becomes null."""
    measures = [
        (safe_long(source) if target == "code_meteo" else nan_to_null(safe_double(source))).alias(target)
        for source, target in schemas.WEATHER_NAMES.items()
    ]
    return raw.select(
        "row_hash",
        "insere_a",
        F.trim("code_insee").alias("code_insee"),
        F.to_date("time").alias("date"),
        *measures,
    )


def name_bulletins(raw: DataFrame) -> DataFrame:
    """Bulletins with their publication day and their two target days."""
    published = F.to_date("reference_time")
    return raw.select(
        "row_hash",
        "insere_a",
        "reference_time",
        published.alias("date_publication"),
        F.date_add(published, 1).alias("date_j1"),
        F.date_add(published, 2).alias("date_j2"),
        F.trim("dep_code").alias("numero_departement"),
        F.trim("nom_dep").alias("departement"),
        F.col("niveau_j1").cast("long").alias("niveau_j1"),
        F.col("niveau_j2").cast("long").alias("niveau_j2"),
    )


def stage_bulletins(raw: DataFrame) -> DataFrame:
    """The latest load of each (bulletin, area); repeated loads differ by their key only."""
    return dedupe_latest(
        name_bulletins(raw), ["reference_time", "numero_departement"], ["insere_a", "row_hash"]
    )
