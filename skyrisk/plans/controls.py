"""Health queries over the raw history and the published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk.functions.dates import local_day
from skyrisk.functions.keys import make_id
from skyrisk.functions.scalars import all_of, pct
from skyrisk.operators.aggregates import count_apart, count_rows
from skyrisk.operators.reshape import calendar, side_by_side


def state_weather(raw: DataFrame) -> DataFrame:
    day = F.to_date("time")
    plain = [
        count_rows().alias("lignes"),
        F.count_if(F.col("row_hash").isNull()).alias("hash_manquants"),
        F.min(day).alias("premiere_date"),
        F.max(day).alias("derniere_date"),
    ]
    return count_apart(raw, [], plain, {"cles_uniques": F.col("row_hash"), "jours": day}).select(
        "lignes", "cles_uniques", "hash_manquants", "jours", "premiere_date", "derniere_date"
    )


def state_bulletins(raw: DataFrame) -> DataFrame:
    day = F.to_date("reference_time")
    plain = [
        count_rows().alias("lignes"),
        F.count_if(F.col("row_hash").isNull()).alias("hash_manquants"),
        F.min(day).alias("premiere_date"),
        F.max(day).alias("derniere_date"),
    ]
    distinct = {
        "cles_metier_uniques": make_id("reference_time", F.trim("dep_code")),
        "publications": F.col("reference_time"),
        "departements": F.col("dep_code"),
    }
    return count_apart(raw, [], plain, distinct).select(
        "lignes", "cles_metier_uniques", "hash_manquants", "publications", "departements", "premiere_date", "derniere_date"
    )


def _with_all_days(per_day: DataFrame, day: str, bounds: DataFrame | None = None) -> DataFrame:
    if bounds is None:
        bounds = per_day.agg(F.min(day).alias("low"), F.max(day).alias("high"))
    return calendar(bounds, "low", "high", day).join(per_day, day, "left")


def _differs(counts: Sequence[str], expected: int | Column) -> Column:
    wanted = F.lit(expected) if isinstance(expected, int) else expected
    return ~all_of([F.col(c) == wanted for c in counts])


def incomplete_days(raw: DataFrame, expected: int | Column) -> DataFrame:
    """Calendar days whose rows, keys or points are not ``expected``; absent days count 0.

    Rows are aggregated by day before meeting the calendar.
    """
    counts = ["lignes", "cles_uniques", "communes"]
    dated = raw.select(F.to_date("time").alias("date_observation"), "code_insee", "row_hash")
    distinct = {"cles_uniques": F.col("row_hash"), "communes": F.col("code_insee")}
    per_day = count_apart(dated, ["date_observation"], [F.count("code_insee").alias("lignes")], distinct)
    every = _with_all_days(per_day.where(F.col("date_observation").isNotNull()), "date_observation")
    return every.fillna(0, counts).where(_differs(counts, expected)).orderBy(F.col("date_observation").desc())


def days_to_refresh(
    raw: DataFrame, start: date, end: date, expected: int | Column, required: Sequence[str]
) -> DataFrame:
    """Days of [start, end] to fetch again: absent, partial, repeated or with missing values."""
    spark = raw.sparkSession
    counts = ["lignes", "communes", "lignes_completes"]
    complete = all_of([F.col(c).isNotNull() for c in required])
    day = F.to_date("time")
    per_day = (
        raw.where(day.between(F.lit(start), F.lit(end)))
        .groupBy(day.alias("jour"))
        .agg(
            count_rows().alias("lignes"),
            F.count_distinct("code_insee").alias("communes"),
            F.count_if(complete).alias("lignes_completes"),
        )
    )
    bounds = spark.range(1).select(F.lit(start).alias("low"), F.lit(end).alias("high"))
    every = _with_all_days(per_day, "jour", bounds)
    return every.fillna(0, counts).where(_differs(counts, expected)).select("jour").orderBy("jour")


def first_incomplete_day(
    raw: DataFrame, start: date, end: date, expected: int | Column, required: Sequence[str]
) -> DataFrame:
    """The first day to fetch again; no row when the history is complete."""
    return days_to_refresh(raw, start, end, expected, required).limit(1)


def freshness(raw: DataFrame, now: Column) -> DataFrame:
    """Last observed day and its age in days on the local calendar."""
    last = F.max(F.to_date("time"))
    return raw.agg(
        last.alias("derniere_date"), F.datediff(local_day(now), last).cast("long").alias("retard_en_jours")
    )


def incomplete_bulletins(bulletins: DataFrame, expected: int) -> DataFrame:
    """Publications without exactly the expected areas, after deduplication."""
    counts = ["lignes", "cles_uniques", "departements"]
    distinct = {"cles_uniques": F.col("row_hash"), "departements": F.col("numero_departement")}
    per_bulletin = count_apart(bulletins, ["reference_time"], [count_rows().alias("lignes")], distinct)
    return per_bulletin.where(_differs(counts, expected)).orderBy(F.col("reference_time").desc())


def volumes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and key counts of the star schema in one row."""

    def rows(table: str, name: str) -> DataFrame:
        return tables[table].agg(count_rows().alias(name))

    def facts(table: str, key: str, rows_name: str, keys_name: str) -> DataFrame:
        return tables[table].agg(count_rows().alias(rows_name), F.count_distinct(key).alias(keys_name))

    return side_by_side(
        [
            rows("dim_commune", "communes"),
            rows("dim_departement", "departements"),
            rows("dim_date", "dates"),
            facts("fact_meteo", "id_observation_meteo", "faits_meteo", "ids_meteo_uniques"),
            facts("fact_danger_incendie", "id_danger_incendie", "faits_incendie", "ids_incendie_uniques"),
        ]
    )


def sync_check(
    raw_weather: DataFrame, fact_meteo: DataFrame, raw_bulletins: DataFrame, fact_danger: DataFrame
) -> DataFrame:
    """Whether the published tables reach the last day and bulletin of the raw history."""
    latest = side_by_side(
        [
            raw_weather.agg(F.max(F.to_date("time")).alias("raw_day")),
            fact_meteo.agg(F.max("date").alias("mart_day")),
            raw_bulletins.agg(F.max("reference_time").alias("raw_time")),
            fact_danger.agg(F.max("reference_time").alias("mart_time")),
        ]
    )
    return latest.select(
        (F.col("raw_day") == F.col("mart_day")).alias("openmeteo_synchronise"),
        (F.col("raw_time") == F.col("mart_time")).alias("meteofrance_synchronise"),
    )


def asof_coverage(joined: DataFrame) -> DataFrame:
    found = F.col("meteo_disponible")
    return joined.agg(
        count_rows().alias("lignes_incendie"),
        F.count_if(found).alias("lignes_avec_meteo"),
        F.count_if(~found).alias("lignes_sans_meteo"),
        F.max("retard_meteo_jours").alias("retard_maximum"),
        pct(F.count_if(found), count_rows()).alias("taux_jointure"),
    )


def training_coverage(train: DataFrame) -> DataFrame:
    usable = F.col("meteo_disponible")
    return train.agg(
        count_rows().alias("lignes"),
        F.count_distinct("id_apprentissage").alias("cles_uniques"),
        F.count_if(usable).alias("lignes_exploitables"),
        F.count_if(~usable).alias("lignes_sans_fenetre_complete"),
    )


def temporal_contract(feature_rows: DataFrame, train: DataFrame) -> DataFrame:
    """Identifiers that break the time rules; a null day is not an anomaly."""
    bad_features = feature_rows.where(
        (F.col("meteo_date") != F.col("date_publication"))
        | (F.col("meteo_disponible") & (F.col("nombre_jours_meteo_7j") != 7))
    ).select(F.col("id_feature").alias("identifiant"))
    ahead = F.datediff("date_prevision", "date_publication")
    label = F.col("echeance")
    bad_targets = train.where(((label == "J1") & (ahead != 1)) | ((label == "J2") & (ahead != 2))).select(
        F.col("id_apprentissage").alias("identifiant")
    )
    return bad_features.unionByName(bad_targets)
