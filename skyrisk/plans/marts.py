"""The published tables. Each function takes the tables it reads and returns one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.functions import dates
from skyrisk.functions.keys import make_id
from skyrisk.functions.scalars import all_of, greatest_strict, least_strict
from skyrisk.operators.aggregates import all_complete
from skyrisk.operators.joins import asof_join
from skyrisk.operators.reshape import calendar, unpivot
from skyrisk.operators.windows import dedupe_latest, gated, over, rolling_days

AREA = ["numero_departement"]
WINDOW_DAYS = 7

# Measures a day needs to count as complete: per point, then per area.
POINT_REQUIRED = [
    "temperature_moyenne",
    "temperature_maximale",
    "humidite_moyenne",
    "precipitations_totales",
    "rafale_vent_maximale",
    "deficit_pression_vapeur_maximal",
]
AREA_REQUIRED = [c if c != "precipitations_totales" else "precipitations_moyennes" for c in POINT_REQUIRED]

SAME_DAY = [
    "temperature_moyenne",
    "temperature_maximale",
    "humidite_moyenne",
    "precipitations_totales",
    "precipitations_moyennes",
    "rafale_vent_maximale",
    "deficit_pression_vapeur_maximal",
]


# --- Weather ----------------------------------------------------------------------------


# A list of at most so many points is sent to the observations; around a longer one both sides
# are shuffled, with the same rows.
SENT_POINTS = 500_000


def enrich_points(weather: DataFrame, points: DataFrame) -> DataFrame:
    """Observations with the attributes of their point; unknown points are dropped."""
    places = points.select(*schemas.POINTS.names)
    if places.limit(SENT_POINTS + 1).count() <= SENT_POINTS:
        places = F.broadcast(places)
    return weather.join(places, "code_insee").select(
        "row_hash",
        "insere_a",
        "date",
        "code_insee",
        *[c for c in schemas.POINTS.names if c != "code_insee"],
        *schemas.WEATHER_MEASURES,
    )


def fact_weather(observations: DataFrame) -> DataFrame:
    return observations.select(
        F.col("row_hash").alias("id_observation_meteo"),
        "date",
        "code_insee",
        "numero_departement",
        *schemas.WEATHER_MEASURES,
    )


def area_names(points: DataFrame) -> DataFrame:
    """One name and region per area code; min makes the choice deterministic."""
    return points.groupBy(*AREA).agg(F.min("departement").alias("departement"), F.min("region").alias("region"))


def weather_by_area_day(observations: DataFrame, names: DataFrame) -> DataFrame:
    """Area-days, named by :func:`area_names`.

    The measures and the exact count of points are two aggregations. In one, Spark would
    shuffle every measure of every point for the sake of the distinct count; apart, the
    measures leave each task already reduced to area-days, and only (area, day, point)
    keys are shuffled to be counted. Names are joined afterwards: aggregating text would
    turn the hash aggregation of the observations into a sort.
    """
    keys = ["date", *AREA]
    measures = observations.groupBy(*keys).agg(
        all_complete(POINT_REQUIRED).alias("mesures_completes"),
        F.avg("temperature_moyenne").alias("temperature_moyenne"),
        F.min("temperature_minimale").alias("temperature_minimale"),
        F.max("temperature_maximale").alias("temperature_maximale"),
        F.avg("humidite_moyenne").alias("humidite_moyenne"),
        F.sum("precipitations_totales").alias("precipitations_totales"),
        F.avg("precipitations_totales").alias("precipitations_moyennes"),
        F.avg("vitesse_vent_moyenne").alias("vitesse_vent_moyenne"),
        F.max("rafale_vent_maximale").alias("rafale_vent_maximale"),
        F.avg("couverture_nuageuse_moyenne").alias("couverture_nuageuse_moyenne"),
        F.max("deficit_pression_vapeur_maximal").alias("deficit_pression_vapeur_maximal"),
    )
    points = observations.groupBy(*keys).agg(F.count_distinct("code_insee").alias("nombre_points_meteo"))
    values = [c for c in measures.columns if c not in keys]
    # Grouping, unlike a join, also puts together the two rows of an area without code.
    area_days = (
        measures.unionByName(points, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(*[F.max(c).alias(c) for c in ("nombre_points_meteo", *values)])
    )
    named = names.select(F.col(AREA[0]).alias("_area"), "departement", "region")
    return area_days.join(named, F.col(AREA[0]).eqNullSafe(F.col("_area")), "left").select(
        *keys, "departement", "region", "nombre_points_meteo", *values
    )


# --- Dimensions -------------------------------------------------------------------------


def dim_point(points: DataFrame) -> DataFrame:
    return points.select(
        "code_insee", "commune", *AREA, "departement", "region", "latitude", "longitude", "service", "centroide"
    )


def dim_area(points: DataFrame) -> DataFrame:
    return points.select(*AREA, "departement", "region").distinct()


def date_bounds(weather: DataFrame, bulletins: DataFrame) -> DataFrame:
    """First and last day over observations and targets, in one row.

    A source whose two target columns are not both known gives no bound, and a source
    without rows leaves the bounds to the other one.
    """
    observed = weather.agg(F.min("date").alias("date_min"), F.max("date").alias("date_max"))
    targets = bulletins.agg(
        least_strict(F.min("date_j1"), F.min("date_j2")).alias("date_min"),
        greatest_strict(F.max("date_j1"), F.max("date_j2")).alias("date_max"),
    )
    return observed.unionByName(targets).agg(
        F.min("date_min").alias("date_min"), F.max("date_max").alias("date_max")
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    day = F.col("date")
    return calendar(bounds, "date_min", "date_max").select(
        "date",
        F.year(day).cast("long").alias("annee"),
        F.quarter(day).cast("long").alias("trimestre"),
        F.month(day).cast("long").alias("numero_mois"),
        dates.month_name(day).alias("mois"),
        dates.sunday_week(day).alias("numero_semaine"),
        F.dayofmonth(day).cast("long").alias("jour_du_mois"),
        F.dayofweek(day).cast("long").alias("numero_jour_semaine"),
        dates.weekday_name(day).alias("jour_semaine"),
        dates.season(day).alias("saison"),
        dates.is_weekend(day).alias("est_weekend"),
    )


# --- Danger -----------------------------------------------------------------------------


def fact_danger(bulletins: DataFrame) -> DataFrame:
    """One row per bulletin, area and horizon."""
    rows = [
        {
            "id_danger_incendie": F.concat("row_hash", F.lit(f"-{label}")),
            "date_prevision": F.col(f"date_{label.lower()}"),
            "echeance": F.lit(label),
            "niveau_danger": F.col(f"niveau_{label.lower()}"),
        }
        for label in schemas.HORIZONS
    ]
    tall = unpivot(bulletins, ["reference_time", "date_publication", *AREA, "insere_a"], rows)
    return tall.select(
        "id_danger_incendie",
        "reference_time",
        "date_publication",
        "date_prevision",
        *AREA,
        "echeance",
        "niveau_danger",
        "insere_a",
    )


def danger_with_weather(danger: DataFrame, areas: DataFrame, area_day: DataFrame) -> DataFrame:
    """Each announced level with the last weather known on its publication day, and its age."""
    weather = area_day.select(
        *AREA,
        F.col("date").alias("date_meteo_utilisee"),
        "nombre_points_meteo",
        "temperature_moyenne",
        "temperature_minimale",
        "temperature_maximale",
        "humidite_moyenne",
        "precipitations_totales",
        "vitesse_vent_moyenne",
        "rafale_vent_maximale",
        "couverture_nuageuse_moyenne",
        "deficit_pression_vapeur_maximal",
    )
    named = danger.join(areas.select(*AREA, "departement", "region"), AREA)
    joined = asof_join(named, weather, AREA, "date_publication", "date_meteo_utilisee")
    used = F.col("date_meteo_utilisee")
    measures = [c for c in weather.columns if c not in (*AREA, "date_meteo_utilisee")]
    return joined.select(
        "id_danger_incendie",
        "reference_time",
        "date_publication",
        "date_prevision",
        "echeance",
        *AREA,
        "departement",
        "region",
        "niveau_danger",
        "date_meteo_utilisee",
        F.datediff("date_publication", used).cast("long").alias("retard_meteo_jours"),
        *measures,
        used.isNotNull().alias("meteo_disponible"),
    )


# --- Model tables -----------------------------------------------------------------------


def rolling_weather(area_day: DataFrame) -> DataFrame:
    """Area-days with aggregates over the seven calendar days ending on each.

    Only the mean rain columns wait for seven values; the others use what is there.
    """
    rain = "precipitations_moyennes"
    complete = F.col("mesures_completes") & all_of([F.col(c).isNotNull() for c in AREA_REQUIRED])
    return rolling_days(
        area_day,
        AREA,
        "date",
        WINDOW_DAYS,
        {
            "temperature_moyenne_7j": over(F.avg("temperature_moyenne")),
            "temperature_maximale_7j": over(F.max("temperature_maximale")),
            "humidite_moyenne_7j": over(F.avg("humidite_moyenne")),
            "precipitations_7j": over(F.sum("precipitations_totales")),
            "precipitations_moyennes_7j": gated(rain, F.sum(rain), WINDOW_DAYS),
            "rafale_vent_maximale_7j": over(F.max("rafale_vent_maximale")),
            "deficit_pression_vapeur_maximal_7j": over(F.max("deficit_pression_vapeur_maximal")),
            "jours_sans_pluie_7j": gated(rain, F.count_if(F.col(rain) == 0), WINDOW_DAYS),
            "nombre_jours_meteo_7j": over(F.count_if(complete)),
        },
    )


ROLLING = [
    "temperature_moyenne_7j",
    "temperature_maximale_7j",
    "humidite_moyenne_7j",
    "precipitations_7j",
    "precipitations_moyennes_7j",
    "rafale_vent_maximale_7j",
    "deficit_pression_vapeur_maximal_7j",
    "jours_sans_pluie_7j",
]


def features(area_day: DataFrame, bulletins: DataFrame) -> DataFrame:
    """Weather known on each publication day, without any target.

    ``bulletins`` may be the danger table, or any frame with its publication days and
    areas, repeated or not. The match is on the exact day: a publication without same-day
    weather keeps nulls.
    """
    published = bulletins.select("date_publication", *AREA).distinct()
    weather = rolling_weather(area_day).withColumn("meteo_date", F.col("date"))
    days = F.col("nombre_jours_meteo_7j")
    joined = published.join(weather.withColumnRenamed("date", "date_publication"), ["date_publication", *AREA], "left")
    return joined.select(
        make_id("date_publication", *AREA).alias("id_feature"),
        "date_publication",
        "meteo_date",
        *AREA,
        "departement",
        "region",
        "nombre_points_meteo",
        *SAME_DAY,
        *ROLLING,
        "nombre_jours_meteo_7j",
        F.coalesce(days == WINDOW_DAYS, F.lit(False)).alias("meteo_disponible"),
    )


def latest_danger_of_day(danger: DataFrame) -> DataFrame:
    """The last bulletin of each publication day, per area and horizon."""
    return dedupe_latest(
        danger,
        ["date_publication", *AREA, "echeance"],
        ["reference_time", "insere_a", "id_danger_incendie"],
    )


def training(danger: DataFrame, feature_rows: DataFrame, areas: DataFrame) -> DataFrame:
    """Announced level (the target) with the features of its publication day."""
    known = feature_rows.drop("id_feature", "departement", "region", "nombre_jours_meteo_7j")
    rows = latest_danger_of_day(danger).join(known, ["date_publication", *AREA])
    rows = rows.join(areas.select(*AREA, "departement", "region"), AREA)
    horizon = F.when(F.col("echeance") == "J1", 1).otherwise(2).cast("long")
    return rows.select(
        make_id("date_publication", *AREA, "echeance").alias("id_apprentissage"),
        "reference_time",
        "date_publication",
        "date_prevision",
        *AREA,
        "departement",
        "region",
        "echeance",
        horizon.alias("horizon_jours"),
        F.col("niveau_danger").alias(schemas.MODEL_TARGET),
        "meteo_date",
        "nombre_points_meteo",
        *SAME_DAY,
        *ROLLING,
        "meteo_disponible",
    )
