"""Build the published tables from the raw history: lazily, or written to a warehouse folder."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.plans import marts, staging

# Tables worth writing; the staging ones are cheap projections recomputed by their readers.
WRITTEN = [
    "dim_commune",
    "dim_departement",
    "int_meteo_departement_jour",
    "dim_date",
    "fact_meteo",
    "fact_danger_incendie",
    "pbi_risque_incendie",
    "ml_features_incendie",
    "ml_train_incendie",
]


def build(
    raw_weather: DataFrame,
    raw_bulletins: DataFrame,
    points: DataFrame,
    materialise: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> dict[str, DataFrame]:
    """All tables by name. ``materialise`` may write a table and return a frame that reads it."""
    tables: dict[str, DataFrame] = {}

    def publish(name: str, df: DataFrame) -> DataFrame:
        tables[name] = materialise(name, df)
        return tables[name]

    weather = publish("stg_meteo_journaliere", staging.stage_weather(raw_weather))
    bulletins = publish("stg_meteo_forets", staging.stage_bulletins(raw_bulletins))
    publish("referentiel_communes", points)
    observations = publish("int_meteo_communes", marts.enrich_points(weather, points))
    publish("dim_commune", marts.dim_point(points))
    areas = publish("dim_departement", marts.dim_area(points))
    names = marts.area_names(points)
    # The raw weather is read for the fact alone: when that is written, area-days and the
    # calendar come from it.
    fact = publish("fact_meteo", marts.fact_weather(observations))
    # Read by the danger table and by the model features: computed once when written.
    area_day = publish("int_meteo_departement_jour", marts.weather_by_area_day(fact, names))
    # Publication days need neither deduplication nor horizons.
    published = staging.name_bulletins(raw_bulletins)
    publish("dim_date", marts.dim_date(marts.date_bounds(fact, published)))
    danger = publish("fact_danger_incendie", marts.fact_danger(bulletins))
    publish("pbi_risque_incendie", marts.danger_with_weather(danger, areas, area_day))
    feature_rows = publish("ml_features_incendie", marts.features(area_day, published))
    publish("ml_train_incendie", marts.training(danger, feature_rows, areas))
    return tables


def write_fact_weather(fact: DataFrame, path: str) -> None:
    """Month folders, files sorted by point; adaptive execution splits large months."""
    (
        fact.withColumn("month", F.date_format("date", "yyyy-MM"))
        .hint("rebalance", "month")
        .sortWithinPartitions("month", "code_insee")
        .write.mode("overwrite")
        .partitionBy("month")
        .parquet(path)
    )


def to_warehouse(root: str, written: Collection[str] = tuple(WRITTEN)) -> Callable[[str, DataFrame], DataFrame]:
    """A ``materialise`` function that writes each table once under a shared folder."""

    def materialise(name: str, df: DataFrame) -> DataFrame:
        if name not in written:
            return df
        path = f"{root}/{name}"
        if name == "fact_meteo":
            write_fact_weather(df, path)
        else:
            df.write.mode("overwrite").parquet(path)
        stored = df.sparkSession.read.schema(df.schema).parquet(path)
        return stored.select(*df.columns)

    return materialise
