"""Published tables kept up by change: what a load touched decides what is computed again.

Every table is a history of its own (:mod:`skyrisk.sources.history`), a folder a day, replaced
day by day and published by a commit. A change of weather days D and bulletin days B reaches

* the fact and the area-days of D,
* the features of publications in the seven days from each day of D, and of B,
* the danger rows of B,
* the answers (danger with the last known weather) of publications from each day of D until the
  next day on which an area has weather, and of B,
* the training rows of the days whose features or danger rows changed.

Only the days that these need are read, and folders of other days stay as they are. The result
equals a build from the whole history. Rows without a day have no folder and are left out.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyrisk import schemas
from skyrisk.plans import build, marts, staging
from skyrisk.sources.history import live_days, read_history, replace_days

# Table -> its day, and the order of rows in a file.
DAYS = {
    "fact_meteo": ("date", "code_insee"),
    "int_meteo_departement_jour": ("date", "numero_departement"),
    "fact_danger_incendie": ("date_publication", "numero_departement"),
    "pbi_risque_incendie": ("date_publication", "numero_departement"),
    "ml_features_incendie": ("date_publication", "numero_departement"),
    "ml_train_incendie": ("date_publication", "numero_departement"),
}


FIRST, LAST = -1 << 30, 1 << 30  # before and after all days


def _answered(weather: set[date], spans: set[tuple[int, int]], known: set[date]) -> set[date]:
    """Publication days that may look back to a touched day: from it to the end of the span it is
    in, before or after the change, in the area where that ends last."""
    if not weather or not spans or not known:
        return set()
    epoch = date(1970, 1, 1)
    start, until = np.array(sorted(spans)).T
    published = np.array(sorted((d - epoch).days for d in known))
    hit = np.zeros(len(published), bool)
    for day in sorted((d - epoch).days for d in weather):
        inside = (start <= day) & (day < until)
        if inside.any():
            hit |= (published >= day) & (published < until[inside].max())
    return {epoch + timedelta(int(d)) for d in published[hit]}


@dataclass
class Warehouse:
    """The raw histories, the seed of points, and the folder of the tables kept up from them."""

    spark: SparkSession
    weather: str
    bulletins: str
    points: DataFrame
    root: str

    @cached_property
    def _schemas(self) -> dict[str, StructType]:
        empty = [self.spark.createDataFrame([], s) for s in (schemas.RAW_WEATHER, schemas.RAW_BULLETINS)]
        tables = build.build(*empty, self.points)
        return {name: tables[name].schema for name in DAYS}

    def read(self, name: str, only: Iterable[date] | None = None, end: date | None = None) -> DataFrame:
        return read_history(self.spark, f"{self.root}/{name}", self._schemas[name], end=end, only=only)

    def calendar(self) -> DataFrame:
        """The calendar, from the first and last days alone."""
        ends = [sorted(live_days(self.spark, r)[1]) for r in (f"{self.root}/fact_meteo", self.bulletins)]
        observed = self.read("fact_meteo", [d for e in ends[:1] for d in (e[:1] + e[-1:])])
        published = self._bulletins([d for e in ends[1:] for d in (e[:1] + e[-1:])])
        return marts.dim_date(marts.date_bounds(observed, published))

    def _bulletins(self, days: Iterable[date]) -> DataFrame:
        raw = read_history(self.spark, self.bulletins, schemas.RAW_BULLETINS, only=days)
        return staging.name_bulletins(raw)

    def _replace(self, name: str, rows: DataFrame, days: set[date]) -> None:
        if days:
            day, order = DAYS[name]
            replace_days(rows.select(*self._schemas[name].names), f"{self.root}/{name}", day, order, days)

    def update(self, weather_days: Iterable[date], bulletin_days: Iterable[date]) -> dict[str, set[date]]:
        """Compute again what these days of the histories reach; the days of each table."""
        weather, published = set(weather_days), set(bulletin_days)
        areas, names = marts.dim_area(self.points), marts.area_names(self.points)

        raw = read_history(self.spark, self.weather, schemas.RAW_WEATHER, only=weather)
        observations = marts.enrich_points(staging.stage_weather(raw), self.points)
        self._replace("fact_meteo", marts.fact_weather(observations), weather)
        area_days = marts.weather_by_area_day(self.read("fact_meteo", weather), names)
        spans = self._spans()
        self._replace("int_meteo_departement_jour", area_days, weather)
        spans |= self._spans()

        known = set(live_days(self.spark, self.bulletins)[1]) | published
        reached = {d + timedelta(i) for d in weather for i in range(marts.WINDOW_DAYS)}
        feature_days = (reached & known) | published
        window = {d - timedelta(i) for d in feature_days for i in range(marts.WINDOW_DAYS)}
        feature_rows = marts.features(self.read("int_meteo_departement_jour", window), self._bulletins(feature_days))
        self._replace("ml_features_incendie", feature_rows, feature_days)

        raw = read_history(self.spark, self.bulletins, schemas.RAW_BULLETINS, only=published)
        self._replace("fact_danger_incendie", marts.fact_danger(staging.stage_bulletins(raw)), published)

        answer_days = _answered(weather, spans, known) | published
        if answer_days:
            danger = self.read("fact_danger_incendie", answer_days)
            so_far = self.read("int_meteo_departement_jour", end=max(answer_days))
            self._replace("pbi_risque_incendie", marts.danger_with_weather(danger, areas, so_far), answer_days)

        rows = marts.training(self.read("fact_danger_incendie", feature_days), self.read("ml_features_incendie", feature_days), areas)
        self._replace("ml_train_incendie", rows, feature_days)
        return {
            "fact_meteo": weather, "int_meteo_departement_jour": weather, "ml_features_incendie": feature_days,
            "fact_danger_incendie": published, "pbi_risque_incendie": answer_days, "ml_train_incendie": feature_days,
        }

    def _spans(self) -> set[tuple[int, int]]:
        """Distinct spans between the weather days of an area, as days since 1970, open ends
        included: a few for every day, whatever the number of areas."""
        have = self.read("int_meteo_departement_jour").select(*marts.AREA, F.unix_date("date").alias("day"))
        own = Window.partitionBy(*marts.AREA).orderBy("day")
        near = have.select("day", F.lag("day", 1, FIRST).over(own).alias("before"), F.lead("day", 1, LAST).over(own).alias("after"))
        spans = near.select("before", "day").union(near.select("day", "after")).distinct()
        return {tuple(r) for r in spans.collect()}

    def fill(self) -> dict[str, set[date]]:
        """All tables, from all days of the histories."""
        return self.update(live_days(self.spark, self.weather)[1], live_days(self.spark, self.bulletins)[1])
