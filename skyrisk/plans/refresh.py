"""The daily and yearly loads: which day, landing, merge into the history."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.operators.quality import check
from skyrisk.plans import controls, ingest
from skyrisk.sources.history import read_history, upsert_history
from skyrisk.sources.landing import landing_name, read_archives, read_bulletins


def last_available_day(now: datetime, lag_days: int = schemas.WEATHER_LAG_DAYS) -> date:
    """The most recent local day the weather source can answer at instant ``now``."""
    return now.astimezone(ZoneInfo(schemas.LOCAL_ZONE)).date() - timedelta(days=lag_days)


def next_weather_day(
    spark: SparkSession, root: str, now: datetime, points: int = schemas.POINT_COUNT, start: date = schemas.REFRESH_START
) -> date | None:
    """First day to fetch, or None when the history is complete. Only the asked days are read."""
    end = last_available_day(now)
    recent = read_history(spark, root, schemas.RAW_WEATHER, start, end)
    found = controls.first_incomplete_day(recent, start, end, points, schemas.REQUIRED_VARIABLES).collect()
    return found[0]["jour"] if found else None


def load_weather_day(
    primary: DataFrame,
    secondary: DataFrame,
    manifest: DataFrame,
    points: DataFrame,
    day: date,
    landing: str,
    root: str,
    at: datetime | None = None,
) -> int:
    """Payloads of one day, all points, into the weather history."""
    folder = f"{landing}/{landing_name('meteo', day.isoformat())}"
    landed = ingest.land_weather(primary, secondary, manifest, points, day, folder, at)
    return upsert_history(landed, root, schemas.RAW_WEATHER, schemas.HISTORY_KEY, "time", "code_insee")


def load_bulletin(spark: SparkSession, path: str, landing: str, root: str, at: datetime | None = None) -> int:
    """One publication into the bulletin history."""
    raw = read_bulletins(spark, path)
    first = raw.select(F.col("reference_time").try_cast("timestamp")).first()  # one record, for the folder's name
    stamp = first[0].strftime("%Y%m%dT%H%M%SZ") if first and first[0] else "inconnu"
    landed = ingest.land_bulletin_payload(raw, f"{landing}/{landing_name('meteo_forets', stamp)}", at)
    return upsert_history(landed, root, schemas.RAW_BULLETINS, schemas.HISTORY_KEY, "reference_time", "dep_code")


def load_archives(
    spark: SparkSession, paths: Mapping[int, str], landing: str, root: str, at: datetime | None = None
) -> int:
    """Whole years into the bulletin history."""
    folder = f"{landing}/{landing_name('archives_meteo_forets', min(paths), max(paths))}"
    landed = ingest.land_archives(read_archives(spark, paths), folder, at)
    return upsert_history(landed, root, schemas.RAW_BULLETINS, schemas.HISTORY_KEY, "reference_time", "dep_code")


def check_points(points: DataFrame, expected: int = schemas.POINT_COUNT) -> DataFrame:
    """The seed of points, once checked."""
    return check(points, ingest.point_rules(expected))
