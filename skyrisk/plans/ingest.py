"""From landing files to validated batches ready for the history. A broken rule raises."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.functions.keys import bulletin_key, normalize_area, weather_key
from skyrisk.functions.scalars import safe_double
from skyrisk.operators import quality as Q
from skyrisk.sources.landing import (
    answers_by_point,
    coerce_double,
    fallback_batch,
    flatten_daily,
    lacking_batches,
    land_checked,
    parse_payloads,
    payload_rules,
    unanswered,
    with_ingested_at,
)
from skyrisk.sources.shared import remove, stored

BULLETIN_KEYS = ["reference_time", "dep_code"]


def bulletin_row_rules(domain: list[str] | None = None) -> list[Q.Rule]:
    """Rules on raw bulletins whose fields are text."""
    return [
        Q.not_empty(),
        Q.parses_as_time("reference_time"),
        Q.known_area("dep_code", domain),
        Q.not_blank("nom_dep"),
        Q.whole_between("niveau_j1", 1, 4),
        Q.whole_between("niveau_j2", 1, 4),
    ]


def bulletin_group_rules(areas: int = schemas.AREA_COUNT) -> list[Q.Rule]:
    """Rules on normalised bulletins: no repeated area, every area present."""
    return [Q.unique(*BULLETIN_KEYS), Q.group_size(["reference_time"], "dep_code", areas)]


def normalize_bulletins(raw: DataFrame, domain: list[str] | None = None) -> DataFrame:
    def level(column: str) -> Column:
        return safe_double(column).try_cast("long").alias(column)

    return raw.select(
        F.col("reference_time").try_cast("timestamp").alias("reference_time"),
        normalize_area("dep_code", domain).alias("dep_code"),
        F.trim("nom_dep").alias("nom_dep"),
        level("niveau_j1"),
        level("niveau_j2"),
    )


def _keyed(raw: DataFrame, at: datetime | None, domain: list[str] | None) -> DataFrame:
    clean = normalize_bulletins(raw, domain).withColumn("row_hash", bulletin_key("reference_time", "dep_code"))
    return with_ingested_at(clean, at).select(*schemas.RAW_BULLETINS.names)


def validated_bulletins(
    raw: DataFrame,
    at: datetime | None = None,
    domain: list[str] | None = None,
    extra_rules: list[Q.Rule] | None = None,
) -> DataFrame:
    """Validated bulletins with their key, in no order. Checks read `raw`, and the result reads
    it again; :func:`land_bulletins` reads it once."""
    Q.require_columns(raw, schemas.ARCHIVE_COLUMNS)
    Q.check(raw, bulletin_row_rules(domain) + (extra_rules or []))
    keyed = _keyed(raw, at, domain)
    return Q.check(keyed, bulletin_group_rules(len(domain or schemas.AREA_CODES)))


def prepare_bulletins(
    raw: DataFrame,
    at: datetime | None = None,
    domain: list[str] | None = None,
    extra_rules: list[Q.Rule] | None = None,
) -> DataFrame:
    """Validated bulletins as a listing by publication and area; loads need no order."""
    return validated_bulletins(raw, at, domain, extra_rules).orderBy(*BULLETIN_KEYS)


def land_bulletins(
    raw: DataFrame,
    path: str,
    at: datetime | None = None,
    domain: list[str] | None = None,
    extra_rules: list[Q.Rule] | None = None,
) -> DataFrame:
    """Bulletins validated while they land at `path`: the source is read once."""
    Q.require_columns(raw, schemas.ARCHIVE_COLUMNS)
    return land_checked(
        raw, lambda df: _keyed(df, at, domain), path,
        raw_rules=bulletin_row_rules(domain) + (extra_rules or []),
        group_rules=bulletin_group_rules(len(domain or schemas.AREA_CODES)),
        order=BULLETIN_KEYS,
    )


def land_bulletin_payload(raw: DataFrame, path: str, at: datetime | None = None, domain: list[str] | None = None) -> DataFrame:
    """A single publication: exactly one record per area."""
    return land_bulletins(raw, path, at, domain, [Q.row_count(len(domain or schemas.AREA_CODES))])


def land_archives(archives: DataFrame, path: str, at: datetime | None = None, domain: list[str] | None = None) -> DataFrame:
    """Yearly archives; every bulletin must belong to the year of its file."""
    Q.require_columns(archives, [*schemas.ARCHIVE_COLUMNS, "annee_archive"])
    return land_bulletins(archives, path, at, domain, [Q.in_year("reference_time", "annee_archive")])


def prepare_bulletin_payload(raw: DataFrame, at: datetime | None = None, domain: list[str] | None = None) -> DataFrame:
    """A single publication: exactly one record per area."""
    return prepare_bulletins(raw, at, domain, [Q.row_count(len(domain or schemas.AREA_CODES))])


def prepare_archives(archives: DataFrame, at: datetime | None = None, domain: list[str] | None = None) -> DataFrame:
    """Yearly archives; every bulletin must belong to the year of its file."""
    Q.require_columns(archives, [*schemas.ARCHIVE_COLUMNS, "annee_archive"])
    return prepare_bulletins(archives, at, domain, [Q.in_year("reference_time", "annee_archive")])


def collect_weather(
    primary: DataFrame,
    secondary: DataFrame,
    manifest: DataFrame,
    at: datetime | None = None,
) -> DataFrame:
    """Weather rows of a day from landing payloads, whole batches falling back when incomplete.

    Payload frames hold (batch_id, body); the manifest lists the requested points. The
    primary source answers every batch, the secondary one at least those that fall back.
    """
    again = manifest.join(secondary.select("batch_id").distinct(), "batch_id", "left_semi")
    frames = []
    for payloads, asked in ((primary, manifest), (secondary, again)):
        answered = answers_by_point(parse_payloads(payloads), asked)
        Q.check(answered, payload_rules())
        frames.append(flatten_daily(answered, at=at))
    lost = unanswered(frames[0], frames[1], "batch_id", "code_insee", schemas.REQUIRED_VARIABLES)
    if examples := lost.limit(3).collect():
        raise Q.ContractError(f"No substitute for incomplete batches, such as {[tuple(r) for r in examples]}")
    rows = fallback_batch(frames[0], frames[1], "batch_id", schemas.REQUIRED_VARIABLES)
    return rows.select(*schemas.RAW_WEATHER.names)


def weather_row_rules(expected: int, day: date) -> list[Q.Rule]:
    """Rules on the rows of a collected day."""
    return [
        Q.not_empty(),
        Q.row_count(expected),
        Q.on_day("time", day),
        *Q.not_null("insere_a"),
        Q.finite(*schemas.WEATHER_VARIABLES),
        *Q.not_missing(*schemas.REQUIRED_VARIABLES),
        Q.key_matches("row_hash", weather_key(F.lit(day), "code_insee")),
    ]


def weather_key_rules(points: DataFrame) -> list[Q.Rule]:
    """The points of the reference, once each."""
    return [Q.unique("code_insee"), Q.same_keys("code_insee", points, "code_insee")]


def weather_rules(points: DataFrame, expected: int, day: date) -> list[Q.Rule]:
    """Rules on a collected day: the points of the reference, once each, on the asked day."""
    return weather_row_rules(expected, day) + weather_key_rules(points)


def _typed(collected: DataFrame) -> DataFrame:
    batch = coerce_double(collected.select(*schemas.RAW_WEATHER.names), schemas.WEATHER_VARIABLES)
    return batch.withColumns(
        {
            "code_insee": F.trim("code_insee"),
            "time": F.col("time").cast("timestamp"),
            "insere_a": F.col("insere_a").cast("timestamp"),
        }
    )


def prepare_weather(collected: DataFrame, points: DataFrame, day: date) -> DataFrame:
    """A validated weather day with the contract's columns."""
    Q.require_columns(collected, schemas.RAW_WEATHER.names)
    places = points.select(F.trim("code_insee").alias("code_insee"))
    return Q.check(_typed(collected), weather_rules(places, places.count(), day))


def land_weather(
    primary: DataFrame, secondary: DataFrame, manifest: DataFrame, points: DataFrame, day: date, path: str, at: datetime | None = None
) -> DataFrame:
    """A weather day from payloads, validated while it lands at `path`.

    Payloads are read and parsed once: their rows land beside `path`, measured as they pass.
    The secondary source is parsed for the batches that the primary one leaves incomplete.
    """
    spark, aside = manifest.sparkSession, f"{path}.{uuid.uuid4().hex}"

    def landed(payloads: DataFrame, asked: DataFrame, name: str) -> DataFrame:
        answered = answers_by_point(parse_payloads(payloads), asked)
        return land_checked(answered, lambda df: flatten_daily(df, at=at), f"{aside}/{name}", raw_rules=payload_rules())

    try:
        first = landed(primary, manifest, "primary")
        lacking = stored(lacking_batches(first, "batch_id", schemas.REQUIRED_VARIABLES), "lacking")
        answering = secondary.join(lacking, "batch_id", "left_semi")
        asked = manifest.join(lacking, "batch_id", "left_semi").join(secondary.select("batch_id").distinct(), "batch_id", "left_semi")
        second = landed(answering, asked, "secondary")
        lost = unanswered(first, second, "batch_id", "code_insee", schemas.REQUIRED_VARIABLES)
        if examples := lost.limit(3).collect():
            raise Q.ContractError(f"No substitute for incomplete batches, such as {[tuple(r) for r in examples]}")
        rows = fallback_batch(first, second, "batch_id", schemas.REQUIRED_VARIABLES)
        places = points.select(F.trim("code_insee").alias("code_insee"))
        return land_checked(
            rows, _typed, path, rules=weather_row_rules(places.count(), day), group_rules=weather_key_rules(places), order=["code_insee"]
        )
    finally:
        remove(spark, aside)


def point_rules(expected: int = schemas.POINT_COUNT) -> list[Q.Rule]:
    """Rules on the seed of points."""
    return [Q.row_count(expected), *Q.not_null("code_insee"), Q.unique("code_insee")]
