"""Row keys, identifiers and area codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyrisk.schemas import AREA_CODES


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sha256_hex(text: Column | str) -> Column:
    return F.sha2(_col(text), 256)


def make_id(*parts: Column | str, sep: str = "|") -> Column:
    """Join parts as text. A null part makes the id null (unlike ``concat_ws``)."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)


def iso_utc(ts: Column | str) -> Column:
    """ISO text of a UTC timestamp; the fraction appears only when it is not zero.

    Two sources that describe the same bulletin give the same text, hence the same key.
    """
    ts = _col(ts)
    whole = F.date_trunc("second", ts) == ts
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def weather_key(day: Column | str, code: Column | str) -> Column:
    return sha256_hex(make_id(F.date_format(_col(day), "yyyy-MM-dd"), code))


def bulletin_key(reference_time: Column | str, code: Column | str) -> Column:
    return sha256_hex(make_id(iso_utc(reference_time), code))


def normalize_area(code: Column | str, domain: list[str] | None = None) -> Column:
    """Trim, upper-case and zero-pad an area code; null when it is not in the domain.

    Only codes shorter than two digits are padded: ``lpad`` would also cut longer ones.
    """
    domain = AREA_CODES if domain is None else domain
    text = F.upper(F.trim(_col(code)))
    padded = F.when(text.rlike("^[0-9]$"), F.concat(F.lit("0"), text)).otherwise(text)
    return F.when(padded.isin(domain), padded)
