"""Small frames in the shape of the contracts."""

from __future__ import annotations

import hashlib
import json
from datetime import date, datetime, timezone

from skyrisk import schemas

AT = datetime(2026, 9, 8, 5, 0)


def rows(df, *columns):
    """Sorted tuples of the chosen columns (all by default)."""
    names = columns or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def bulletin(time="2025-07-01T06:00:00Z", codes=None, j1="1", j2="2", name="Nom"):
    """Raw text records of one publication."""
    return [(time, c, name, j1, j2) for c in (codes or schemas.AREA_CODES)]


def raw_bulletins(spark, records):
    return spark.createDataFrame(records, "reference_time string, dep_code string, nom_dep string, niveau_j1 string, niveau_j2 string")


def daily(day="2026-09-01", **changes):
    """One answer of the weather source; a variable set to ... is left out."""
    values = {"time": [day], **{v: [1.0] for v in schemas.WEATHER_VARIABLES}, **changes}
    return {"daily": {k: v for k, v in values.items() if v is not ...}}


def payloads(spark, *bodies):
    return spark.createDataFrame(
        [(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "batch_id long, body string"
    )


def manifest(spark, codes, day=date(2026, 9, 1), size=20):
    items = [(i // size, i % size, c, day) for i, c in enumerate(codes)]
    return spark.createDataFrame(items, schemas.MANIFEST)


def points(spark, codes, areas=None):
    items = [
        (f"Commune {c}", 50.0, 3.0, "Région", f"Département {a}", a, "S", c, True)
        for c, a in zip(codes, areas or ["59"] * len(codes))
    ]
    return spark.createDataFrame(items, schemas.POINTS)


def raw_weather(spark, items):
    """(day, code, values) -> raw rows; other variables are 1.0."""
    out = []
    for day, code, values in items:
        measures = {v: 1.0 for v in schemas.WEATHER_VARIABLES} | values
        out.append(
            (datetime(day.year, day.month, day.day), code, sha(f"{day.isoformat()}|{code}"), AT)
            + tuple(measures[v] for v in schemas.WEATHER_VARIABLES)
        )
    return spark.createDataFrame(out, schemas.RAW_WEATHER)


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)
