"""Horizons as rows and as columns; calendars; one-row summaries side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk.functions.dates import day_sequence


def unpivot(df: DataFrame, keep: Sequence[Column | str], rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One output row per input row and per item of ``rows``, in a single scan."""
    items = F.array(*[F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows])
    return df.select(*keep, F.inline(items))


def expand_horizons(df: DataFrame, day: str, horizons: Sequence[int] = (1, 2)) -> DataFrame:
    """Each row once per horizon, with its label and target day."""
    return (
        df.withColumn("horizon_jours", F.explode(F.array(*[F.lit(h).cast("long") for h in horizons])))
        .withColumn("echeance", F.concat(F.lit("J"), F.col("horizon_jours").cast("string")))
        .withColumn("date_prevision", F.date_add(F.col(day), F.col("horizon_jours").cast("int")))
    )


def pivot_pairs(
    df: DataFrame, keys: list[str], label: str, value: str, labels: Sequence[str]
) -> DataFrame:
    """Labels to columns; keys that lack one of the labels are dropped."""
    wide = df.groupBy(*keys).pivot(label, list(labels)).agg(F.first(value, ignorenulls=True))
    return wide.dropna(subset=list(labels))


def calendar(bounds: DataFrame, low: str, high: str, name: str = "date") -> DataFrame:
    """Every day between the two columns of a one-row frame, bounds included."""
    return bounds.select(F.explode(day_sequence(F.col(low), F.col(high))).alias(name))


def side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
    """One row made of the columns of several one-row frames."""
    tall = parts[0]
    for part in parts[1:]:
        tall = tall.unionByName(part, allowMissingColumns=True)
    names = [name for part in parts for name in part.columns]
    return tall.agg(*[F.max(name).alias(name) for name in names])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate, aligning columns by name; absent ones are null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
