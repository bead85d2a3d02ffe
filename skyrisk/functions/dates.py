"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyrisk.schemas import LOCAL_ZONE, MONTH_NAMES, SEASONS, WEEKDAY_NAMES


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day_sequence(low: Column, high: Column) -> Column:
    """Array of days from ``low`` to ``high``; null (so no exploded row) when empty."""
    return F.when(low <= high, F.sequence(low, high, F.expr("interval 1 day")))


def sunday_week(day: Column | str) -> Column:
    """Week of the year starting on Sunday; days before the first Sunday are week 0."""
    day = _col(day)
    return F.floor((F.dayofyear(day) + F.lit(7) - F.dayofweek(day)) / F.lit(7)).cast("long")


def month_name(day: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.month(_col(day)))


def weekday_name(day: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), F.dayofweek(_col(day)))


def season(day: Column | str) -> Column:
    month = F.month(_col(day))
    label = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        label = F.when(month.isin(months), F.lit(name)).otherwise(label)
    return label


def is_weekend(day: Column | str) -> Column:
    return F.dayofweek(_col(day)).isin(1, 7)


def local_day(now: Column, zone: str = LOCAL_ZONE, lag_days: int = 0) -> Column:
    """Calendar day in ``zone`` at UTC instant ``now``, ``lag_days`` earlier."""
    return F.date_sub(F.to_date(F.from_utc_timestamp(now, zone)), lag_days)
