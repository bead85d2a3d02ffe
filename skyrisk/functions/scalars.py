"""Casts, rounding, null-strict extremes and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyrisk.schemas import LEVEL_NAMES, UNKNOWN_LEVEL


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


# Decimal literals, and the words for what is no number. A plain cast also takes type
# suffixes (2d, 2f) and hexadecimal floats, which no source means.
NUMBER = r"(?i)^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"


def safe_double(value: Column | str) -> Column:
    """Double, or null when the text is not a number. Typed numbers are only cast: the type
    is a constant that is asked first, so the pattern is left alone."""
    value = _col(value)
    literal = (F.typeof(value) != "string") | value.cast("string").rlike(NUMBER)
    return F.when(literal, value.try_cast("double"))


def strict_double(value: Column | str) -> Column:
    """Double; text that is not a number fails the job."""
    value = _col(value)
    number = safe_double(value)
    failure = F.raise_error(F.concat(F.lit("Not a number: "), value.cast("string")))
    return F.when(value.isNull() | number.isNotNull(), number).otherwise(failure.cast("double"))


def safe_long(value: Column | str) -> Column:
    """Long, halves rounded away from zero, or null. A plain cast would truncate."""
    return F.round(safe_double(value)).try_cast("long")


def nan_to_null(value: Column | str) -> Column:
    value = _col(value)
    return F.when(~F.isnan(value), value)


def is_missing(value: Column | str) -> Column:
    """Null or NaN (for floating-point columns)."""
    value = _col(value)
    return value.isNull() | F.isnan(value)


def is_infinite(value: Column | str) -> Column:
    return F.abs(_col(value)) == F.lit(float("inf"))


def least_strict(*values: Column) -> Column:
    """Smallest value, null when any is null (``least`` skips nulls)."""
    return F.when(all_of([v.isNotNull() for v in values]), F.least(*values))


def greatest_strict(*values: Column) -> Column:
    return F.when(all_of([v.isNotNull() for v in values]), F.greatest(*values))


def round_even2(value: Column) -> Column:
    """Two decimals, ties to even, as numpy and pandas round."""
    return F.rint(value * F.lit(100.0)) / F.lit(100.0)


def pct(part: Column, total: Column, digits: int = 2) -> Column:
    """``100 * part / total``, half-up, null for a zero total."""
    return F.round(F.lit(100.0) * F.try_divide(part.cast("double"), total.cast("double")), digits)


def level_name(level: Column | str) -> Column:
    level = _col(level)
    names = F.lit(UNKNOWN_LEVEL)
    for number, name in LEVEL_NAMES.items():
        names = F.when(level == number, F.lit(name)).otherwise(names)
    return names


def level_label(level: Column | str) -> Column:
    level = _col(level)
    return F.concat(F.lit("Niveau "), level.cast("string"), F.lit(" - "), level_name(level))
