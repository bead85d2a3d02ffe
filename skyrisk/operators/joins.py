"""Joins Spark does not offer as a single call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def with_validity(df: DataFrame, by: list[str], on: str, name: str = "date_suivante") -> DataFrame:
    """Add the next day seen for the same place; the last one is open until 9999-12-31.

    The input has one row per place and day, so a window group holds at most one row per
    day of the calendar.
    """
    window = Window.partitionBy(*by).orderBy(on)
    last = F.lit("9999-12-31").cast("date")
    return df.withColumn(name, F.coalesce(F.lead(on).over(window), last))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_on: str,
    right_on: str,
) -> DataFrame:
    """Left join to the last ``right`` row dated on or before each left day. A right row
    without a day precedes nothing.

    ``right`` has one row per (``by``, ``right_on``); ``by`` names must be shared. Every
    left row is kept, with nulls when nothing precedes it.

    Which right row answers which day is resolved on the *distinct* (place, day) pairs of
    the left side, laid on one time line with the right rows: a window group is then at
    most two rows per calendar day, whatever the number of left rows, and no pair of rows
    is ever compared. The left rows themselves only meet the answers in an equi join,
    where a hot (place, day) is reduced map-side on one branch and split by adaptive
    execution on the other.
    """
    payload = [c for c in right.columns if c not in by]
    dated = right.where(F.col(right_on).isNotNull())
    known = dated.select(*by, F.col(right_on).alias("_day"), F.struct(*payload).alias("_seen"))
    asked = (
        left.select(*by, F.col(left_on).alias("_day"))
        .where(F.col("_day").isNotNull())
        .distinct()
        .withColumn("_seen", F.lit(None).cast(known.schema["_seen"].dataType))
    )
    # Right rows first within a day, so that a row of the same day is a match.
    line = Window.partitionBy(*by).orderBy("_day", F.col("_seen").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    answers = (
        known.unionByName(asked)
        .withColumn("_match", F.last("_seen", ignorenulls=True).over(line))
        .where(F.col("_seen").isNull() & F.col("_match").isNotNull())
        .select(*by, F.col("_day").alias(left_on), "_match")
    )
    return left.join(answers, [*by, left_on], "left").select(
        *[left[c] for c in left.columns if c not in {*by, left_on}],
        *by,
        left_on,
        *[F.col(f"_match.{c}").alias(c) for c in payload],
    )


def keep_known(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose non-null key exists in ``parent``."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.join(keys, child_key, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose non-null key has no row in ``parent``."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def latest_where_complete(
    df: DataFrame,
    on: str,
    member: str,
    usable: Column,
    expected: Column,
) -> DataFrame:
    """Usable rows of the latest ``on`` value that covers all ``expected`` members."""
    ready = df.where(usable)
    latest = (
        ready.groupBy(on)
        .agg(F.count_distinct(member).alias("_members"))
        .where(F.col("_members") == expected)
        .orderBy(F.col(on).desc())
        .limit(1)
        .select(on)
    )
    return ready.join(latest, on, "left_semi")
