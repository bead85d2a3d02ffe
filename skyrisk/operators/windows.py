"""Latest-row selection and calendar-day rolling windows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

Rolling = Callable[[WindowSpec], Column]


def dedupe_latest(df: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """Keep one row per key: the first by descending ``order``.

    Spark turns ``row_number() = 1`` into a group limit applied before the shuffle, so
    each task sends at most one row per key, however hot the key is.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def rolling_days(
    df: DataFrame,
    by: list[str],
    on: str,
    days: int,
    columns: Mapping[str, Rolling],
    bucket_days: int = 512,
) -> DataFrame:
    """Add aggregates over the ``days`` calendar days ending at each row.

    The frame is a range of days: a missing day shortens the window, it does not reach
    further back. Rows without a day are kept; their frame is the other such rows. To keep long histories of one place out of a single task, time is cut
    into buckets; the last ``days - 1`` days of a bucket are also sent to the next one,
    where they feed the frames and are then dropped. A window group holds at most
    ``bucket_days + days - 1`` days of one place.
    """
    if bucket_days < days:
        raise ValueError("A bucket must be at least as long as the window.")
    day = F.unix_date(F.col(on))
    home = F.floor(day / F.lit(bucket_days))
    reach = F.floor((day + F.lit(days - 1)) / F.lit(bucket_days))
    copies = df.select(
        "*",
        day.alias("_day"),
        home.alias("_home"),
        F.explode(F.when(home.isNull() | (home == reach), F.array(home)).otherwise(F.array(home, reach))).alias("_bucket"),
    )
    frame = Window.partitionBy(*by, "_bucket").orderBy("_day").rangeBetween(-(days - 1), 0)
    return (
        copies.select("*", *[make(frame).alias(name) for name, make in columns.items()])
        .where(F.col("_bucket").eqNullSafe(F.col("_home")))
        .drop("_day", "_home", "_bucket")
    )


def gated(counted: str, value: Column, n: int) -> Rolling:
    """``value`` over the frame when the frame has ``n`` non-null ``counted``, else null."""
    return lambda frame: F.when(F.count(counted).over(frame) == n, value.over(frame))


def over(value: Column) -> Rolling:
    return lambda frame: value.over(frame)
