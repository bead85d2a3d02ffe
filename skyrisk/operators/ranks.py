"""Exact positions in one order over a whole frame, without a task that sees it all.

Rows are range-partitioned by the order and stored with their partition; inside a partition
they are numbered by a window; the counts of the partitions, a row each, give what to add.
Equal values may be many, so a hash of the row is part of the ranges and splits them: a value
that goes on from one partition to the next keeps the rank it had. Frames of neighbouring rows
are windows over blocks of consecutive positions, whose last rows are also sent to the next
block.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from skyrisk.sources.shared import stored


def with_positions(df: DataFrame, order: Mapping[str, bool]) -> DataFrame:
    """Add `row_number`, `rank`, `dense_rank`, `percent_rank` and `total` over the whole frame.

    `order` maps columns to whether they ascend; nulls come first when ascending, last when
    descending. Rows with equal order are numbered by a hash of all their columns, so that
    numbers do not depend on how the frame was partitioned.
    """
    sort = [F.col(c).asc() if up else F.col(c).desc() for c, up in order.items()]
    doubles = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    value = F.to_json(F.struct(*[(F.col(c) + 0.0 if c in doubles else F.col(c)).alias(c) for c in order]), {"ignoreNullFields": "false"})
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    ranged = tied.repartitionByRange(*sort, "_tie").withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part").orderBy(*sort)
    rows = stored(ranged, "ranged")
    local = rows.select(
        "*", value.alias("_value"), F.row_number().over(inside.orderBy(*sort, "_tie")).cast("long").alias("_number"),
        F.rank().over(inside).cast("long").alias("_rank"), F.dense_rank().over(inside).cast("long").alias("_dense"),
    )
    # One row a partition reaches the driver.
    sizes = local.groupBy("_part").agg(
        F.max("_number").alias("n"), F.max("_rank").alias("rank"), F.max("_dense").alias("dense"),
        F.min_by("_value", "_number").alias("first"), F.max_by("_value", "_number").alias("last"),
    )
    parts = sorted(sizes.collect(), key=lambda r: r["_part"])
    starts, before, dense, last, last_rank = [], 0, 0, None, 0
    for p in parts:
        goes_on = p["first"] == last
        starts.append((p["_part"], before, last_rank if goes_on else before + 1, dense - goes_on))
        if p["dense"] > 1 or not goes_on:
            last_rank = before + p["rank"]
        dense += p["dense"] - goes_on
        before, last = before + p["n"], p["last"]
    known = F.broadcast(df.sparkSession.createDataFrame(starts, "_part int, _before long, _first_rank long, _dense_before long"))
    rank = F.when(F.col("_rank") == 1, F.col("_first_rank")).otherwise(F.col("_before") + F.col("_rank"))
    total = F.lit(before).cast("long")
    return local.join(known, "_part").select(
        *df.columns,
        (F.col("_before") + F.col("_number")).alias("row_number"),
        rank.alias("rank"),
        (F.col("_dense_before") + F.col("_dense")).alias("dense_rank"),
        ((rank - 1) / F.greatest(total - 1, F.lit(1))).alias("percent_rank"),
        total.alias("total"),
    )


def ntile(n: int, number: str = "row_number", total: str = "total") -> Column:
    """The tile of a position when all rows are dealt, in order, to `n` tiles of sizes that differ
    by one at most, larger ones first."""
    size, more = F.floor(F.col(total) / n), F.col(total) % n
    at = F.col(number) - 1
    large = more * (size + 1)
    rest = more + F.floor((at - large) / F.greatest(size, F.lit(1)))
    return (F.when(at < large, F.floor(at / (size + 1))).otherwise(rest) + 1).cast("int")


def over_rows(
    positioned: DataFrame, preceding: int, columns: Mapping[str, Callable[[WindowSpec], Column]], number: str = "row_number", block: int = 65_536
) -> DataFrame:
    """Add aggregates over each row and the `preceding` rows before it in the whole order. A
    window group holds at most `block + preceding` rows."""
    if block < preceding:
        raise ValueError("A block must be at least as long as the frame")
    at = F.col(number) - 1
    home, reach = F.floor(at / block), F.floor((at + preceding) / block)
    copies = positioned.select("*", home.alias("_home"), F.explode(F.array_distinct(F.array(home, reach))).alias("_block"))
    frame = Window.partitionBy("_block").orderBy(number).rowsBetween(-preceding, 0)
    made = copies.select("*", *[make(frame).alias(name) for name, make in columns.items()])
    return made.where(F.col("_block") == F.col("_home")).drop("_home", "_block")
