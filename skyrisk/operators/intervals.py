"""Pairs of overlapping intervals, as an equality join on buckets of fitting width.

An interval's level is the power of two that is not below its length: in buckets of that width
it lies in at most two. A pair meets at the level of its longer interval, in the bucket where
the later of the two begins, which both lie in, so that it is reported once. The shorter one
is therefore also sent to the levels that intervals of the other side have: at most two rows a
level, whatever the lengths. Buckets with more left rows than `most` are dealt over several
parts, with the right rows copied to each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk.sources.shared import stored

Span = tuple[Column, Column]


def _levelled(df: DataFrame, span: Span, names: tuple[str, str, str]) -> DataFrame:
    """The rows with whole-number ends and their level; rows without a valid interval go."""
    start, end, level = names
    rows = df.select("*", span[0].cast("long").alias(start), span[1].cast("long").alias(end)).where(F.col(start) <= F.col(end))
    length = F.col(end) - F.col(start) + 1
    # The number of binary digits of length - 1 is exact, unlike a logarithm.
    return rows.withColumn(level, F.when(length == 1, 0).otherwise(F.length(F.bin(length - 1))).cast("int"))


def _sent(df: DataFrame, names: tuple[str, str, str], others: list[int]) -> DataFrame:
    """A row for each bucket at the interval's own level and at longer levels of the other side."""
    start, end, level = names
    longer = F.filter(F.array(*[F.lit(x) for x in others]), lambda x: x > F.col(level)) if others else F.array().cast("array<int>")
    rows = df.select("*", F.explode(F.concat(F.array(F.col(level)), longer)).alias("_at"))
    shifted = [F.expr(f"shiftright({c}, _at)") for c in (start, end)]
    return rows.select("*", F.explode(F.array_distinct(F.array(*shifted))).alias("_bucket"))


def overlap_join(
    left: DataFrame, right: DataFrame, by: list[str], left_span: Span, right_span: Span, most: int = 100_000
) -> DataFrame:
    """Every pair of a left and a right row that agree in `by` and whose spans (first and last
    whole number, both included) have a number in common. Columns of both, `by` once; `overlap`
    is how many numbers they have in common. Null and reversed spans overlap nothing."""
    ours, theirs = ("_a", "_b", "_level"), ("_c", "_d", "_level_2")
    one, two = _levelled(left, left_span, ours), _levelled(right, right_span, theirs)
    levels = [sorted(r[0] for r in df.select(name[2]).distinct().collect()) for df, name in ((one, ours), (two, theirs))]
    one, two = _sent(one, ours, levels[1]), _sent(two, theirs, levels[0])
    on = [*by, "_at", "_bucket"]
    hot = stored(one.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > most).withColumn("_parts", F.ceil(F.col("_n") / most).cast("int")).drop("_n"), "hot_buckets")
    if hot.isEmpty():
        one, two = one.withColumn("_part", F.lit(0)), two.withColumn("_part", F.lit(0))
    else:
        parts = F.coalesce("_parts", F.lit(1))
        one = one.join(hot, on, "left").withColumn("_part", F.pmod(F.xxhash64(*left.columns), parts).cast("int")).drop("_parts")
        two = two.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    first, last = F.greatest("_a", "_c"), F.least("_b", "_d")
    meets = (F.greatest("_level", "_level_2") == F.col("_at")) & (first <= last) & (F.expr("shiftright(greatest(_a, _c), _at)") == F.col("_bucket"))
    pairs = one.join(two, [*on, "_part"]).where(meets)
    return pairs.select(*left.columns, *[c for c in right.columns if c not in by], (last - first + 1).alias("overlap"))
