"""Interval joins, global positions and mergeable sketches against plain computation."""

import random

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyrisk.operators import intervals, ranks, sketches



def span():
    return (F.col("s"), F.col("e")), (F.col("s2"), F.col("e2"))


def overlaps(left, right):
    return sorted(
        ((k, a, b, i, c, d, j, min(b, d) - max(a, c) + 1) for k, a, b, i in left for k2, c, d, j in right
         if k is not None and k == k2 and None not in (a, b, c, d) and a <= b and c <= d and max(a, c) <= min(b, d)), key=repr,
    )


def frames(spark, left, right):
    return spark.createDataFrame(left, "k string, s long, e long, i int"), spark.createDataFrame(right, "k string, s2 long, e2 long, j int")


@pytest.mark.parametrize("most", [100_000, 3])
def test_every_overlap_is_reported_once(spark, most):
    r = random.Random(most)

    def some(n):
        out = [(r.choice(["a", "b", None]), s := r.randint(-300, 300), s + r.choice([0, 0, 1, 2, 7, 40, 500]), i) for i in range(n)]
        return out + [("a", 5, 4, n), ("a", None, 9, n + 1), ("b", 7, None, n + 2), ("a", -(2**40), 2**40, n + 3), ("b", 3, 3, n + 4), ("b", 3, 3, n + 4)]

    left, right = some(60), some(70)
    got = intervals.overlap_join(*frames(spark, left, right), ["k"], *span(), most=most)
    assert rows(got, "k", "s", "e", "i", "s2", "e2", "j", "overlap") == overlaps(left, right)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overlaps_of_nothing(spark):
    left, right = frames(spark, [("a", 1, 2, 1)], [("a", 1, 2, 1)])
    assert intervals.overlap_join(left.limit(0), right, ["k"], *span()).count() == 0
    assert intervals.overlap_join(left, right.limit(0), ["k"], *span()).count() == 0


def positions(values, tie):
    """(row_number, rank, dense_rank) of every value in descending order, nulls last."""
    order = sorted(values, key=lambda v: (v is None, -(v or 0)))
    distinct = sorted(set(order), key=lambda v: (v is None, -(v or 0)))
    return sorted(((v, order.index(v) + 1, distinct.index(v) + 1) for v in order), key=repr)


@given(values=st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=60))
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_positions_with_many_ties(spark, values):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int")
        out = ranks.with_positions(df, {"v": False})
        got = out.collect()
        assert sorted(((r["v"], r["rank"], r["dense_rank"]) for r in got), key=repr) == positions(values, None)
        assert sorted(r["row_number"] for r in got) == list(range(1, len(values) + 1))
        n = max(len(values) - 1, 1)
        assert all(r["percent_rank"] == pytest.approx((r["rank"] - 1) / n) and r["total"] == len(values) for r in got)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


@pytest.mark.parametrize("total", [0, 1, 3, 10, 23])
def test_tiles_and_frames(spark, total):
    df = spark.range(total).select((F.col("id") * 7).alias("v"), F.lit(total).cast("long").alias("total"), (F.col("id") + 1).alias("row_number"))
    got = df.withColumn("tile", ranks.ntile(4)).orderBy("v").collect()
    sizes = [total // 4 + (i < total % 4) for i in range(4)]
    assert [r["tile"] for r in got] == [i + 1 for i in range(4) for _ in range(sizes[i])]
    sums = ranks.over_rows(df, 3, {"s": lambda w: F.sum("v").over(w), "n": lambda w: F.count("*").over(w)}, block=4)
    want = [(7 * i, 7 * sum(range(max(0, i - 3), i + 1)), min(i, 3) + 1) for i in range(total)]
    assert sorted(tuple(r) for r in sums.select("v", "s", "n").collect()) == want


def test_merged_sketches_stay_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 7).alias("area"), F.expr("id % 9000").alias("point"), F.expr("(id * 7919) % 10007").cast("double").alias("v"))
    fine = sketches.sketch(df, ["day", "area"], {"points": "point"}, {"values": "v"})
    coarse = sketches.merged(fine, ["area"], ["points"], ["values"])
    got = sketches.estimates(coarse, ["points"], {"values": [0.1, 0.5, 0.9]})
    exact = {r["area"]: r for r in df.groupBy("area").agg(F.count_distinct("point").alias("n"), F.collect_list("v").alias("v")).collect()}
    for r in got.collect():
        e = exact[r["area"]]
        assert abs(r["points"] - e["n"]) <= 0.05 * e["n"] and r["rows"] == len(e["v"])
        for q, x in zip((0.1, 0.5, 0.9), r["values"], strict=True):
            assert abs(sum(v <= x for v in e["v"]) / len(e["v"]) - q) <= 0.03
    plan = coarse._jdf.queryExecution().optimizedPlan().toString()
    assert "collect" not in plan
