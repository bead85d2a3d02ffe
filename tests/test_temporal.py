"""As-of join, rolling windows and latest-row selection against brute force."""

from datetime import date, timedelta

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyrisk.operators.joins import asof_join, latest_where_complete, orphans, with_validity
from skyrisk.operators.windows import dedupe_latest, gated, over, rolling_days

DAY0 = date(2024, 1, 1)
few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@given(
    known=st.sets(st.tuples(st.sampled_from("AB"), st.one_of(st.none(), st.integers(0, 40))), max_size=25),
    asked=st.lists(st.tuples(st.sampled_from("ABC"), st.one_of(st.none(), st.integers(-3, 45))), min_size=1, max_size=30),
)
@few
def test_asof_equals_brute_force(spark, known, asked):
    right = spark.createDataFrame(
        [(p, None, 99.0) if d is None else (p, DAY0 + timedelta(d), float(d)) for p, d in known], "p string, seen date, v double"
    )
    left = spark.createDataFrame(
        [(i, p, None if d is None else DAY0 + timedelta(d)) for i, (p, d) in enumerate(asked)], "i int, p string, day date"
    )
    expected = []
    for i, (p, d) in enumerate(asked):
        before = [k for q, k in known if q == p and d is not None and k is not None and k <= d]
        best = max(before, default=None)
        expected.append((i, None if best is None else DAY0 + timedelta(best), None if best is None else float(best)))
    assert rows(asof_join(left, right, ["p"], "day", "seen"), "i", "seen", "v") == sorted(expected, key=repr)


def test_asof_keeps_every_row_of_a_hot_day(spark):
    hot = F.when(F.col("id") >= 0, "A").otherwise("B")
    day = F.date_add(F.lit(DAY0), (F.col("id") * 0).cast("int"))
    left = spark.range(5000).select("id", hot.alias("p"), day.alias("day"))
    right = spark.createDataFrame([("A", DAY0 - timedelta(3), 7.0)], "p string, seen date, v double")
    out = asof_join(left, right, ["p"], "day", "seen")
    assert out.agg(F.count("*"), F.sum("v")).first() == (5000, 35000.0)
    assert "Cartesian" not in plan_of(out) and "NestedLoop" not in plan_of(out)


@given(
    days=st.sets(st.integers(0, 60), min_size=1, max_size=30),
    bucket=st.sampled_from([7, 10, 512]),
)
@few
def test_rolling_counts_calendar_days_across_buckets(spark, days, bucket):
    data = {d: (None if d % 5 == 0 else float(d)) for d in days}
    df = spark.createDataFrame([("A", DAY0 + timedelta(d), v) for d, v in data.items()], "p string, day date, v double")
    out = rolling_days(
        df, ["p"], "day", 7,
        {"n": over(F.count("v")), "top": over(F.max("v")), "all7": gated("v", F.sum("v"), 7)},
        bucket_days=bucket,
    )
    expected = []
    for d in days:
        seen = [data[k] for k in range(d - 6, d + 1) if data.get(k) is not None]
        expected.append((DAY0 + timedelta(d), len(seen), max(seen, default=None), sum(seen) if len(seen) == 7 else None))
    assert rows(out, "day", "n", "top", "all7") == sorted(expected, key=repr)


def test_rolling_refuses_short_buckets(spark):
    df = spark.createDataFrame([("A", DAY0, 1.0)], "p string, day date, v double")
    with pytest.raises(ValueError):
        rolling_days(df, ["p"], "day", 7, {"n": over(F.count("v"))}, bucket_days=3)


def test_dedupe_keeps_the_latest_and_breaks_ties(spark):
    data = [(1, 10, "a"), (1, 10, "c"), (1, 9, "z"), (2, None, "b"), (2, 1, "a"), (None, 1, "x"), (None, 2, "y")]
    df = spark.createDataFrame(data, "k int, at int, h string")
    assert rows(dedupe_latest(df, ["k"], ["at", "h"])) == sorted([(1, 10, "c"), (2, 1, "a"), (None, 2, "y")], key=repr)


def test_dedupe_limits_groups_before_the_shuffle(spark):
    df = spark.range(0, 20000).select(F.when(F.col("id") >= 0, "hot").otherwise("x").alias("k"), F.col("id").alias("at"))
    out = dedupe_latest(df, ["k"], ["at"])
    plan = plan_of(out)
    assert plan.index("1, Final") < plan.index("Exchange") < plan.index("1, Partial")
    assert rows(out) == [("hot", 19999)]


def test_validity_is_open_after_the_last_day(spark):
    df = spark.createDataFrame([("A", DAY0), ("A", DAY0 + timedelta(4)), ("B", DAY0)], "p string, day date")
    assert rows(with_validity(df, ["p"], "day")) == [
        ("A", DAY0, DAY0 + timedelta(4)),
        ("A", DAY0 + timedelta(4), date(9999, 12, 31)),
        ("B", DAY0, date(9999, 12, 31)),
    ]


def test_latest_complete_day_skips_partial_ones(spark):
    data = [(1, "a", True), (1, "b", True), (2, "a", True), (2, "b", False), (3, "a", True), (3, "a", True)]
    df = spark.createDataFrame(data, "day int, m string, ok boolean")
    assert rows(latest_where_complete(df, "day", "m", F.col("ok"), F.lit(2))) == [(1, "a", True), (1, "b", True)]


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    assert rows(orphans(child, parent, "k", "id")) == [("b",)]


def test_rows_without_a_day_stay_in_rolling_windows(spark):
    data = [("A", DAY0, 1.0), ("A", None, 5.0), ("A", None, 7.0), ("B", None, 2.0), ("A", DAY0 + timedelta(3), 2.0)]
    df = spark.createDataFrame(data, "p string, day date, v double")
    out = rolling_days(df, ["p"], "day", 7, {"s": over(F.sum("v"))}, bucket_days=7)
    expected = [("A", None, 12.0), ("A", None, 12.0), ("A", DAY0, 1.0), ("A", DAY0 + timedelta(3), 3.0), ("B", None, 2.0)]
    assert rows(out, "p", "day", "s") == sorted(expected, key=repr)
