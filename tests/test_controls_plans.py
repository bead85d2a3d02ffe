"""Distinct counts apart: same figures, no multiplied rows."""

from datetime import datetime

from helpers import rows
from pyspark.sql import functions as F

from skyrisk.operators.aggregates import count_apart
from skyrisk.plans import controls


def test_counts_apart_equal_counts_together(spark):
    data = [("a", 1, "x"), ("a", 1, "y"), ("a", None, "y"), (None, 2, "x"), (None, 3, None), ("b", None, None)]
    df = spark.createDataFrame(data, "g string, k int, v string")
    plain, distinct = [F.count("*").alias("n")], {"ks": F.col("k"), "vs": F.col("v")}
    together = df.groupBy("g").agg(*plain, F.count_distinct("k").alias("ks"), F.count_distinct("v").alias("vs"))
    assert rows(count_apart(df, ["g"], plain, distinct), "g", "n", "ks", "vs") == rows(together, "g", "n", "ks", "vs")
    assert rows(count_apart(df.limit(0), [], plain, distinct), "n", "ks", "vs") == [(0, 0, 0)]


def test_controls_do_not_expand_rows(spark):
    raw = spark.createDataFrame([(datetime(2026, 1, 1), "a", "h")], "time timestamp, code_insee string, row_hash string")
    for plan in (controls.state_weather(raw), controls.incomplete_days(raw, 2)):
        assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()
