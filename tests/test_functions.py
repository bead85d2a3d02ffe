"""Column expressions against plain Python."""

from datetime import date, datetime, timedelta

import pytest
from helpers import rows, sha
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.functions import dates, keys, scalars
from skyrisk.operators import aggregates
from skyrisk.operators.aggregates import medians
from skyrisk.operators.reshape import calendar


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "given,wanted",
    [("1", "01"), (" 59 ", "59"), ("2A", "2A"), ("2b", "2B"), ("99", None), ("20", None), ("123", None), ("", None), ("x", None)],
)
def test_area_codes(spark, given, wanted):
    assert value(spark, keys.normalize_area(F.lit(given))) == wanted


def test_there_are_96_areas():
    assert schemas.AREA_COUNT == 96 and len(schemas.WEATHER_VARIABLES) == 29 and len(schemas.RAW_WEATHER) == 33


def test_keys_hash_the_iso_text(spark):
    whole, part = datetime(2025, 7, 1, 6), datetime(2025, 7, 1, 6, 0, 0, 500)
    assert value(spark, keys.bulletin_key(F.lit(whole), F.lit("01"))) == sha("2025-07-01T06:00:00+00:00|01")
    assert value(spark, keys.bulletin_key(F.lit(part), F.lit("01"))) == sha("2025-07-01T06:00:00.000500+00:00|01")
    assert value(spark, keys.weather_key(F.lit(date(2026, 9, 1)), F.lit("01034"))) == sha("2026-09-01|01034")


def test_ids_are_null_when_a_part_is(spark):
    assert value(spark, keys.make_id(F.lit("a"), F.lit(None).cast("string"))) is None
    assert value(spark, keys.make_id(F.lit(date(2024, 1, 2)), F.lit("59"))) == "2024-01-02|59"


def test_week_numbers_follow_sunday_weeks(spark):
    start = date(2019, 12, 25)
    days = spark.range(3000).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    got = {r["d"]: (r["w"], r["n"], r["e"], r["s"]) for r in days.select(
        "d", dates.sunday_week("d").alias("w"), dates.weekday_name("d").alias("n"), dates.is_weekend("d").alias("e"),
        dates.season("d").alias("s"),
    ).collect()}
    for i in range(3000):
        d = start + timedelta(i)
        week, name, weekend, season = got[d]
        assert week == int(d.strftime("%U"))
        assert name == schemas.WEEKDAY_NAMES[(d.weekday() + 1) % 7] and weekend == (d.weekday() >= 5)
        assert d.month in schemas.SEASONS[season]


def test_calendar_is_empty_when_bounds_cross_or_are_null(spark):
    def days(low, high):
        bounds = spark.createDataFrame([(low, high)], "low date, high date")
        return calendar(bounds, "low", "high").count()

    assert days(date(2024, 1, 1), date(2024, 1, 3)) == 3
    assert days(date(2024, 1, 1), date(2024, 1, 1)) == 1
    assert days(date(2024, 1, 3), date(2024, 1, 1)) == 0
    assert days(None, date(2024, 1, 1)) == 0


def test_local_day_changes_before_utc(spark):
    late = F.lit(datetime(2026, 8, 7, 22, 30)).cast("timestamp")
    assert value(spark, dates.local_day(late)) == date(2026, 8, 8)
    assert value(spark, dates.local_day(late, lag_days=6)) == date(2026, 8, 2)


@pytest.mark.parametrize("text,wanted", [("2.5", 3), ("-2.5", -3), ("2.4", 2), ("x", None), ("", None), ("nan", None)])
def test_safe_long_rounds_away_from_zero(spark, text, wanted):
    assert value(spark, scalars.safe_long(F.lit(text))) == wanted


def test_extremes_are_null_with_a_null(spark):
    none = F.lit(None).cast("int")
    assert value(spark, scalars.least_strict(F.lit(1), none)) is None
    assert value(spark, scalars.greatest_strict(F.lit(1), F.lit(3))) == 3


def test_rounding(spark):
    assert value(spark, scalars.round_even2(F.lit(0.125))) == 0.12
    assert value(spark, scalars.pct(F.lit(1), F.lit(0))) is None
    assert value(spark, scalars.pct(F.lit(1), F.lit(3))) == 33.33


@pytest.mark.parametrize("level,label", [(1, "Niveau 1 - Faible"), (4, "Niveau 4 - Très élevé"), (9, "Niveau 9 - Inconnu")])
def test_level_labels(spark, level, label):
    assert value(spark, scalars.level_label(F.lit(level))) == label


def test_medians_are_exact(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    data = [(float(v), float(w), None if i % 3 else 1.0, None) for i, (v, w) in enumerate(zip(rng.normal(size=4001), rng.integers(0, 4, 4001)))]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    found = medians(df, ["a", "b", "c", "d"])
    assert found == {"a": float(np.median([r[0] for r in data])), "b": float(np.median([r[1] for r in data])), "c": 1.0}
    assert medians(spark.createDataFrame([(1.0,), (2.0,)], "a double"), ["a"]) == {"a": 1.5}
    assert rows(df.limit(0)) == []


def test_a_wide_middle_is_narrowed(spark, monkeypatch):
    import statistics

    monkeypatch.setattr(aggregates, "MIDDLE_ROWS", 1000)
    data = [(float((i * 7919) % 4001), float(i % 3)) for i in range(4000)]
    df = spark.createDataFrame(data, "a double, b double")
    found = medians(df, ["a", "b"], spread=0.2)
    assert found == {"a": statistics.median(r[0] for r in data), "b": 1.0}


def test_only_decimal_literals_are_numbers(spark):
    good = ["1", " 2.5 ", "-.5", "+3.", "1e3", "1E-2", "nan", "-Infinity"]
    bad = ["2d", "2f", "0x1p1", "1_0", "", "e5", ".", "1,5", "--1", "1e"]
    df = spark.createDataFrame([(t,) for t in [*good, *bad, None]], "t string")
    kept = {r["t"] for r in df.where(scalars.safe_double("t").isNotNull()).collect()}
    assert kept == set(good)
    typed = spark.createDataFrame([(2.0,), (None,), (float("nan"),)], "v double")
    assert typed.where(scalars.safe_double("v").isNull()).count() == 1
    for text in bad:
        with pytest.raises(Exception, match="Not a number"):
            spark.createDataFrame([(text,)], "t string").select(scalars.strict_double("t")).collect()
