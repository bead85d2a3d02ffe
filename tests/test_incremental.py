"""Tables kept up by change equal tables built anew, and other folders stay."""

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import AT, points, raw_weather, rows

from skyrisk import schemas
from skyrisk.plans import build, incremental
from skyrisk.sources.history import live_days, read_history, upsert_history

START = date(2026, 7, 1)
CODES = {"a1": "59", "a2": "59", "b1": "2A", "c1": "13"}


def day(n):
    return START + timedelta(n)


def bulletins(spark, days, shift=0):
    items = []
    for n in days:
        for area in sorted(set(CODES.values())):
            at = datetime(2026, 7, 1, 6) + timedelta(n)
            items.append((at, f" {area}", f"D{area} ", 1 + (n + shift) % 4, 4 - n % 4, f"k{n}-{area}", AT + timedelta(hours=shift)))
    return spark.createDataFrame(items, schemas.RAW_BULLETINS)


def weather(spark, r, days):
    items = []
    for n in days:
        for code in CODES:
            if r.random() < 0.7:
                items.append((day(n), code, {"temperature_2m_mean": float(r.randint(-5, 30)), "precipitation_sum": r.choice([0.0, 1.0, None])}))
    return raw_weather(spark, items or [(day(days[0]), "a1", {})])


@pytest.fixture
def warehouse(spark, tmp_path):
    seed = points(spark, list(CODES), list(CODES.values())).persist()
    return incremental.Warehouse(spark, str(tmp_path / "w"), str(tmp_path / "b"), seed, str(tmp_path / "t"))


def put_weather(w, batch):
    upsert_history(batch, w.weather, schemas.RAW_WEATHER, "row_hash", "time", "code_insee")
    return {r["time"].date() for r in batch.select("time").distinct().collect()}


def put_bulletins(w, batch):
    upsert_history(batch, w.bulletins, schemas.RAW_BULLETINS, "row_hash", "reference_time", "dep_code")
    return {r["reference_time"].date() for r in batch.select("reference_time").distinct().collect()}


def whole(w):
    raw = read_history(w.spark, w.weather, schemas.RAW_WEATHER), read_history(w.spark, w.bulletins, schemas.RAW_BULLETINS)
    return build.build(*raw, w.points)


def assert_equal(w):
    want = whole(w)
    for name in incremental.DAYS:
        columns = want[name].columns
        assert rows(w.read(name), *columns) == rows(want[name], *columns), name
    assert rows(w.calendar()) == rows(want["dim_date"])


def test_any_loads_give_what_a_build_gives(spark, warehouse):
    r, w = random.Random(1), warehouse
    put_weather(w, weather(spark, r, [0, 1, 8]))
    put_bulletins(w, bulletins(spark, [0, 1, 2, 8, 9, 12]))
    w.fill()
    touched = put_weather(w, weather(spark, r, [-2, 9]))
    published = put_bulletins(w, bulletins(spark, [1, 10], shift=1))
    w.update(touched, published)
    w.update(put_weather(w, weather(spark, r, [3])), [])
    assert_equal(w)


def test_folders_of_other_days_stay(spark, warehouse):
    r, w = random.Random(5), warehouse
    put_weather(w, weather(spark, r, range(2, 7)))
    put_bulletins(w, bulletins(spark, range(0, 12)))
    w.fill()
    before = {name: live_days(spark, f"{w.root}/{name}")[1] for name in incremental.DAYS}
    changed = w.update(put_weather(w, raw_weather(spark, [(day(4), "a1", {"rain_sum": 3.0})])), [])
    after = {name: live_days(spark, f"{w.root}/{name}")[1] for name in incremental.DAYS}
    for name in incremental.DAYS:
        moved = {d for d in before[name] | after[name] if before[name].get(d) != after[name].get(d)}
        assert moved <= changed[name], name
    assert changed["fact_meteo"] == {day(4)} and changed["ml_train_incendie"] == {day(4 + i) for i in range(7)}
    assert changed["fact_danger_incendie"] == set() and day(4) in changed["pbi_risque_incendie"]
    assert max(changed["pbi_risque_incendie"]) < day(8)
    assert w.update([], []) == {name: set() for name in incremental.DAYS}


def test_a_day_that_loses_its_rows(spark, warehouse):
    w = warehouse
    put_weather(w, raw_weather(spark, [(day(0), "a1", {}), (day(3), "a1", {}), (day(3), "b1", {})]))
    put_bulletins(w, bulletins(spark, range(2, 7)))
    w.fill()
    moved = raw_weather(spark, [(day(3), "a1", {})])
    moved = moved.selectExpr("timestampadd(DAY, 2, time) AS time", *[c for c in moved.columns if c != "time"]).select(*schemas.RAW_WEATHER.names)
    upsert_history(moved, w.weather, schemas.RAW_WEATHER, "row_hash", "time", "code_insee", key_fixes_day=False)
    w.update([day(3), day(5)], [])
    assert_equal(w)
