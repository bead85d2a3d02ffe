"""Whole loads, from landing files to the history."""

import json
from datetime import date

import pytest
from helpers import AT, bulletin, daily, manifest, payloads, points, rows, utc

from skyrisk import schemas
from skyrisk.operators.quality import ContractError
from skyrisk.plans import refresh
from skyrisk.sources.history import read_history


def test_last_day_follows_the_local_calendar():
    assert refresh.last_available_day(utc(2026, 8, 10, 21, 0)) == date(2026, 8, 4)
    assert refresh.last_available_day(utc(2026, 8, 10, 22, 30)) == date(2026, 8, 5)


def test_weather_days_are_filled_one_by_one(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "h")
    codes = ["01034", "59350"]
    now = utc(2026, 8, 8, 12)

    def load(day, **changes):
        body = payloads(spark, [daily(day.isoformat(), **changes) for _ in codes])
        return refresh.load_weather_day(
            body, body.limit(0), manifest(spark, codes, day), points(spark, codes), day, landing, root, AT
        )

    assert refresh.next_weather_day(spark, root, now, 2) == date(2026, 8, 1)
    assert load(date(2026, 8, 1)) == 1
    assert refresh.next_weather_day(spark, root, now, 2) == date(2026, 8, 2)
    with pytest.raises(ContractError, match="finite"):
        load(date(2026, 8, 2), rain_sum=[1e999])
    assert refresh.next_weather_day(spark, root, now, 2) == date(2026, 8, 2)
    assert not (tmp_path / "landing" / "meteo_2026-08-02").exists()
    assert load(date(2026, 8, 2)) == 2
    assert refresh.next_weather_day(spark, root, now, 2) is None
    assert read_history(spark, root, schemas.RAW_WEATHER).count() == 4


def test_a_bulletin_loaded_twice_is_stored_once(spark, tmp_path):
    fields = ["reference_time", "dep_code", "dep_nom", "niveau_j1", "niveau_j2"]
    (tmp_path / "b.json").write_text(json.dumps([dict(zip(fields, r)) for r in bulletin()]), encoding="utf-8")
    source, landing, root = str(tmp_path / "b.json"), str(tmp_path / "l"), str(tmp_path / "h")
    assert refresh.load_bulletin(spark, source, landing, root, AT) == 1
    assert refresh.load_bulletin(spark, source, landing, root) == 2
    history = read_history(spark, root, schemas.RAW_BULLETINS)
    assert history.count() == 96 and history.where("insere_a <= timestamp'2026-09-08 05:00:00'").count() == 0
    assert (tmp_path / "l" / "meteo_forets_20250701T060000Z").exists()
    csv = "reference_time;dep_code;nom_dep;niveau_j1;niveau_j2\n" + "\n".join(";".join(r) for r in bulletin())
    (tmp_path / "2025.csv").write_text(csv, encoding="utf-8")
    assert refresh.load_archives(spark, {2025: str(tmp_path / "2025.csv")}, landing, root, AT) == 3
    assert read_history(spark, root, schemas.RAW_BULLETINS).count() == 96


def test_point_seed_is_checked(spark):
    assert len(rows(refresh.check_points(points(spark, ["a", "b"]), 2))) == 2
    with pytest.raises(ContractError):
        refresh.check_points(points(spark, ["a", "a"]), 2)
