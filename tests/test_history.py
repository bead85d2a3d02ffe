"""Keyed upsert and the versioned history."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from helpers import AT, bulletin, raw_weather, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.operators.quality import ContractError
from skyrisk.operators.upsert import assert_batch_keys, assert_no_dup, merge_upsert
from skyrisk.plans.ingest import prepare_bulletins
from skyrisk.sources import history
from skyrisk.sources.history import ConcurrentLoadError, live_days, read_history, upsert_history
from skyrisk.sources.shared import create_if_absent, read_text
from skyrisk.streaming.refresh import refresh_bulletins

D1, D2, D3 = date(2026, 8, 1), date(2026, 8, 2), date(2026, 8, 3)


def put(batch, root, **options):
    return upsert_history(batch, root, schemas.RAW_WEATHER, "row_hash", "time", "code_insee", **options)


def get(spark, root, **options):
    return rows(read_history(spark, root, schemas.RAW_WEATHER, **options), "time", "code_insee", "rain_sum")


@given(
    target=st.dictionaries(st.integers(0, 8), st.integers(0, 9), max_size=6),
    batch=st.dictionaries(st.integers(0, 8), st.integers(10, 19), min_size=1, max_size=6),
)
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_merging_twice_changes_nothing(spark, target, batch):
    t = spark.createDataFrame(list(target.items()), "k int, v int")
    b = spark.createDataFrame([(v, k) for k, v in batch.items()], "v int, k int")
    once = merge_upsert(t, b, "k")
    assert rows(once) == sorted((target | batch).items(), key=repr)
    assert rows(merge_upsert(once, b, "k")) == rows(once)


def test_bad_batches_are_refused(spark):
    schema = "k string, v int"
    for data in ([], [("a", 1), ("a", 2)], [("a", 1), (None, 2)]):
        with pytest.raises(ContractError):
            assert_batch_keys(spark.createDataFrame(data, schema), "k")
    target = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1)], schema)
    assert_no_dup(target, spark.createDataFrame([("c", 1)], schema), "k")
    with pytest.raises(ContractError, match="repeated"):
        assert_no_dup(target, spark.createDataFrame([("a", 1)], schema), "k")


def test_history_updates_inserts_and_prunes(spark, tmp_path):
    root = str(tmp_path / "h")
    assert read_history(spark, root, schemas.RAW_WEATHER).count() == 0
    assert put(raw_weather(spark, [(D1, "a", {}), (D1, "b", {}), (D2, "a", {})]), root) == 1
    assert put(raw_weather(spark, [(D1, "b", {"rain_sum": 5.0}), (D3, "a", {})]), root) == 2
    t1, t2, t3 = (datetime(2026, 8, d) for d in (1, 2, 3))
    everything = [(t1, "a", 1.0), (t1, "b", 5.0), (t2, "a", 1.0), (t3, "a", 1.0)]
    assert get(spark, root) == everything
    assert get(spark, root, start=D2) == everything[2:]
    assert get(spark, root, end=D1) == everything[:2]
    # Only the touched days were written again.
    version, loads = live_days(spark, root)
    assert version == 2 and loads[D1] == loads[D3] != loads[D2]
    stored = read_history(spark, root, schemas.RAW_WEATHER)
    assert stored.schema == schemas.RAW_WEATHER
    assert {r["row_hash"] for r in stored.collect()} == {r["row_hash"] for r in raw_weather(
        spark, [(D1, "a", {}), (D1, "b", {}), (D2, "a", {}), (D3, "a", {})]).collect()}


def test_same_batch_twice_gives_the_same_history(spark, tmp_path):
    root = str(tmp_path / "h")
    batch = raw_weather(spark, [(D1, "a", {}), (D2, "b", {})])
    put(batch, root)
    before = get(spark, root)
    put(batch, root)
    assert get(spark, root) == before


def test_a_refused_or_interrupted_load_leaves_the_history_as_it_was(spark, tmp_path):
    root = str(tmp_path / "h")
    put(raw_weather(spark, [(D1, "a", {})]), root)
    before = get(spark, root)
    with pytest.raises(ContractError):
        put(raw_weather(spark, [(D1, "b", {}), (D1, "b", {})]), root)
    # Data of a load whose manifest never came.
    raw_weather(spark, [(D1, "z", {})]).withColumn("day", F.lit(D1)).write.partitionBy("day").parquet(f"{root}/data/load=2")
    assert get(spark, root) == before
    assert put(raw_weather(spark, [(D2, "c", {})]), root) == 2
    assert len(get(spark, root)) == 2


def test_a_key_may_move_to_another_day(spark, tmp_path):
    root = str(tmp_path / "h")
    put(raw_weather(spark, [(D1, "a", {}), (D2, "b", {})]), root)
    moved = raw_weather(spark, [(D1, "a", {})]).withColumn("time", F.lit(datetime(2026, 8, 3)))
    put(moved, root, key_fixes_day=False)
    assert get(spark, root) == [(datetime(2026, 8, 2), "b", 1.0), (datetime(2026, 8, 3), "a", 1.0)]
    assert set(live_days(spark, root)[1]) == {D2, D3}


def test_refresh_takes_each_file_once_and_stops_on_a_bad_one(spark, tmp_path):
    landing, root, progress = tmp_path / "landing", str(tmp_path / "h"), str(tmp_path / "progress")
    landing.mkdir()

    def drop(name, records):
        fields = ["reference_time", "dep_code", "dep_nom", "niveau_j1", "niveau_j2"]
        (landing / name).write_text(json.dumps([dict(zip(fields, r)) for r in records]), encoding="utf-8")

    def run():
        refresh_bulletins(spark, str(landing), root, progress, lambda raw: prepare_bulletins(raw, AT))

    def stored():
        return read_history(spark, root, schemas.RAW_BULLETINS).count()

    drop("one.json", bulletin("2025-07-01T06:00:00Z"))
    run()
    assert stored() == 96
    run()
    assert stored() == 96
    drop("two.json", bulletin("2025-07-02T06:00:00Z"))
    run()
    assert stored() == 192
    drop("bad.json", bulletin("2025-07-03T06:00:00Z", j1="9"))
    with pytest.raises(Exception, match="whole_between"):
        run()
    assert stored() == 192


def test_days_have_their_own_folder(spark, tmp_path):
    root = str(tmp_path / "h")
    put(raw_weather(spark, [(D1 + timedelta(i), "a", {}) for i in range(3)]), root)
    names = sorted(p.name for p in (tmp_path / "h" / "data").glob("load=*/day=*"))
    assert names == ["day=2026-08-01", "day=2026-08-02", "day=2026-08-03"]


def test_a_refused_load_leaves_what_is_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "h")
    put(raw_weather(spark, [(D1, "a", {})]), root)
    seen = live_days(spark, root)
    put(raw_weather(spark, [(D1, "a", {"rain_sum": 2.0})]), root)
    published = get(spark, root)
    # Another load that read the history before that one was published.
    states = iter([seen])
    monkeypatch.setattr(history, "live_days", lambda *a: next(states, live_days(*a)))
    with pytest.raises(ConcurrentLoadError):
        put(raw_weather(spark, [(D1, "a", {"rain_sum": 9.0}), (D2, "b", {})]), root)
    monkeypatch.undo()
    assert get(spark, root) == published and live_days(spark, root)[0] == 2
    assert put(raw_weather(spark, [(D2, "b", {})]), root) == 3
    assert len(get(spark, root)) == 2


def test_of_many_that_create_a_file_one_succeeds(spark, tmp_path):
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda i: create_if_absent(spark, f"{tmp_path}/log/1.json", str(i)), range(48)))
    assert won.count(True) == 1
    assert read_text(spark, f"{tmp_path}/log/1.json") == str(won.index(True))
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["1.json"]


def between_write_and_commit(monkeypatch, other):
    """Run another load when the next one has written its rows but not published them."""
    waiting, write = [other], history.write_load

    def write_then(*args):
        out = write(*args)
        if waiting:
            waiting.pop()()
        return out

    monkeypatch.setattr(history, "write_load", write_then)


def test_interleaved_loads_of_other_days_both_land(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "h")
    put(raw_weather(spark, [(D1, "a", {}), (D2, "a", {})]), root)
    between_write_and_commit(monkeypatch, lambda: put(raw_weather(spark, [(D2, "b", {}), (D3, "b", {})]), root))
    assert put(raw_weather(spark, [(D1, "c", {})]), root) == 3
    codes = [(d.day, c) for d, c in rows(read_history(spark, root, schemas.RAW_WEATHER), "time", "code_insee")]
    assert codes == [(1, "a"), (1, "c"), (2, "a"), (2, "b"), (3, "b")]


def test_interleaved_loads_of_a_day_refuse_the_later(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "h")
    put(raw_weather(spark, [(D1, "a", {})]), root)
    other = lambda: put(raw_weather(spark, [(D2, "b", {}), (D1, "a", {"rain_sum": 7.0})]), root)
    between_write_and_commit(monkeypatch, other)
    with pytest.raises(ConcurrentLoadError):
        put(raw_weather(spark, [(D1, "c", {})]), root)
    first = [(datetime(2026, 8, 1), "a", 7.0), (datetime(2026, 8, 2), "b", 1.0)]
    assert get(spark, root) == first and live_days(spark, root)[0] == 2
    # The same, with leave to merge again.
    between_write_and_commit(monkeypatch, lambda: put(raw_weather(spark, [(D1, "d", {})]), root))
    assert put(raw_weather(spark, [(D1, "c", {})]), root, retries=1) == 4
    assert get(spark, root) == sorted([*first, (datetime(2026, 8, 1), "c", 1.0), (datetime(2026, 8, 1), "d", 1.0)], key=repr)


def test_a_search_of_the_whole_history_excludes_any_other_load(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "h")
    put(raw_weather(spark, [(D1, "a", {})]), root)
    between_write_and_commit(monkeypatch, lambda: put(raw_weather(spark, [(D3, "z", {})]), root))
    with pytest.raises(ConcurrentLoadError):
        put(raw_weather(spark, [(D2, "b", {})]), root, key_fixes_day=False)


def test_loads_at_the_same_time_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "h")
    days = [D1 + timedelta(i) for i in range(6)]
    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(lambda d: put(raw_weather(spark, [(d, "a", {}), (d, "b", {})]), root), days))
    assert sorted(versions) == list(range(1, 7))
    assert len(get(spark, root)) == 12


def test_snapshots_shorten_the_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "SNAPSHOT_EVERY", 2)
    root = str(tmp_path / "h")
    for i in range(5):
        put(raw_weather(spark, [(D1 + timedelta(i % 3), "a", {"rain_sum": float(i)})]), root)
    assert sorted(p.name for p in (tmp_path / "h" / "snapshot").iterdir()) == ["version=2", "version=4"]
    version, days = live_days(spark, root)
    assert version == 5 and len(days) == 3
    for p in (tmp_path / "h" / "log").glob("*1.json"):  # no longer followed
        p.unlink()
    assert live_days(spark, root) == (version, days)
    (tmp_path / "h" / "snapshot" / "version=4" / "_SUCCESS").unlink()  # one that was never finished
    assert live_days(spark, root) == (version, days)
    assert [r[2] for r in get(spark, root)] == [3.0, 4.0, 2.0]


def test_days_are_replaced_whole(spark, tmp_path):
    root = str(tmp_path / "h")
    put(raw_weather(spark, [(D1, "a", {}), (D2, "a", {}), (D3, "a", {})]), root)
    history.replace_days(raw_weather(spark, [(D1, "b", {})]), root, "time", "code_insee", [D1, D2])
    assert [(t.day, c) for t, c, _ in get(spark, root)] == [(1, "b"), (3, "a")]
    with pytest.raises(ValueError, match="outside"):
        history.replace_days(raw_weather(spark, [(D3, "b", {})]), root, "time", "code_insee", [D1])
