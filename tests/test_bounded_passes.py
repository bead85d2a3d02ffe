"""How often builds and contract reports read what they are given."""

import pytest
from helpers import points, raw_weather, rows
from test_marts import bulletins, day, history

from skyrisk.operators import quality
from skyrisk.plans import build, contracts, marts, staging


def counted(spark, df):
    """The frame, and how many of its rows have been read."""
    seen = spark.sparkContext.accumulator(0)

    def run(parts):
        for part in parts:
            seen.add(len(part))
            yield part

    return df.mapInPandas(run, df.schema), seen


@pytest.fixture(scope="module")
def seed(spark):
    return points(spark, ["a1", "a2", "b1"], ["59", "59", "2A"]).persist()


def test_a_written_build_reads_the_raw_weather_once(spark, seed, tmp_path):
    raw = raw_weather(spark, [(day(n), c, {}) for n in range(4) for c in ("a1", "a2", "b1")]).persist()
    watched, seen = counted(spark, raw)
    tables = build.build(watched, bulletins(spark), seed, build.to_warehouse(str(tmp_path)))
    assert tables["ml_train_incendie"].count() > 0 and tables["dim_date"].count() > 0
    assert seen.value == raw.count()


def test_a_contract_report_reads_each_table_twice(spark, seed, tmp_path):
    every = [*build.WRITTEN, "stg_meteo_journaliere", "stg_meteo_forets", "int_meteo_communes", "referentiel_communes"]
    stored = build.build(history(spark), bulletins(spark), seed, build.to_warehouse(str(tmp_path), every))
    both = {name: counted(spark, stored[name]) for name in contracts.NOT_NULL}
    report = contracts.check_tables({name: df for name, (df, _) in both.items()})
    assert rows(report.where("violations > 0")) == []
    for name, (_, seen) in both.items():
        assert seen.value <= 2 * stored[name].count(), name


def test_observations_are_not_shuffled_to_a_list_of_points_of_bounded_size(spark, seed, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weather = staging.stage_weather(raw_weather(spark, [(day(n), c, {}) for n in range(4) for c in ("a1", "b1", "zz")]))
        few = marts.enrich_points(weather, seed)
        assert "Exchange hashpartitioning" not in few._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(marts, "SENT_POINTS", 2)
        many = marts.enrich_points(weather, seed)
        assert "Exchange hashpartitioning" in many._jdf.queryExecution().executedPlan().toString()
        assert rows(few) == rows(many) and few.count() == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_travel_in_sixteen_bytes_however_long(spark):
    long = "k" * 500
    df = spark.createDataFrame([(long + "1",), (long + "1",), (long + "2",), (None,), ("",)], "k string")
    rule = quality.unique("k")
    tagged = quality._tagged(df, [(0, ["k"], True, False)])
    assert {len(r["key"]) for r in tagged.collect()} == {16} and tagged.count() == 4
    assert rows(quality.validate(df, [rule, quality.references("k", df.limit(0), "k")])) == [("references:k", 4), ("unique:k", 1)]
