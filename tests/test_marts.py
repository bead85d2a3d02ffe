"""The published tables on hand-built history, and the controls over them."""

from datetime import date, datetime, timedelta

import pytest
from helpers import AT, points, raw_weather, rows
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.operators import quality as Q
from skyrisk.plans import build, contracts, controls, explore, marts, staging

START = date(2026, 7, 1)


def day(n):
    return START + timedelta(n)


def history(spark, skip=(), holes=()):
    """Two areas, three points, ten days; some (day, point) absent or without temperature."""
    items = []
    for n in range(10):
        for i, code in enumerate(("a1", "a2", "b1")):
            if (n, code) in skip:
                continue
            values = {
                "temperature_2m_mean": None if (n, code) in holes else float(n + i),
                "precipitation_sum": 0.0 if n % 2 else 1.0,
                "weather_code": 2.5,
            }
            items.append((day(n), f" {code} ", values))
    items.append((day(3), "unknown", {}))
    return raw_weather(spark, items)


def bulletins(spark, extra=()):
    """One bulletin a day at six, both areas."""
    items = []
    for n in range(12):
        for area in ("59", "2A"):
            at = datetime(2026, 7, 1, 6) + timedelta(n)
            items.append((at, f" {area}", f"D{area} ", 1 + n % 4, 4 - n % 4, f"k{n}-{area}", AT))
    return spark.createDataFrame(items + list(extra), schemas.RAW_BULLETINS)


def tables(spark, extra=(), **faults):
    seed = points(spark, ["a1", "a2", "b1"], ["59", "59", "2A"])
    return build.build(history(spark, **faults), bulletins(spark, extra), seed)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The same tables without fault, written once."""
    seed = points(spark, ["a1", "a2", "b1"], ["59", "59", "2A"])
    root = tmp_path_factory.mktemp("warehouse")
    return root, build.build(history(spark), bulletins(spark), seed, build.to_warehouse(str(root)))


def test_staging_names_trims_and_rounds(spark):
    row = staging.stage_weather(history(spark)).where("code_insee = 'a1'").first()
    assert (row["code_meteo"], row["temperature_moyenne"], row["date"]) == (3, 0.0, day(0))
    bad = history(spark).withColumn("rain_sum", F.lit("x")).withColumn("snowfall_sum", F.lit(float("nan")))
    first = staging.stage_weather(bad).first()
    assert first["pluie_totale"] is None and first["neige_totale"] is None


def test_unknown_points_are_dropped_and_areas_aggregated(stored):
    _, t = stored
    assert t["fact_meteo"].count() == 30
    row = t["int_meteo_departement_jour"].where((F.col("date") == day(4)) & (F.col("numero_departement") == "59")).first()
    assert (row["nombre_points_meteo"], row["temperature_moyenne"], row["precipitations_totales"]) == (2, 4.5, 2.0)
    assert row["precipitations_moyennes"] == 1.0 and row["mesures_completes"] is True


def test_a_hole_makes_the_area_day_incomplete(spark):
    t = tables(spark, holes=[(4, "a1")])
    flags = dict(rows(t["int_meteo_departement_jour"].where("numero_departement = '59'"), "date", "mesures_completes"))
    assert [d for d, ok in flags.items() if not ok] == [day(4)]


def test_an_area_without_code_keeps_its_row(spark):
    seed = points(spark, ["a1", "b1"], [None, "2A"])
    observed = marts.enrich_points(staging.stage_weather(history(spark)), seed)
    lost = marts.weather_by_area_day(observed, marts.area_names(seed)).where("numero_departement is null")
    assert {r["date"] for r in lost.collect()} == {day(n) for n in range(10)}
    assert set(rows(lost, "nombre_points_meteo", "departement")) == {(1, "Département None")}


def test_repeated_loads_keep_the_latest(spark):
    at = datetime(2026, 7, 1, 6)
    extra = [
        (at, "59", "D59", 4, 4, "z", AT + timedelta(hours=1)),
        (at, "59", "D59", 3, 3, "y", AT + timedelta(hours=1)),
    ]
    kept = tables(spark, extra)["stg_meteo_forets"].where((F.col("reference_time") == at) & (F.col("numero_departement") == "59"))
    assert rows(kept, "row_hash", "niveau_j1", "departement") == [("z", 4, "D59")]


def test_two_bulletins_a_day_stay_in_the_fact_and_one_trains(spark):
    extra = [(datetime(2026, 7, 9, 18), "59", "D59", 4, 4, "late", AT)]
    t = tables(spark, extra)
    same = (F.col("date_publication") == day(8)) & (F.col("numero_departement") == "59")
    assert t["fact_danger_incendie"].where(same).count() == 4
    trained = t["ml_train_incendie"].where(same)
    assert rows(trained, "echeance", schemas.MODEL_TARGET, "horizon_jours") == [("J1", 4, 1), ("J2", 4, 2)]


def test_asof_weather_and_its_age(spark):
    early = [(datetime(2026, 6, 29, 6), "59", "D59", 1, 1, "early", AT)]
    joined = tables(spark, early, skip=[(5, "b1"), (6, "b1")])["pbi_risque_incendie"]
    ages = {
        (r["numero_departement"], r["date_publication"]): (r["retard_meteo_jours"], r["meteo_disponible"])
        for r in joined.collect()
    }
    assert ages[("59", date(2026, 6, 29))] == (None, False)
    assert ages[("2A", day(6))] == (2, True) and ages[("59", day(6))] == (0, True)
    assert ages[("59", day(11))] == (2, True)
    state = controls.asof_coverage(joined).first()
    assert (state["lignes_incendie"], state["lignes_sans_meteo"], state["retard_maximum"]) == (50, 2, 2)


def test_features_wait_for_seven_complete_days(spark):
    t = tables(spark, skip=[(8, "b1")], holes=[(1, "a1")])
    f = {(r["numero_departement"], r["date_publication"]): r for r in t["ml_features_incendie"].collect()}
    assert [d for n in range(12) if f[("59", d := day(n))]["meteo_disponible"]] == [day(8), day(9)]
    assert [d for n in range(12) if f[("2A", d := day(n))]["meteo_disponible"]] == [day(6), day(7)]
    gap = f[("2A", day(9))]
    assert gap["nombre_jours_meteo_7j"] == 6 and gap["precipitations_moyennes_7j"] is None
    assert gap["temperature_maximale_7j"] == 1.0 and gap["precipitations_7j"] == 2.0
    full = f[("59", day(9))]
    assert (full["precipitations_moyennes_7j"], full["jours_sans_pluie_7j"], full["id_feature"]) == (3.0, 4, "2026-07-10|59")
    assert f[("59", day(11))]["meteo_date"] is None
    coverage = controls.training_coverage(t["ml_train_incendie"]).first()
    assert (coverage["lignes"], coverage["lignes_exploitables"]) == (48, 8)


def test_calendar_spans_observations_and_targets(stored):
    days = [r["date"] for r in stored[1]["dim_date"].orderBy("date").collect()]
    assert days[0] == day(0) and days[-1] == day(13) and len(days) == 14


def test_contracts_hold_and_report_breaches(stored):
    t = dict(stored[1])
    report = contracts.check_tables(t).collect()
    assert [r for r in report if r["violations"]] == []
    kinds = [r["rule"].split(":")[0] for r in report]
    assert {k: kinds.count(k) for k in set(kinds)} == {"not_null": 63, "unique": 12, "accepted": 6, "references": 4}
    t["fact_danger_incendie"] = t["fact_danger_incendie"].withColumn("niveau_danger", F.lit(7).cast("long"))
    broken = Q.validate(t["fact_danger_incendie"], contracts.rules_for("fact_danger_incendie", t)).where("violations > 0")
    assert rows(broken, "rule") == [("accepted:niveau_danger",)]


def test_time_rules(stored):
    _, t = stored
    f, train = t["ml_features_incendie"], t["ml_train_incendie"]
    assert controls.temporal_contract(f, train).count() == 0
    assert controls.temporal_contract(f.withColumn("nombre_jours_meteo_7j", F.lit(6)), train).count() == 8
    late = train.withColumn("date_prevision", F.date_add("date_publication", 1))
    assert controls.temporal_contract(f, late).count() == train.where("echeance = 'J2'").count()


def test_controls_on_raw_history(spark, stored):
    raw = history(spark, skip=[(n, c) for n in (5,) for c in ("a1", "a2", "b1")]).where("code_insee <> 'unknown'")
    assert rows(controls.incomplete_days(raw, 3), "date_observation", "lignes") == [(day(5), 0)]
    required = schemas.REQUIRED_VARIABLES
    assert rows(controls.first_incomplete_day(raw, day(0), day(9), 3, required)) == [(day(5),)]
    assert controls.first_incomplete_day(raw, day(6), day(9), 3, required).count() == 0
    holes = history(spark, holes=[(2, "b1")]).where("code_insee <> 'unknown'")
    refreshed = controls.days_to_refresh(holes, day(0), day(10), 3, required)
    assert [r["jour"] for r in refreshed.collect()] == [day(2), day(10)]
    _, t = stored
    assert controls.sync_check(history(spark), t["fact_meteo"], bulletins(spark), t["fact_danger_incendie"]).first() == (True, True)
    assert controls.volumes(t).first().asDict() == {
        "communes": 3, "departements": 2, "dates": 14, "faits_meteo": 30, "ids_meteo_uniques": 30,
        "faits_incendie": 48, "ids_incendie_uniques": 48,
    }
    assert controls.incomplete_bulletins(t["stg_meteo_forets"], 2).count() == 0
    assert controls.incomplete_bulletins(t["stg_meteo_forets"], 96).count() == 12


def test_written_tables_equal_lazy_ones(spark, stored):
    root, written = stored
    lazy = tables(spark)
    for name in build.WRITTEN:
        assert written[name].columns == lazy[name].columns
        assert rows(written[name]) == rows(lazy[name]), name
    assert [p.name for p in (root / "fact_meteo").iterdir() if p.is_dir()] == ["month=2026-07"]


def test_plans_prune_columns_and_avoid_cross_joins(spark, tmp_path):
    history(spark).write.parquet(str(tmp_path / "w"))
    raw = spark.read.schema(schemas.RAW_WEATHER).parquet(str(tmp_path / "w"))
    seed = points(spark, ["a1", "a2", "b1"], ["59", "59", "2A"])
    t = build.build(raw, bulletins(spark), seed)
    for name, df in t.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    plan = t["ml_train_incendie"]._jdf.queryExecution().executedPlan().toString()
    assert "soil_temperature" not in plan and "snowfall" not in plan


def danger(spark, items):
    out = []
    for i, (n, area, j1, j2) in enumerate(items):
        for label, level in (("J1", j1), ("J2", j2)):
            at = datetime(2026, 7, 1, 6) + timedelta(n)
            out.append((f"{i}-{label}", at, at.date(), at.date() + timedelta(int(label[1])), area, label, level, AT))
    return spark.createDataFrame(
        out,
        "id_danger_incendie string, reference_time timestamp, date_publication date, date_prevision date,"
        " numero_departement string, echeance string, niveau_danger long, insere_a timestamp",
    )


def test_exploration_tables(spark):
    areas = spark.createDataFrame([("59", "Nord", "HDF"), ("2A", "Corse", "COR")], "numero_departement string, departement string, region string")
    df = explore.with_areas(danger(spark, [(0, "59", 1, 3), (0, "2A", 4, 4), (1, "59", 2, 1), (1, "99", 1, None)]), areas)
    assert rows(explore.level_distribution(df), "niveau_danger", "pourcentage") == [(1, 42.86), (2, 14.29), (3, 14.29), (4, 28.57)]
    assert rows(explore.level_by_horizon(df), "niveau_danger", "J1", "J2") == [(1, 50.0, 33.33), (2, 25.0, 0.0), (3, 0.0, 33.33), (4, 25.0, 33.33)]
    assert rows(explore.rank_areas(df), "departement", "observations", "pct_danger_eleve", "nb_tres_eleve") == [
        ("Corse", 2, 100.0, 2), ("Nord", 4, 25.0, 0),
    ]
    assert rows(explore.rank_regions(df)) == [("COR", 100.0), ("HDF", 25.0)]
    assert explore.rank_days(df).first()["departements_niveau_3_ou_4"] == 2
    assert rows(explore.horizon_evolution(df)) == [("Baisse", 33.33), ("Hausse", 33.33), ("Stable", 33.33)]
    assert explore.summary(df).first().asDict() == {
        "niveau_dominant": "Faible", "pct_danger_eleve": 37.5, "departement": "Corse", "pct_departement": 100.0, "evolution": "Baisse",
    }
    assert explore.out_of_domain(df).first()[0] == 1
    assert explore.overview(df).first()["echeances"] == "J1,J2"
    assert explore.incomplete_coverage(df).count() == 4
    assert explore.filter_cases(df, target_day=date(2026, 7, 2), area="59", horizon="J1").count() == 1
    assert rows(explore.area_options(df.where("departement is not null"))) == [("2A - Corse", "2A"), ("59 - Nord", "59")]


def test_enforce_names_the_broken_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    with pytest.raises(Q.ContractError, match=r"not_null:v \(1\); unique:k \(1\)"):
        Q.check(df, [*Q.not_null("v"), Q.unique("k"), Q.not_empty()])
