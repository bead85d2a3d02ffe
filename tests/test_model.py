"""Model data, split, metrics, training and scoring."""

from datetime import date, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.operators.quality import ContractError
from skyrisk.plans import model

FEATURES = schemas.MODEL_FEATURES
TARGET = schemas.MODEL_TARGET


def training(spark, items, **columns):
    """(target day, level) with constant inputs, or those given."""
    df = spark.createDataFrame([(i, d, level) for i, (d, level) in enumerate(items)], f"i int, date_prevision date, {TARGET} double")
    return df.withColumns({c: columns.get(c, F.lit(1.0)) for c in FEATURES})


def years(*starts, days=4):
    return [(date(y, 6, 1) + timedelta(d), float(level)) for y in starts for d in range(days) for level in schemas.LEVELS]


def test_incomplete_rows_are_dropped(spark):
    df = training(spark, [(date(2024, 6, 1), 1.0), (date(2024, 6, 2), 2.0)], humidite_moyenne=F.when(F.col("i") == 0, 1.0))
    assert rows(model.prepare_training(df), "i", TARGET) == [(0, 1)]
    nan = training(spark, [(date(2024, 6, 1), 1.0), (date(2024, 6, 2), 2.0)], humidite_moyenne=F.when(F.col("i") == 0, 1.0).otherwise(F.lit(float("nan"))))
    assert model.prepare_training(nan).count() == 1


@pytest.mark.parametrize("level", [0.0, 5.0, 2.5])
def test_targets_outside_the_levels_are_refused(spark, level):
    holes = {"humidite_moyenne": F.when(F.col("i") == 1, 1.0)}
    with pytest.raises(ContractError, match="target"):
        model.prepare_training(training(spark, [(date(2024, 6, 1), level), (date(2024, 6, 2), 2.0)], **holes))


def test_bad_inputs_are_refused(spark):
    items = [(date(2024, 6, 1), 1.0)]
    with pytest.raises(ContractError, match="finite"):
        model.prepare_training(training(spark, items, humidite_moyenne=F.lit(float("inf"))))
    with pytest.raises(ContractError, match="numeric:humidite_moyenne"):
        model.prepare_training(training(spark, items, humidite_moyenne=F.lit("x")))
    with pytest.raises(ContractError, match="usable_rows"):
        model.prepare_training(training(spark, items, humidite_moyenne=F.lit(None).cast("double")))
    with pytest.raises(ContractError, match="horizon_jours"):
        model.prepare_training(training(spark, items).drop("horizon_jours"))


@pytest.mark.parametrize(
    "day,part",
    [
        (date(2024, 1, 1), "train"), (date(2025, 12, 31), "train"), (date(2026, 1, 1), "test"),
        (date(2026, 10, 2), "test"), (date(2026, 10, 3), "hors_periode"), (date(2023, 12, 31), "hors_periode"),
        (date(2027, 1, 1), "hors_periode"),
    ],
)
def test_split_boundaries(spark, day, part):
    df = spark.createDataFrame([(day,)], "date_prevision date")
    assert model.temporal_split(df).first()["partie"] == part


def test_split_refuses_empty_parts_missing_days_and_few_rows(spark):
    with pytest.raises(ContractError, match="empty:test"):
        model.split_parts(training(spark, years(2024)))
    with pytest.raises(ContractError, match="empty:train"):
        model.split_parts(training(spark, years(2026)))
    with pytest.raises(ContractError, match="target_day"):
        model.split_parts(training(spark, [*years(2024, 2026), (None, 1.0)]))
    with pytest.raises(ContractError, match="usable_rows"):
        model.split_parts(training(spark, years(2024, 2026, days=1)))


def test_training_on_constant_inputs(spark):
    done = model.train_and_evaluate(training(spark, years(2024, 2025, 2026)), trees=5)
    parts = {r["partie"]: (r["lignes"], r["debut"].year, r["fin"].year) for r in done.split.collect()}
    assert parts == {"train": (32, 2024, 2025), "test": (16, 2026, 2026)}
    base = done.baseline.first()
    assert base["accuracy"] == 0.25 and base["f1_macro"] == pytest.approx(0.1)
    matrix = done.confusion.drop("niveau_reel").collect()
    assert len(matrix) == 4 and all(len(r) == 4 for r in matrix) and sum(map(sum, matrix)) == 16
    assert done.importances.count() == 14
    assert {r["classe"] for r in done.report.collect()} == {"1", "2", "3", "4", "macro", "pondérée"}
    assert done.model.pipeline.stages[-1].numClasses == 4


def learnable(spark):
    """Levels that follow the gust, more of level 1 than of the others."""
    items = [(date(y, 6, 1) + timedelta(d % 20), float(1 + min(3, d % 7))) for y in (2024, 2025, 2026) for d in range(70)]
    gust = F.col(TARGET) * 10 + F.col("i") % 3
    return training(spark, items, rafale_vent_maximale=gust, horizon_jours=(F.col("i") % 2 + 1).cast("double"))


def test_models_learn_and_are_compared(spark):
    scores = {r["modele"]: r["accuracy"] for r in model.compare_models(learnable(spark), trees=10).collect()}
    assert set(scores) == {"classe majoritaire", "régression logistique", "arbre de décision", "forêt aléatoire"}
    assert scores["forêt aléatoire"] > 0.95 and scores["arbre de décision"] > 0.95 and scores["régression logistique"] > 0.9
    assert scores["classe majoritaire"] < 0.6


def test_models_are_saved_with_their_feature_version(spark, tmp_path):
    _, train, test = model.split_parts(learnable(spark))
    fitted = model.train_tree(train)
    model.save_model(fitted, str(tmp_path / "m"))
    again = model.load_model(str(tmp_path / "m"))
    assert rows(again.predict(test), "i", "niveau_predit", "confiance") == rows(fitted.predict(test), "i", "niveau_predit", "confiance")
    with pytest.raises(ContractError, match="features"):
        model.load_model(str(tmp_path / "m"), "another version")


def test_a_large_forest_is_grown_kept_and_asked_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(model, "TREES_AT_ONCE", 2)
    grown, fit = [], model.RandomForestClassifier._fit
    monkeypatch.setattr(model.RandomForestClassifier, "_fit", lambda self, rows: grown.append(self.getNumTrees()) or fit(self, rows))
    _, train, test = model.split_parts(learnable(spark))
    fitted = model.train_forest(train, trees=5)
    assert grown == [2, 2, 1]
    parts = [model.RandomForestClassificationModel.load(p.path) for p in fitted.parts]
    assert len({t.toDebugString for p in parts for t in p.trees}) > 1
    # All trees vote on each row, and the level with most votes is the first of equals.
    inputs = fitted.pipeline.transform(fitted.imputer.fill(test)).select("i", "features").collect()
    votes = {r["i"]: sum(p.predictRaw(r["features"]).toArray() for p in parts) for r in inputs}
    found = fitted.predict(test)
    assert found.columns == [*test.columns, "niveau_predit", "confiance"]
    got = {r["i"]: (r["niveau_predit"], r["confiance"]) for r in found.collect()}
    assert got == {i: (int(v.argmax()) + 1, pytest.approx(v.max() / v.sum())) for i, v in votes.items()}
    each = sum(t.featureImportances.toArray() for p in parts for t in p.trees)
    listed = {r["variable"]: r["importance"] for r in fitted.importances().collect()}
    assert listed == pytest.approx(dict(zip(FEATURES, each / each.sum())))
    model.save_model(fitted, str(tmp_path / "m"))
    again = model.load_model(str(tmp_path / "m"))
    assert rows(again.predict(test), "i", "niveau_predit", "confiance") == rows(found, "i", "niveau_predit", "confiance")
    assert rows(again.importances()) == rows(fitted.importances())


def test_more_rows_mean_fewer_trees_at_once(spark, monkeypatch):
    assert [model.trees_at_once(n) for n in (0, 30_000, 67_186, 600_000, 10**9)] == [20, 20, 8, 1, 1]
    _, train, test = model.split_parts(learnable(spark))
    monkeypatch.setattr(model, "ROWS_AT_ONCE", 3 * train.count() + 1)
    fitted = model.train_forest(train, trees=7)
    assert [p.trees for p in fitted.parts] == [3, 3, 1]
    assert model.classification_metrics(fitted.predict(test)).first()["accuracy"] > 0.95


def test_class_weights_are_balanced(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], f"{TARGET} int")
    assert rows(model.class_weights(df)) == [(1, 3, pytest.approx(4 / 6)), (2, 1, 2.0)]


def test_majority_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([(3,), (2,), (3,), (2,), (4,)], f"{TARGET} int")
    assert model.majority_class(df).first()[0] == 2


def test_metrics_by_hand(spark):
    pairs = [(1, 1), (1, 2), (2, 2), (2, 2), (3, 1), (1, 1)]
    df = spark.createDataFrame(pairs, f"{TARGET} int, niveau_predit int")
    got = model.classification_metrics(df).first()
    f1 = (4 / 6 + 4 / 5 + 0 + 0) / 4
    assert (got["lignes"], got["accuracy"]) == (6, 4 / 6) and got["f1_macro"] == pytest.approx(f1)
    report = {r["classe"]: r for r in model.classification_report(df).collect()}
    assert report["2"]["precision"] == pytest.approx(2 / 3) and report["2"]["rappel"] == 1.0 and report["4"]["f1"] == 0.0
    assert report["macro"]["f1"] == pytest.approx(f1) and report["pondérée"]["support"] == 6
    assert report["pondérée"]["rappel"] == pytest.approx(4 / 6)
    assert [tuple(r) for r in model.confusion(df).collect()] == [(1, 2, 1, 0, 0), (2, 0, 2, 0, 0), (3, 1, 0, 0, 0), (4, 0, 0, 0, 0)]


def snapshot(spark, days=(date(2026, 10, 1),) * 2, codes=("13", "83")):
    df = spark.createDataFrame(
        [(d, c, f"D{c}", "PACA") for d, c in zip(days, codes)],
        "meteo_date date, numero_departement string, departement string, region string",
    )
    return df.withColumns({c: F.lit(20.0) for c in schemas.WEATHER_FEATURES})


def test_scoring_expands_both_horizons(spark):
    out = model.prepare_scoring(snapshot(spark))
    assert rows(out, "numero_departement", "horizon_jours", "echeance", "date_prevision") == [
        ("13", 1, "J1", date(2026, 10, 2)), ("13", 2, "J2", date(2026, 10, 3)),
        ("83", 1, "J1", date(2026, 10, 2)), ("83", 2, "J2", date(2026, 10, 3)),
    ]


def test_scoring_refuses_mixed_days_repeats_and_infinity(spark):
    with pytest.raises(ContractError, match="single_day"):
        model.prepare_scoring(snapshot(spark, (date(2026, 10, 1), date(2026, 10, 2))))
    with pytest.raises(ContractError, match="unique"):
        model.prepare_scoring(snapshot(spark, codes=("13", "13")))
    with pytest.raises(ContractError, match="finite"):
        model.prepare_scoring(snapshot(spark).withColumn("humidite_moyenne", F.lit(float("inf"))))
    with pytest.raises(ContractError, match="not_empty"):
        model.prepare_scoring(snapshot(spark).limit(0))
    with pytest.raises(ContractError, match="region"):
        model.prepare_scoring(snapshot(spark).drop("region"))


def test_scores_carry_a_label_and_a_probability_and_fill_holes(spark):
    _, train, _ = model.split_parts(learnable(spark))
    fitted = model.train_forest(train, trees=5)
    holes = snapshot(spark).withColumn("rafale_vent_maximale", F.when(F.col("numero_departement") == "13", 41.0))
    scored = model.rank_predictions(model.score(fitted, model.prepare_scoring(holes))).collect()
    assert len(scored) == 4 and scored[0]["niveau_predit"] >= scored[-1]["niveau_predit"]
    assert {r["niveau_predit"] for r in scored if r["numero_departement"] == "13"} == {4}
    assert all(0 < r["confiance"] <= 1 and r["niveau"].startswith(f"Niveau {r['niveau_predit']} - ") for r in scored)


def test_history_comparison(spark):
    df = spark.createDataFrame([(1, 3), (2, 2)], f"{TARGET} int, niveau_predit int")
    assert rows(model.compare_history(df), "ecart", "exact", "niveau_officiel") == [
        (0, True, "Niveau 2 - Modéré"), (2, False, "Niveau 1 - Faible"),
    ]


def test_snapshot_is_the_latest_day_complete_for_every_area(spark):
    rows_ = [(date(2026, 10, d), c, d != 2 or c != "83") for d in (1, 2) for c in ("13", "83")]
    df = spark.createDataFrame(rows_, "meteo_date date, numero_departement string, meteo_disponible boolean")
    df = df.withColumns({c: F.lit(1.0) for c in schemas.WEATHER_FEATURES}).withColumns({"departement": F.lit("x"), "region": F.lit("y")})
    areas = spark.createDataFrame([("13",), ("83",)], "numero_departement string")
    assert rows(model.latest_complete_snapshot(df, areas), "meteo_date", "numero_departement") == [
        (date(2026, 10, 1), "13"), (date(2026, 10, 1), "83"),
    ]
