"""Training, evaluation and scoring with pyspark.ml."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk import schemas
from skyrisk.functions.scalars import all_of, any_of, is_infinite, is_missing, level_label, safe_double
from skyrisk.operators import quality as Q
from skyrisk.operators.aggregates import medians
from skyrisk.operators.forest import ASKED_BYTES, RandomForestClassificationModel, RandomForestClassifier, prepared, voted
from skyrisk.operators.joins import latest_where_complete
from skyrisk.operators.reshape import expand_horizons
from skyrisk.sources.shared import stored

TARGET = schemas.MODEL_TARGET
FEATURES = schemas.MODEL_FEATURES
LEVELS = schemas.LEVELS
SEED = 42
MIN_ROWS = 10


# --- Input ------------------------------------------------------------------------------


def usable_training(train: DataFrame) -> DataFrame:
    """Rows with a complete weather window, model columns only."""
    return train.where("meteo_disponible").select(*schemas.MODEL_CONTEXT, *FEATURES, TARGET)


def load_training(train: DataFrame) -> DataFrame:
    """The usable rows as a listing in a stable order; training itself needs no order."""
    return usable_training(train).orderBy("date_prevision", "numero_departement", "echeance")


def _number(column: str) -> Column:
    return safe_double(column)


def _complete() -> Column:
    """Every input and the target are present."""
    return all_of([~is_missing(_number(c)) for c in [*FEATURES, TARGET]])


def training_rules(least_rows: int = 1) -> list[Q.Rule]:
    """Numbers only, nothing infinite, targets in 1..4 even on rows that will be dropped."""
    columns = [*FEATURES, TARGET]
    infinite = any_of([F.coalesce(is_infinite(_number(c)), F.lit(False)) for c in columns])
    outside = ~_number(TARGET).isin([float(v) for v in LEVELS]) & ~F.isnan(_number(TARGET))
    return [
        *Q.numeric(*columns),
        Q.row_rule("finite", infinite),
        Q.row_rule("target", outside),
        Q.Rule("usable_rows", measure=F.when(F.count_if(_complete()) < least_rows, 1).otherwise(0)),
    ]


def _ready(df: DataFrame) -> DataFrame:
    rows = df.where(_complete()).withColumns({c: _number(c) for c in [*FEATURES, TARGET]})
    return rows.withColumn(TARGET, F.col(TARGET).cast("int"))


def prepare_training(df: DataFrame) -> DataFrame:
    """Complete numeric rows, after the checks; context columns are kept."""
    Q.require_columns(df, [*FEATURES, TARGET])
    return _ready(Q.check(df, training_rules()))


@dataclass(frozen=True)
class Split:
    """Rules of the temporal split; the day is the target day, never the publication day."""

    train_years: Sequence[int] = schemas.TRAIN_YEARS
    test_year: int = schemas.TEST_YEAR
    test_end: date = schemas.TEST_END
    day: str = "date_prevision"

    def part(self) -> Column:
        day = F.to_date(F.col(self.day))
        in_test = (F.year(day) == self.test_year) & (day <= F.lit(self.test_end))
        return (
            F.when(F.year(day).isin(list(self.train_years)), "train")
            .when(in_test, "test")
            .otherwise("hors_periode")
        )


def temporal_split(df: DataFrame, split: Split = Split(), name: str = "partie") -> DataFrame:
    return df.withColumn(name, split.part())


def split_report(parts: DataFrame, day: str = "date_prevision") -> DataFrame:
    """Rows and first and last target day of each part."""
    return (
        parts.groupBy("partie")
        .agg(F.count(F.lit(1)).alias("lignes"), F.min(day).alias("debut"), F.max(day).alias("fin"))
        .orderBy("partie")
    )


def split_rules(split: Split = Split()) -> list[Q.Rule]:
    """Every usable row has a target day, and neither part is empty."""
    part = split.part()

    def absent(name: str) -> Q.Rule:
        rows = F.count_if(_complete() & (part == name))
        return Q.Rule(f"empty:{name}", measure=F.when(rows == 0, 1).otherwise(0))

    no_day = _complete() & F.to_date(F.col(split.day)).isNull()
    return [Q.row_rule("target_day", no_day), absent("train"), absent("test")]


def class_weights(df: DataFrame, target: str = TARGET) -> DataFrame:
    """(class, rows, weight): rows / (classes x rows of the class), for balanced training."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("lignes"))
    totals = counts.agg(F.sum("lignes").alias("n"), F.count(F.lit(1)).alias("k"))
    n, k = totals.select("n").scalar(), totals.select("k").scalar()
    return counts.select(target, "lignes", (n / (k * F.col("lignes"))).alias("poids"))


def with_class_weight(df: DataFrame, target: str = TARGET, name: str = "poids") -> DataFrame:
    # One row per class: the target domain is fixed to four levels.
    weights = class_weights(df, target).select(target, F.col("poids").alias(name))
    return df.join(F.broadcast(weights), target)


def majority_class(train: DataFrame, target: str = TARGET) -> DataFrame:
    """The most frequent class of the training part, the smallest one on ties, in one row."""
    return (
        train.groupBy(target)
        .agg(F.count(F.lit(1)).alias("lignes"))
        .orderBy(F.col("lignes").desc(), target)
        .limit(1)
        .select(F.col(target).alias("niveau_predit"))
    )


def majority_predictions(train: DataFrame, test: DataFrame, target: str = TARGET) -> DataFrame:
    return test.withColumn("niveau_predit", majority_class(train, target).scalar())


# --- Metrics ----------------------------------------------------------------------------


def _cells(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row of counts: hits, predicted and actual rows per level, and the total."""
    items = []
    for v in LEVELS:
        is_true, is_predicted = F.col(truth) == v, F.col(predicted) == v
        items += [
            F.count_if(is_true & is_predicted).alias(f"hit{v}"),
            F.count_if(is_predicted).alias(f"predicted{v}"),
            F.count_if(is_true).alias(f"actual{v}"),
        ]
    right = F.count_if(F.col(truth) == F.col(predicted)).alias("right")
    return df.agg(F.count(F.lit(1)).alias("total"), right, *items)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def classification_report(df: DataFrame, truth: str = TARGET, predicted: str = "niveau_predit") -> DataFrame:
    """Precision, recall, F1 and support per level, then the macro and weighted averages."""
    rows = [
        F.struct(
            F.lit(str(v)).alias("classe"),
            _ratio(F.col(f"hit{v}"), F.col(f"predicted{v}")).alias("precision"),
            _ratio(F.col(f"hit{v}"), F.col(f"actual{v}")).alias("rappel"),
            _ratio(2 * F.col(f"hit{v}"), F.col(f"predicted{v}") + F.col(f"actual{v}")).alias("f1"),
            F.col(f"actual{v}").alias("support"),
        )
        for v in LEVELS
    ]
    per_class = _cells(df, truth, predicted).select(F.inline(F.array(*rows)))
    scores = ["precision", "rappel", "f1"]
    weight = F.sum("support")
    macro = per_class.agg(*[F.avg(s).alias(s) for s in scores], weight.alias("support")).withColumn(
        "classe", F.lit("macro")
    )
    weighted = per_class.agg(
        *[_ratio(F.sum(F.col(s) * F.col("support")), weight).alias(s) for s in scores], weight.alias("support")
    ).withColumn("classe", F.lit("pondérée"))
    return per_class.unionByName(macro).unionByName(weighted)


def classification_metrics(df: DataFrame, truth: str = TARGET, predicted: str = "niveau_predit") -> DataFrame:
    """Accuracy and macro F1 over the four levels, undefined F1 counting as 0."""
    f1 = [
        _ratio(2 * F.col(f"hit{v}"), F.col(f"predicted{v}") + F.col(f"actual{v}")) for v in LEVELS
    ]
    macro = sum(f1[1:], f1[0]) / F.lit(float(len(LEVELS)))
    return _cells(df, truth, predicted).select(
        F.col("total").alias("lignes"),
        _ratio(F.col("right"), F.col("total")).alias("accuracy"),
        macro.alias("f1_macro"),
    )


def confusion(df: DataFrame, truth: str = TARGET, predicted: str = "niveau_predit") -> DataFrame:
    """True levels in rows, predicted levels in columns."""
    cells = df.agg(
        *[
            F.count_if((F.col(truth) == t) & (F.col(predicted) == p)).alias(f"_{t}{p}")
            for t in LEVELS
            for p in LEVELS
        ]
    )
    rows = [
        F.struct(
            F.lit(t).cast("long").alias("niveau_reel"), *[F.col(f"_{t}{p}").alias(f"predit_{p}") for p in LEVELS]
        )
        for t in LEVELS
    ]
    return cells.select(F.inline(F.array(*rows))).orderBy("niveau_reel")


# --- Models -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Imputer:
    """Exact medians of the training part, used to fill missing model inputs."""

    values: Mapping[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str] = tuple(FEATURES)) -> Imputer:
        return cls(medians(df, columns))

    def fill(self, df: DataFrame) -> DataFrame:
        doubles = df.withColumns({c: F.col(c).cast("double") for c in self.values})
        return doubles.fillna(dict(self.values))


def _assembler(output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol=output)


# Trees grown together, at most, and the training rows dealt to tasks for them all. Both are fixed,
# so that a forest does not depend on the machine that grows it.
TREES_AT_ONCE = 20
ROWS_AT_ONCE = 600_000
PARTS_AT_ONCE = 4  # parts whose jobs run side by side


def trees_at_once(rows: int) -> int:
    """Trees of a part of a forest that learns from so many rows; one at least."""
    return max(1, min(TREES_AT_ONCE, ROWS_AT_ONCE // max(rows, 1)))


TREES = 200


def forest(trees: int = TREES, max_depth: int = 30, seed: int = SEED, least_leaf: int = 1) -> RandomForestClassifier:
    """Balanced random forest. 30 is the deepest tree of Spark's parameters; `least_leaf` rows end a branch."""
    return RandomForestClassifier(
        numTrees=trees,
        maxDepth=max_depth,
        minInstancesPerNode=least_leaf,
        featureSubsetStrategy="sqrt",
        weightCol="poids",
        labelCol="label",
        seed=seed,
    )


def tree(seed: int = SEED) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        maxDepth=8, minInstancesPerNode=20, weightCol="poids", labelCol="label", seed=seed
    )


def logistic(weight_total: float) -> LogisticRegression:
    """L2 penalty of one unit against the summed weights, on standardised inputs."""
    return LogisticRegression(
        featuresCol="scaled",
        regParam=1.0 / weight_total,
        standardization=False,
        maxIter=2000,
        weightCol="poids",
        labelCol="label",
    )


def _fit(stages: Sequence[Estimator | Transformer], train: DataFrame) -> PipelineModel:
    """Fit on balanced rows."""
    return Pipeline(stages=list(stages)).fit(_balanced(train))


def _balanced(train: DataFrame) -> DataFrame:
    """Rows with their weight; labels are levels minus one, so that classes start at 0."""
    return with_class_weight(train).withColumn("label", (F.col(TARGET) - 1).cast("double"))


@dataclass(frozen=True)
class Part:
    """Some trees of a forest, saved in a shared folder, and the sum of their importances."""

    path: str
    trees: int
    importances: Sequence[float]


def _grow(train: DataFrame, trees: int, at_once: int, seed: int = SEED, **options) -> tuple[PipelineModel, Sequence[Part]]:
    """The assembler, and the forest in parts of at most `at_once` trees, each in a folder."""
    assembler = PipelineModel(stages=[_assembler()])
    rows = prepared(assembler.transform(_balanced(train)), "features", "label", "poids", forest().getMaxBins())
    estimators = [forest(min(at_once, trees - first), seed=seed + first, **options) for first in range(0, trees, at_once)]

    def grown(estimator: RandomForestClassifier) -> Part:
        fitted = estimator.fit(rows)
        return Part(fitted.path, fitted.getNumTrees, tuple(fitted.importance_sums))

    with ThreadPoolExecutor(PARTS_AT_ONCE) as pool:
        return assembler, tuple(pool.map(grown, estimators))


def _asked_together(parts: Sequence[Part]) -> list[list[RandomForestClassificationModel]]:
    """Parts in order, in groups whose nodes take `ASKED_BYTES` at most, or of a single part."""
    groups, size = [], 0
    for part in parts:
        loaded = RandomForestClassificationModel.load(part.path)
        size += (own := loaded.bytes())
        if not groups or size > ASKED_BYTES:
            groups.append([])
            size = own
        groups[-1].append(loaded)
    return groups


def _voted(parts: Sequence[Part], rows: DataFrame) -> DataFrame:
    """Rows with `prediction` and `probability` of a forest in parts. Groups of parts add their votes
    one after the other, with the rows written in between, so that the driver holds one at a time."""
    columns = rows.columns
    for i, models in enumerate(_asked_together(parts)):
        votes = voted(models)(vector_to_array("features"))
        if i:
            votes = F.zip_with("_votes", votes, lambda a, b: a + b)
        rows = stored(rows.select(*columns, votes.alias("_votes")), "votes")
    best, total = F.array_max("_votes"), F.aggregate("_votes", F.lit(0.0), lambda a, b: a + b)
    return rows.select(
        *columns,
        (F.array_position("_votes", best) - 1).cast("double").alias("prediction"),
        F.transform("_votes", lambda v: v / total).alias("probability"),
    )


@dataclass(frozen=True)
class DangerModel:
    """A fitted pipeline, the medians that complete its inputs and its feature version. A forest
    of more trees than `trees_at_once` is in `parts`, and its pipeline ends before it."""

    pipeline: PipelineModel
    imputer: Imputer
    version: str = schemas.FEATURE_VERSION
    parts: Sequence[Part] = ()

    def predict(self, df: DataFrame) -> DataFrame:
        """Add the predicted level and its probability; input columns are untouched. A forest in
        parts predicts at once and the result is read back; any other model is lazy."""
        inputs = {c: f"_x_{c}" for c in FEATURES}
        filled = self.imputer.fill(df.select("*", *[F.col(c).alias(x) for c, x in inputs.items()]).select(
            *[c for c in df.columns if c not in inputs], *[F.col(c) for c in FEATURES], *inputs.values()
        ))
        out = self.pipeline.transform(filled)
        if self.parts:
            out, probability = _voted(self.parts, out), F.col("probability")
        else:
            probability = vector_to_array("probability")
        return out.select(
            *[F.col(inputs.get(c, c)).alias(c) for c in df.columns],
            (F.col("prediction") + 1).cast("long").alias("niveau_predit"),
            F.array_max(probability).alias("confiance"),
        )

    def importances(self) -> DataFrame:
        """Feature importances of a tree model, largest first."""
        spark = SparkSession.active()
        if self.parts:
            sums = [sum(p.importances[i] for p in self.parts) for i in range(len(FEATURES))]
            scores = [s / (sum(sums) or 1.0) for s in sums]
        else:
            scores = self.pipeline.stages[-1].featureImportances.toArray().tolist()
        rows = spark.createDataFrame(list(zip(FEATURES, scores)), "variable string, importance double")
        return rows.orderBy(F.col("importance").desc(), "variable")


def train_forest(train: DataFrame, imputer: Imputer | None = None, **options) -> DangerModel:
    """A forest; an imputer fitted on the same rows may be shared between models."""
    options = {"trees": TREES} | options
    at_once = trees_at_once(train.count())
    if options["trees"] > at_once:
        pipeline, parts = _grow(train, at_once=at_once, **options)
        return DangerModel(pipeline, imputer or Imputer.fit(train), parts=parts)
    return DangerModel(_fit([_assembler(), forest(**options)], train), imputer or Imputer.fit(train))


def train_tree(train: DataFrame, imputer: Imputer | None = None) -> DangerModel:
    return DangerModel(_fit([_assembler(), tree()], train), imputer or Imputer.fit(train))


def train_logistic(train: DataFrame, imputer: Imputer | None = None) -> DangerModel:
    # Balanced weights sum to the number of rows.
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    stages = [_assembler(), scaler, logistic(float(train.count()))]
    return DangerModel(_fit(stages, train), imputer or Imputer.fit(train))


def split_parts(df: DataFrame, split: Split = Split()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all usable rows with their part, train, test).

    The rows are written to the shared folder once, and read from there by the checks, by
    training and by evaluation: nothing stays in the executors' memory.
    """
    Q.require_columns(df, [*FEATURES, TARGET, split.day])
    rows = stored(df, "training_rows")
    Q.check(rows, training_rules(MIN_ROWS) + split_rules(split))
    parts = temporal_split(_ready(rows), split)
    return parts, parts.where("partie = 'train'"), parts.where("partie = 'test'")


@dataclass(frozen=True)
class Evaluation:
    """What a training run reports; every table is a DataFrame."""

    model: DangerModel
    metrics: DataFrame
    baseline: DataFrame
    report: DataFrame
    confusion: DataFrame
    importances: DataFrame
    split: DataFrame


def train_and_evaluate(df: DataFrame, split: Split = Split(), **options) -> Evaluation:
    """Fit on the training years, measure on the test period only."""
    parts, train, test = split_parts(df, split)
    model = train_forest(train, **options)
    predicted = model.predict(test)
    return Evaluation(
        model,
        classification_metrics(predicted),
        classification_metrics(majority_predictions(train, test)),
        classification_report(predicted),
        confusion(predicted),
        model.importances(),
        split_report(parts, split.day),
    )


def compare_models(df: DataFrame, split: Split = Split(), **options) -> DataFrame:
    """Accuracy and macro F1 of the baseline, logistic, tree and forest models on the same split."""
    _, train, test = split_parts(df, split)
    imputer = Imputer.fit(train)
    predictions = {
        "classe majoritaire": majority_predictions(train, test),
        "régression logistique": train_logistic(train, imputer).predict(test),
        "arbre de décision": train_tree(train, imputer).predict(test),
        "forêt aléatoire": train_forest(train, imputer, **options).predict(test),
    }
    result = None
    for name, predicted in predictions.items():
        scores = classification_metrics(predicted).select(F.lit(name).alias("modele"), "accuracy", "f1_macro")
        result = scores if result is None else result.unionByName(scores)
    return result


def save_model(model: DangerModel, path: str) -> None:
    """The pipeline, the parts of a large forest and, beside them, the version and the medians."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    parts = [Part(f"{path}/trees-{i}", p.trees, p.importances) for i, p in enumerate(model.parts)]
    for old, new in zip(model.parts, parts, strict=True):
        RandomForestClassificationModel.load(old.path).write().overwrite().save(new.path)
    listed = [[p.trees, list(p.importances)] for p in parts]
    note = json.dumps({"version": model.version, "medians": dict(model.imputer.values), "parts": listed})
    spark = SparkSession.active()
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/note")


def load_model(path: str, version: str = schemas.FEATURE_VERSION) -> DangerModel:
    """Refuse a model trained on another version of the features."""
    note = json.loads(SparkSession.active().read.text(f"{path}/note").first()["value"])
    if note["version"] != version:
        raise Q.ContractError(f"Model trained on features {note['version']}, not {version}")
    parts = [Part(f"{path}/trees-{i}", trees, scores) for i, (trees, scores) in enumerate(note.get("parts", []))]
    return DangerModel(PipelineModel.load(f"{path}/pipeline"), Imputer(note["medians"]), version, parts)


# --- Scoring ----------------------------------------------------------------------------

SNAPSHOT = ["meteo_date", "numero_departement", "departement", "region", *schemas.WEATHER_FEATURES]


def latest_complete_snapshot(feature_rows: DataFrame, areas: DataFrame) -> DataFrame:
    """Usable rows of the latest day on which every area has a complete window."""
    total = areas.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = latest_where_complete(
        feature_rows, "meteo_date", "numero_departement", F.col("meteo_disponible"), total
    )
    return rows.select(*SNAPSHOT).orderBy("numero_departement")


def prepare_scoring(snapshot: DataFrame) -> DataFrame:
    """One row per area and horizon, from a snapshot of a single day without repeated area."""
    Q.require_columns(snapshot, SNAPSHOT)
    one_day = Q.Rule(
        "single_day", measure=F.when(F.count_distinct("meteo_date") != 1, 1).otherwise(0)
    )
    Q.check(
        snapshot,
        [Q.not_empty(), one_day, *Q.not_null("meteo_date", "numero_departement"), Q.unique("numero_departement"), Q.finite(*schemas.WEATHER_FEATURES)],
    )
    return expand_horizons(snapshot, "meteo_date")


def score(model: DangerModel, scoring: DataFrame) -> DataFrame:
    """Predicted level, probability and label of each area and horizon."""
    return model.predict(scoring).select(
        "meteo_date",
        "date_prevision",
        "numero_departement",
        "departement",
        "region",
        "echeance",
        "temperature_moyenne",
        "humidite_moyenne",
        "precipitations_moyennes",
        "rafale_vent_maximale",
        "niveau_predit",
        "confiance",
        level_label("niveau_predit").alias("niveau"),
    )


def rank_predictions(scored: DataFrame) -> DataFrame:
    """The most dangerous and most certain first."""
    return scored.orderBy(F.col("niveau_predit").desc(), F.col("confiance").desc(), "numero_departement")


def compare_history(predicted: DataFrame, truth: str = TARGET) -> DataFrame:
    """Predicted against announced level: signed gap and hit flag."""
    gap = F.col("niveau_predit").cast("long") - F.col(truth).cast("long")
    return predicted.withColumns(
        {
            "ecart": gap,
            "exact": gap == 0,
            "niveau_modele": level_label("niveau_predit"),
            "niveau_officiel": level_label(truth),
        }
    )
