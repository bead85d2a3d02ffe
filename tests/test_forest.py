"""Trees grown in tasks: splits by hand, the same trees wherever a node is split, few jobs."""

from itertools import pairwise

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from skyrisk.operators import forest
from skyrisk.plans import model

INPUTS = [f"x{i}" for i in range(9)]


@pytest.fixture(scope="module")
def noisy(spark):
    """Labels that follow three inputs and noise; an input is constant, another has two values."""
    rows = spark.range(1200).select("id", *[F.rand(i).alias(c) for i, c in enumerate(INPUTS)], F.randn(50).alias("e"))
    rows = rows.withColumns({"x7": F.lit(3.0), "x8": (F.col("id") % 2).cast("double")})
    z = F.sin(6 * F.col("x0")) + 3 * F.col("x1") * F.col("x2") + F.col("x8") / 3 + F.col("e") / 4
    rows = rows.withColumn("label", F.when(z > 1.2, 2.0).when(z > 0.4, 1.0).otherwise(0.0)).withColumn("poids", 1 + F.col("label") / 2)
    rows = VectorAssembler(inputCols=INPUTS, outputCol="features").transform(rows).persist()
    rows.count()
    return rows


def test_a_forest_is_grown_in_few_jobs_however_deep(spark, noisy):
    sc = spark.sparkContext
    sc.setJobGroup("forest", "forest")
    try:
        fitted = model.forest(trees=5).fit(noisy)
        jobs = len(sc.statusTracker().getJobIdsForGroup("forest"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    depth = 0
    for tree in fitted.trees:
        (nodes,) = tree.subtrees.values()
        level = np.zeros(len(nodes.feature), int)
        for i in np.flatnonzero(nodes.feature >= 0):
            level[nodes.below[i] : nodes.below[i] + 2] = level[i] + 1
        depth = max(depth, level.max())
    assert jobs <= 12 < depth  # a job a level would be more


def test_leaves_are_pure_and_hold_the_drawn_rows(noisy):
    data = forest.prepared(noisy, "features", "label", "poids", 32)
    rows, bins = (np.concatenate(p) for p in zip(*forest._blocks(data.blocks.toArrow().to_batches(), len(INPUTS)), strict=True))
    root = forest.root_keys(7, 1)[0]
    count = forest.draws(rows["id"], root)
    assert abs(count.mean() - 1) < 0.15 and abs((count == 0).mean() - np.exp(-1)) < 0.1
    drawn, label = bins[count > 0], rows["label"][count > 0].astype(int)
    tree, gains = forest.grow(drawn, label, rows["weight"][count > 0], count[count > 0].astype(int), int(root), 0, forest.Rules(3, 32, 3, 30, 1))
    votes = tree.votes[tree.below[tree.leaves(drawn)]]
    alike = {}
    for b, v in zip(map(bytes, drawn), label, strict=True):
        alike.setdefault(b, set()).add(v)
    pure = np.array([len(alike[bytes(b)]) == 1 for b in drawn])
    assert pure.mean() > 0.9 and (votes[pure, label[pure]] == 1).all()
    assert gains[7] == 0 and (np.delete(gains, 7) > 0).all() and gains[:3].min() > gains[3:7].max()


def test_best_split_by_hand():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n, classes = 30, 3
        bins, label, weight = rng.integers(0, 5, (n, 2)), rng.integers(0, classes, n), rng.integers(1, 4, n).astype(float)

        def gini(mask):
            share = np.bincount(label[mask], weight[mask], classes) / weight[mask].sum()
            return 1 - (share**2).sum()

        def gain(f, c):
            low = bins[:, f] <= c
            if not 4 <= low.sum() <= n - 4:
                return -np.inf
            part = weight[low].sum() / weight.sum()
            return gini(np.full(n, True)) - part * gini(low) - (1 - part) * gini(~low)

        every = {(f, c): gain(f, c) for f in (1, 0) for c in range(5)}
        total = np.bincount(label, weight, classes)[None]
        best, feature, cut = forest._searched(
            bins, label, weight, np.ones(n), np.arange(n), np.zeros(n, int), np.array([[1, 0]]), total, np.array([float(n)]), forest.Rules(classes, 5, 2, 30, 4)
        )
        assert best[0] == pytest.approx(max(every.values())) == every[int(feature[0]), int(cut[0])]


@pytest.mark.parametrize("local_rows", [40, 300])
def test_nodes_split_by_jobs_or_in_a_task_are_the_same(spark, noisy, monkeypatch, local_rows):
    data = forest.prepared(noisy, "features", "label", "poids", 32)
    whole = model.forest(trees=2).fit(data)
    monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
    split = model.forest(trees=2).fit(data)
    assert all(len(t.subtrees) > 3 for t in split.trees) and all(len(t.subtrees) == 1 for t in whole.trees)
    x = np.array([r["features"].toArray() for r in noisy.select("features").collect()])
    for a, b in zip(whole.trees, split.trees, strict=True):
        assert np.allclose(a.votes(x), b.votes(x))
        assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray())
    # Every row of a tree is in one subtree of at most so many rows.
    sizes = [c for r in split.note["trees"] for c, f in zip(r["below"], r["feature"], strict=True) if f < 0]
    assert len(sizes) == sum(len(t.subtrees) for t in split.trees)
    asked = {r["id"]: r["rawPrediction"].toArray() for r in split.transform(noisy).select("id", "rawPrediction").collect()}
    ids = [r["id"] for r in noisy.select("id").collect()]
    assert np.allclose([asked[i] for i in ids], sum(t.votes(x) for t in whole.trees))


def test_a_node_whose_tried_inputs_are_constant_tries_others():
    bins = np.zeros((8, 9), np.uint8)
    bins[4:, 5] = 1
    for key in range(20):
        tree, _ = forest.grow(bins, np.arange(8) // 4, np.ones(8), np.ones(8, int), key, 0, forest.Rules(2, 32, 3, 30, 1))
        assert tree.feature.tolist() == [5, -1, -1] and tree.votes.tolist() == [[1, 0], [0, 1]]


def test_cuts_lie_between_few_values_or_at_quantiles(noisy):
    data = forest.prepared(noisy, "features", "label", "poids", 32)
    assert list(data.cuts[7]) == [] and list(data.cuts[8]) == [0.5]
    assert len(data.cuts[0]) == 31 and all(0 < b - a < 0.07 for a, b in pairwise(data.cuts[0]))
