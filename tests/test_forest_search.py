"""Forests cut from larger ones, and the grid search that uses them."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riskframe.operators import models, stacking
from riskframe.operators.forest_search import cut_forests, first_trees, search_forest


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [(i, rng.random(), rng.random(), rng.random()) for i in range(400)]
    data = [(i, a, b, c, "hi" if a + rng.random() / 3 > 0.6 else "mid" if b > 0.5 else "low") for i, a, b, c in data]
    return spark.createDataFrame(data, "patient_id int, a double, b double, c double, label string")


def test_first_trees_are_the_forest(spark, rows):
    fitted = models.forest_pipeline(["a", "b", "c"], "label", trees=8, depth=4).fit(rows)
    forest = fitted.stages[-1]
    data = rows
    for prepared in fitted.stages[:-1]:
        data = prepared.transform(data)
    cut = first_trees(spark, forest, [1, 3, 8])
    assert [cut[n].getNumTrees for n in (1, 3, 8)] == [1, 3, 8]
    for n in (1, 3, 8):
        assert [t.toDebugString for t in cut[n].trees] == [t.toDebugString for t in forest.trees[:n]]
    same = lambda m: [tuple(r["probability"]) for r in m.transform(data).orderBy("patient_id").select("probability").collect()]
    assert same(cut[8]) == same(forest) and same(cut[1]) != same(forest)
    with pytest.raises(ValueError, match="no first 9"):
        first_trees(spark, forest, [9])


def test_search_scores_every_point_and_fits_the_best(spark, rows):
    found = search_forest(models.forest_pipeline(["a", "b", "c"], "label"), rows, depths=(1, 4), trees=(2, 12), folds=3)
    assert [(d, t) for d, t, _ in found.scores] == [(1, 2), (1, 12), (4, 2), (4, 12)]
    best = max(found.scores, key=lambda x: x[2])
    assert (found.depth, found.trees) == best[:2] and 0.6 < best[2] <= 1 and best[2] > found.scores[0][2]
    forest = found.best.stages[-1]
    assert forest.getNumTrees == found.trees and forest.getMaxDepth() == found.depth
    right = models.prediction_frame(found.best, rows).agg(F.avg((F.col("y_true") == F.col("y_pred")).cast("int"))).first()[0]
    assert right > 0.7


def test_fold_scores(spark):
    held_out = spark.createDataFrame([(i, i % 2, [0.4, 0.6] if i % 4 else [0.7, 0.3]) for i in range(100)], "patient_id int, y_true int, prob array<double>")
    scores = stacking.fold_scores(held_out)
    rows = scores.collect()
    assert sum(r["n"] for r in rows) == 100 and sorted(r["fold"] for r in rows) == list(range(5))
    right = sum(r["n"] * r["accuracy"] for r in rows)
    assert right == pytest.approx(sum(i % 2 == (1 if i % 4 else 0) for i in range(100)))
    mean, spread = stacking.cross_validated_score(scores)
    assert mean == pytest.approx(sum(r["accuracy"] for r in rows) / 5) and spread >= 0


def test_cut_trees_are_trees_of_that_depth(spark, rows):
    """One tree of all features is the same for every depth up to the depth itself, so the cut one can be compared with a fit."""

    def forest(depth):
        pipeline = models.forest_pipeline(["a", "b", "c"], "label", trees=1, depth=depth)
        pipeline.getStages()[-1].setBootstrap(False).setFeatureSubsetStrategy("all")
        return pipeline.fit(rows)

    deep = forest(7)
    data = rows
    for prepared in deep.stages[:-1]:
        data = prepared.transform(data)
    cut = cut_forests(spark, deep.stages[-1], [0, 2, 4, 7], [1])
    same = lambda m: [tuple(r["probability"]) for r in m.transform(data).orderBy("patient_id").select("probability").collect()]
    for depth in (0, 2, 4, 7):
        fitted, got = forest(depth).stages[-1], cut[depth, 1]
        assert got.trees[0].toDebugString.split("\n")[1:] == fitted.trees[0].toDebugString.split("\n")[1:]
        assert same(got) == same(fitted) and got.getMaxDepth() == depth
    with pytest.raises(ValueError, match="no depth 8"):
        cut_forests(spark, deep.stages[-1], [8], [1])


def test_grid_search_fits_one_forest_per_fold(spark, rows, monkeypatch):
    fits = []
    fit = models.RandomForestClassifier._fit
    monkeypatch.setattr(models.RandomForestClassifier, "_fit", lambda self, df: fits.append(self.getMaxDepth()) or fit(self, df))
    found = models.grid_search(models.forest_pipeline(["a", "b", "c"], "label"), rows, depths=(1, 4), trees=(2, 12), folds=3)
    assert sorted(fits)[-3:] == [4, 4, 4] and len(fits) == 4
    scores = {(r["depth"], r["trees"]): r["f1"] for r in models.grid_scores(spark, found).collect()}
    assert set(scores) == {(1, 2), (1, 12), (4, 2), (4, 12)} and 0.6 < max(scores.values()) <= 1
    best = found.bestModel.stages[-1]
    assert scores[best.getMaxDepth(), best.getNumTrees] == max(scores.values()) and found.getNumFolds() == 3


def test_forest_keeps_node_ids_and_grows_the_same_trees(spark, rows):
    *before, forest = models.forest_pipeline(["a", "b", "c"], "label", trees=8, depth=6).getStages()
    assert forest.getCacheNodeIds()
    data = Pipeline(stages=before).fit(rows).transform(rows)
    kept, walked = (forest.copy({forest.cacheNodeIds: flag}).fit(data) for flag in (True, False))
    assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in walked.trees]
