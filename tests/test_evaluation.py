"""Score histograms, the one-pass metrics and the areas against brute force; shape of their plans."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import evaluate
from tests.test_scale import brute_auc


def predictions(spark, n=400, classes=3, seed=5, crowded=False):
    rng, rows = random.Random(seed), []
    for model in ("a", "b"):
        for i in range(n):
            w = [rng.random() ** 3 if crowded else rng.randint(1, 6) for _ in range(classes)]
            p = [x / sum(w) * (1e-9 if crowded else 1) for x in w]
            rows.append((model, i, rng.choices(range(classes), w)[0], p.index(max(p)), p))
    return rows, spark.createDataFrame(rows, "model string, i int, y_true int, y_pred int, prob array<double>")


@pytest.mark.parametrize(("crowded", "limit"), [(False, 100_000), (False, 3), (True, 5), (True, 40)])
def test_binned_area_is_exact(spark, crowded, limit):
    rows, df = predictions(spark, crowded=crowded)
    got = {(r["model"], r["class"]): r for r in evaluate.binned_auc_by_class(df, limit=limit).collect()}
    assert len(got) == 6
    for (model, k), r in got.items():
        some = [x for x in rows if x[0] == model]
        assert r["auc"] == pytest.approx(brute_auc([x[2] == k for x in some], [x[4][k] for x in some]), abs=1e-12)
        assert r["support"] == sum(x[2] == k for x in some)


def test_bins_are_bounded_and_ordered(spark):
    _, df = predictions(spark, crowded=True)
    binned = evaluate.score_bins(evaluate.class_scores(df), ["model", "class"], 4)
    full = binned.groupBy("model", "class", "_bin").agg(F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"))
    groups = {}
    for r in full.collect():
        assert r["n"] <= 4
        groups.setdefault((r["model"], r["class"]), []).append((r["_bin"], r["lo"], r["hi"]))
    for bins in groups.values():
        bins.sort()
        assert all(a[2] < b[1] for a, b in zip(bins, bins[1:]))


def test_area_of_one_sided_and_tied_scores(spark):
    rows = [("m", 0, 0, [0.5, 0.5]), ("m", 1, 0, [0.5, 0.5]), ("n", 0, 0, [0.9, 0.1]), ("n", 0, 1, [0.2, 0.8])]
    df = spark.createDataFrame(rows, "model string, y_true int, y_pred int, prob array<double>")
    got = {(r["model"], r["class"]): r["auc"] for r in evaluate.binned_auc_by_class(df).collect()}
    assert got == {("m", 0): 0.5, ("m", 1): 0.5, ("n", 0): None, ("n", 1): None}
    assert evaluate.binned_auc_by_class(df.limit(0)).collect() == [] and evaluate.all_metrics(df.limit(0)).collect() == []


def test_all_metrics_agree_with_the_single_ones(spark):
    _, df = predictions(spark)
    for limit in (100_000, 4):
        got = {(r["model"], r["metric"], r["class"]): r["value"] for r in evaluate.all_metrics(df, limit=limit).collect()}
        want = {}
        for table in (evaluate.overall_metrics(df), evaluate.auc_averages(df), evaluate.log_loss(df)):
            for r in table.collect():
                want |= {(r["model"], m, None): v for m, v in r.asDict().items() if m != "model"}
        for r in evaluate.clinical_metrics(df).collect():
            want |= {(r["model"], m, r["class"]): v for m, v in r.asDict().items() if m not in ("model", "class")}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(v, abs=1e-12) for k, v in want.items())


def test_all_metrics_without_scores(spark):
    _, df = predictions(spark)
    got = {r["metric"] for r in evaluate.all_metrics(df.drop("prob"), prob=None).collect()}
    assert "accuracy" in got and "sensitivity" in got and "log_loss" not in got


def test_all_metrics_read_the_predictions_once(spark, tmp_path):
    _, df = predictions(spark)
    path = str(tmp_path / "predictions")
    df.write.parquet(path)
    source = spark.read.parquet(path)
    long = evaluate.evaluation_frame(source)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in long and "Exchange" not in long  # saved: nothing is read again
    plan = evaluate.all_metrics(source)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange (?:hash|Round|range|Single)", plan)) <= 3  # with the one before saving: four
    assert "FileScan" not in plan and "Join" not in plan


def test_areas_by_interpolation_on_the_union_grid(spark):
    rows, df = predictions(spark, n=150)
    got = {(r["model"], r["curve"]): r["auc"] for r in evaluate.roc_areas(df).collect()}
    for model in ("a", "b"):
        some = [x for x in rows if x[0] == model]
        curves = []
        for k in range(3):
            truth, score = np.array([x[2] == k for x in some]), np.array([x[4][k] for x in some])
            cuts = sorted(set(score), reverse=True)
            fpr = [0.0, *[(score[~truth] >= c).mean() for c in cuts]]
            tpr = [0.0, *[(score[truth] >= c).mean() for c in cuts]]
            curves.append((np.array(fpr), np.array(tpr)))
        grid = np.unique(np.concatenate([c[0] for c in curves]))
        upper = []
        for x, y in curves:  # at a vertical step the upper end, in front of it the lower end
            at = np.searchsorted(x, grid, "right") - 1
            after = np.minimum(at + 1, len(x) - 1)
            width = np.where(x[after] > x[at], x[after] - x[at], 1)
            upper.append(y[at] + (y[after] - y[at]) * (grid - x[at]) / width)
        mean = np.mean(upper, axis=0)
        assert got[model, "macro"] == pytest.approx(float(((mean[1:] + mean[:-1]) * np.diff(grid) / 2).sum()), abs=1e-12)
        for k, (x, y) in enumerate(curves):
            assert got[model, f"class {k}"] == pytest.approx(float(((y[1:] + y[:-1]) * np.diff(x) / 2).sum()), abs=1e-12)
