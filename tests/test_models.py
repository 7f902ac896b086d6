import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import anomaly, models, stacking
from riskframe.plans.scoring import ScoringPlan, score_one


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(1)
    rows = [(i, *[rng.gauss(20 if i < 10 else 5, 1) for _ in range(3)]) for i in range(100)]
    return spark.createDataFrame(rows, "patient_id int, lab_a double, lab_b double, lab_c double")


def test_isolation_forest(spark, planted, tmp_path):
    columns = ["lab_a", "lab_b", "lab_c"]
    forest = anomaly.fit_forest(planted, columns, trees=50, sample_size=64)
    got = forest.detect(planted).collect()
    assert all(0 <= r["anomaly_score"] <= 1 for r in got) and len(got) == 100
    top = sorted(got, key=lambda r: -r["anomaly_score"])[:10]
    assert {r["patient_id"] for r in top} == set(range(10))
    assert sum(r["is_anomaly"] for r in got if r["patient_id"] < 10) >= 5
    again = anomaly.fit_forest(planted.repartition(7), columns, trees=50, sample_size=64)
    assert again.nodes.sort_values(["tree", "node"]).reset_index(drop=True).round(9).equals(
        forest.nodes.sort_values(["tree", "node"]).reset_index(drop=True).round(9)
    )
    forest.save(spark, str(tmp_path / "forest"))
    loaded = anomaly.IsolationForest.load(spark, str(tmp_path / "forest"))
    first = {r["patient_id"]: r["anomaly_score"] for r in loaded.detect(planted).collect()}
    assert first == {r["patient_id"]: r["anomaly_score"] for r in got}


def test_forest_without_fit_is_an_error(planted):
    empty = anomaly.IsolationForest(["lab_a"], [0.0], [1.0], None, 2)
    with pytest.raises(RuntimeError):
        empty.detect(planted)


def test_forest_pipeline_stages():
    stages = models.forest_pipeline(["a"], "y").getStages()
    assert [type(s).__name__ for s in stages] == [
        "StringIndexer", "VectorAssembler", "StandardScaler", "RandomForestClassifier",
    ]
    assert stages[-1].getNumTrees() == 150 and stages[-1].getMaxDepth() == 10 and stages[-1].getSeed() == 42


def test_assemble_and_components(spark, planted):
    holes = planted.withColumn("lab_a", F.when(F.col("patient_id") != 3, F.col("lab_a")))
    columns = ["lab_a", "lab_b", "lab_c"]
    assert models.assemble(holes, columns).count() == 100
    assert models.assemble(holes, columns, invalid="skip").count() == 99
    projected, shares = models.principal_components(planted, columns)
    assert shares == sorted(shares, reverse=True) and sum(shares) == pytest.approx(1)
    assert projected.count() == 100 and 1 <= models.components_for(shares) <= 3


def test_sigmoid_fit_matches_gradient(spark):
    rng = random.Random(5)
    rows = [("a", s := rng.gauss(0, 2), int(rng.random() < 1 / (1 + np.exp(-(1.3 * s - 0.4))))) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, s double, y int")
    (a, b) = stacking.fit_sigmoids(df, ["k"], "s", "y")[("a",)]
    p, q = sum(r[2] for r in rows), sum(1 - r[2] for r in rows)
    goal = np.array([(p + 1) / (p + 2) if r[2] else 1 / (q + 2) for r in rows])
    s = np.array([r[1] for r in rows])
    error = 1 / (1 + np.exp(-(a * s + b))) - goal
    assert abs((error * s).sum()) < 1e-5 and abs(error.sum()) < 1e-5 and a > 0


def test_stack(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for i in range(150):
        y = i % 3
        rows.append((i, y, *[rng.random() + (0.8 if k == y else 0) for k in range(3)]))
    df = spark.createDataFrame(rows, "patient_id int, y_true int, a double, b double, c double")
    model, held_out = stacking.fit_stack(df, ["a", "b", "c"], folds=3)
    out = held_out.collect()
    assert len(out) == 150 and all(sum(r["prob"]) == pytest.approx(1) for r in out)
    assert sum(int(np.argmax(r["prob"])) == r["y_true"] for r in out) > 90
    model.save(spark, str(tmp_path / "stack"))
    loaded = stacking.StackedModel.load(spark, str(tmp_path / "stack"))
    first, second = (
        {r["patient_id"]: r["prob"] for r in m.predict(df).select("patient_id", "prob").collect()} for m in (model, loaded)
    )
    assert first == second and all(sum(p) == pytest.approx(1) for p in first.values())


def test_text_classifier(spark, tmp_path):
    rows = [(i, "fever cough acute pain" if i % 2 else "normal routine visit today", "ill" if i % 2 else "well") for i in range(40)]
    df = spark.createDataFrame(rows, "patient_id int, note_text string, label string")
    model = models.fit_text_classifier(df, "label", max_df=1.0)
    got = models.prediction_frame(model, df).collect()
    assert all(r["y_true"] == r["y_pred"] for r in got) and models.class_labels(model) == ["ill", "well"]


def test_scoring_without_models(spark):
    schema = (
        "patient_id string, heart_rate int, oxygen_saturation int, chest_pain int, fever int, "
        "structured array<double>, lab array<double>"
    )
    rows = [("a", 120, 90, 1, 0, None, None), ("b", 80, 97, 0, 0, [0.05, 0.9, 0.05, 0.0, 0.0], None)]
    df = spark.createDataFrame(rows, schema)
    plan = ScoringPlan({"structured": "structured", "lab": "lab"})
    got = {r["patient_id"]: r for r in plan.records(df).collect()}
    assert got["a"]["confidence"] == 0.2 and got["a"]["risk_level"] == "Low" and got["a"]["per_modality_scores"] == {}
    assert got["a"]["predicted_diagnosis"] == "Respiratory Disease"
    assert got["a"]["top_factors"] == [
        "Abnormal heart rate: 120.0", "Low oxygen saturation: 90.0", "Symptom present: chest pain",
    ]
    assert got["a"]["recommended_actions"][-2:] == [
        "Assess respiratory function; consider ABG / pulse oximetry", "Obtain ECG and cardiac biomarkers",
    ]
    assert got["b"]["risk_level"] == "Critical" and got["b"]["predicted_diagnosis"] == "Cardiovascular Disease"
    assert got["b"]["top_factors"] == ["Strongest signal from structured modality"]
    assert set(df.columns) <= set(plan.score(df).columns)
    assert score_one(plan, df, "b").count() == 1


def test_stack_with_a_class_that_a_fold_lacks(spark):
    rows = [(i, 2 if i == 7 else i % 2, (i % 2) + i / 100, 1.0 - (i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "patient_id int, y_true int, a double, b double")
    model, held_out = stacking.fit_stack(df, ["a", "b"])
    got = held_out.collect()
    assert len(got) == 60 and all(sum(r["prob"]) == pytest.approx(1) and len(r["prob"]) == 3 for r in got)
    assert model.predict(df).count() == 60


def test_given_labels_keep_the_place_of_a_class_without_rows(spark):
    rows = [(i, float(i), "b" if i % 2 else "c") for i in range(20)]
    df = spark.createDataFrame(rows, "patient_id int, x double, y string")
    fitted = models.forest_pipeline(["x"], "y", 5, 3, labels=["a", "b", "c"]).fit(df)
    got = models.prediction_frame(fitted, df).collect()
    assert {r["y_true"] for r in got} == {1, 2} and all(len(r["prob"]) == 3 for r in got)


def test_forest_draw_does_not_depend_on_size(spark):
    df = spark.range(3000).select(F.col("id").alias("patient_id"), F.rand(1).alias("x"), F.rand(2).alias("y"))
    one = anomaly.fit_forest(df, ["x", "y"], trees=20, sample_size=32)
    two = anomaly.fit_forest(df.repartition(9), ["x", "y"], trees=20, sample_size=32)
    assert one.threshold == pytest.approx(two.threshold)
    assert one.nodes["tree"].nunique() == 20 and one.sample_size == 32


def test_training_run_round_trip(spark, small, tmp_path):
    from riskframe.plans.training import TrainingSettings, load_models, train
    from riskframe.plans.views import LAB_TESTS, Views
    from riskframe.sources.readers import read_comparison, read_metrics, read_predictions

    v = Views(spark, small)
    settings = TrainingSettings(
        forest_trees=5, forest_depth=3, lab_trees=5, lab_depth=3, text_features=100, lab_tests=tuple(LAB_TESTS),
        note_order=("note_date", "note_id"),
    )
    first = v.truth.agg(F.min("final_diagnosis")).first()[0]
    images = v.embeddings.select((F.col("vec_id") * 3).alias("patient_id"), "embedding")
    images = images.join(v.truth.filter(F.col("final_diagnosis") != first), "patient_id").select(*images.columns)
    run = train(v.patients, v.symptoms.drop("recorded_date"), v.labs, v.notes, v.truth, settings, images)
    assert not run.failures  # the image rows lack the first class
    folder = str(tmp_path / "run")
    run.save(spark, folder)
    assert set(load_models(spark, folder)) == {"structured", "nlp", "lab", "imaging", "ensemble"}
    assert read_metrics(spark, f"{folder}/metrics").count() == run.metrics().count()
    assert read_comparison(spark, f"{folder}/comparison").count() == 5
    back = read_predictions(spark, f"{folder}/predictions", run.predictions.schema)
    same = sorted((r["model"], r["patient_id"], [round(p, 9) for p in r["prob"]]) for r in back.collect())
    assert same == sorted((r["model"], r["patient_id"], [round(p, 9) for p in r["prob"]]) for r in run.predictions.collect())


def test_vocabulary_of_texts_is_counted_in_one_pass(spark, monkeypatch):
    """Terms by total count, equal ones alphabetical; weights from the number of texts with the term."""
    texts = ["bb aa bb", "aa cc bb", "cc dd", None, "aa"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, note_text string")
    model = models.fit_text_vectorizer(df, max_df=0.7)
    counter = next(s for s in model.stages if hasattr(s, "vocabulary"))
    assert counter.vocabulary == ["aa", "bb", "cc"]  # the last share: 3 of 5 texts
    weights = next(s for s in model.stages if hasattr(s, "getScalingVec")).getScalingVec().toArray().tolist()
    assert weights == pytest.approx([np.log(6 / (n + 1)) + 1 for n in (3, 2, 2)])
    with pytest.raises(ValueError, match="no term"):
        models.fit_text_vectorizer(df.limit(0))
