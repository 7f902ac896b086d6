import pytest
from pyspark.sql import functions as F

from riskframe.functions.presets import (
    AGE_BANDS,
    BMI_BANDS,
    RISK_FROM_POINTS,
    RISK_FROM_PROBABILITY,
    RISK_FROM_SCORE,
)
from riskframe.functions.rules import clamp
from riskframe.operators import clean, fusion, labs, scorecard


def values(spark, rules, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x double")
    return [r["y"] for r in df.select("i", rules.on("x").alias("y")).orderBy("i").collect()]


def test_bands(spark):
    assert values(spark, AGE_BANDS, [17.0, 18.0, 34.0, 35.0, 49.0, 50.0, 64.0, 65.0, None]) == [
        "pediatric", "young_adult", "young_adult", "middle_aged", "middle_aged", "senior", "senior", "elderly", "elderly",
    ]
    assert values(spark, BMI_BANDS, [18.4, 18.5, 25.0, 30.0, None]) == [
        "underweight", "normal", "overweight", "obese", "obese",
    ]
    assert values(spark, RISK_FROM_PROBABILITY, [0.76, 0.75, 0.5, 0.25, 0.0]) == [
        "Critical", "High", "Moderate", "Low", "Low",
    ]
    assert values(spark, RISK_FROM_SCORE, [75.0, 50.0, 25.0, 24.9]) == ["Critical", "High", "Moderate", "Low"]
    assert values(spark, RISK_FROM_POINTS, [5.0, 3.0, 1.0, 0.0]) == ["Critical", "High", "Moderate", "Low"]


VITALS = "patient_id string, systolic_bp double, heart_rate int, respiratory_rate int, temperature double, oxygen_saturation double"


@pytest.mark.parametrize(
    "row, mews, qsofa",
    [
        ((120.0, 75, 13, 37.0, 98.0), 0, 0),
        ((65.0, 135, 32, 40.0, 84.0), 14, 3),
        ((199.5, 129, 29, 38.95, 94.0), 4, 1),
        ((200.0, 40, 8, 34.9, 89.9), 2 + 2 + 2 + 2 + 2, 1),
        ((100.0, 101, 22, 38.4, 93.9), 1 + 1 + 2 + 0 + 1, 2),
        ((None, None, None, None, None), 0, 0),
    ],
)
def test_vital_scores(spark, row, mews, qsofa):
    got = scorecard.with_vital_scores(spark.createDataFrame([("p", *row)], VITALS)).first()
    assert (got["mews_score"], got["qsofa_score"]) == (mews, qsofa)


def test_comorbidity_and_clusters(spark):
    flags = "patient_id string, diabetes int, hypertension int, heart_disease_history int, liver_disease_history int, lung_disease_history int"
    rows = [("a", 1, 1, 1, 0, 0), ("b", 0, 0, 0, 0, 0), ("c", 1, 1, 1, 1, 1), ("d", None, None, None, None, 1)]
    got = scorecard.with_comorbidity_index(spark.createDataFrame(rows, flags)).orderBy("patient_id").collect()
    assert [r["comorbidity_index"] for r in got] == [4, 0, 8, 1]
    with pytest.raises(ValueError, match="diabetes"):
        scorecard.with_comorbidity_index(spark.createDataFrame([("a",)], "patient_id string"))


def test_interactions_nulls(spark):
    schema = "age int, bmi double, smoking_status string, comorbidity_index int, systolic_bp int, heart_rate int, diabetes int"
    df = spark.createDataFrame([(50, 20.0, "Current", 2, 100, 70, None), (None, 20.0, None, 2, None, 70, 1)], schema)
    first, second = scorecard.with_interactions(df).collect()
    assert first["age_bmi_interaction"] == 1000 and first["bmi_diabetes_interaction"] == 0
    assert first["smoking_comorbidity_interaction"] == 4
    assert second["age_bmi_interaction"] is None and second["bp_heart_rate_interaction"] is None
    assert second["smoking_comorbidity_interaction"] == 0


def test_deviation_and_counts(spark):
    df = spark.createDataFrame([(14.75,), (17.5,), (12.0,), (20.25,), (None,)], "hemoglobin double")
    scored = labs.with_critical_flags(labs.with_abnormality_count(labs.with_deviations(df)))
    got = scored.collect()
    assert [r["hemoglobin_deviation"] for r in got] == [0.0, 1.0, -1.0, 2.0, None]
    assert [r["abnormality_count"] for r in got] == [0, 0, 0, 1, 0]
    assert [r["total_critical_flags"] for r in got] == [0, 0, 0, 1, 0]
    panels = labs.with_panel_scores(scored).first()
    assert panels["liver_panel_score"] == 0.0  # no column of the panel exists


def test_panel_counts_present_columns(spark):
    df = spark.createDataFrame([(2.0, None)], "alt_deviation double, ast_deviation double")
    assert labs.with_panel_scores(df).first()["liver_panel_score"] == 1.0


def test_rule_risk(spark):
    df = spark.createDataFrame([(100.0, 50.0), (5.0, None), (3.0, 4.0)], "a double, b double")
    got = labs.with_rule_risk(df, {"a": (4.0, 6.0), "b": (3.0, 5.0), "c": (0.0, 1.0), "d": (0.0, 1.0)}).collect()
    assert [r["rule_risk"] for r in got] == [0.5, 0.0, 0.125]


def test_weighted_fusion_and_unknown_columns(spark):
    df = spark.createDataFrame([("p", 0.8, 0.6, 0.4, 0.2)], "patient_id string, structured_prob double, nlp_prob double, lab_prob double, imaging_prob double")
    got = fusion.with_contributions(fusion.weighted_fusion(df)).first()
    assert got["fused_probability"] == pytest.approx(0.53) and got["risk_category"] == "High"
    assert got["structured_contribution"] == pytest.approx(0.24 / 0.53)
    other = spark.createDataFrame([("p", 1, 0.7)], "patient_id string, k int, share double")
    assert fusion.probability_column(other, "nlp_prob") == "share"


def test_collect_modalities_is_neutral_when_missing(spark):
    a = spark.createDataFrame([("x", 0.9), ("y", 0.1)], "patient_id string, prob double")
    b = spark.createDataFrame([("z", 0.3)], "patient_id string, risk_score double")
    got = {r["patient_id"]: r for r in fusion.collect_modalities({"structured": a, "lab": b}).collect()}
    assert got["x"]["structured_prob"] == 0.9 and got["x"]["lab_prob"] == 0.5
    assert got["z"]["structured_prob"] == 0.5 and got["z"]["lab_prob"] == 0.3


def test_confidence_levels_and_decode(spark):
    df = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.7, 4), (0.5, 4), (0.4, 9)], "c double, k int")
    got = df.select(fusion.confidence_level("c", "k").alias("l"), clean.decode("k", {1: "one", 4: "four"}).alias("d")).collect()
    assert [r["l"] for r in got] == ["Critical", "High", "High", "Medium", "Low"]
    assert [r["d"] for r in got] == ["one", "Class 0", "four", "four", "Class 9"]


def test_fuse_vectors_and_argmax(spark):
    schema = "s array<double>, n array<double>"
    rows = [([0.2, 0.8], [0.6, 0.4]), (None, [0.5, 0.5]), (None, None)]
    df = spark.createDataFrame(rows, schema).select(fusion.fuse_vectors({"s": "s", "n": "n"}, {"s": 0.3}, 2).alias("f"))
    got = df.select("f", fusion.argmax("f").alias("k")).collect()
    assert got[0]["f"] == pytest.approx([(0.3 * 0.2 + 0.5 * 0.6) / 0.8, (0.3 * 0.8 + 0.5 * 0.4) / 0.8])
    assert got[1]["k"] == 0 and got[2]["f"] == [0.5, 0.5]


def test_clamp_vitals_excerpt(spark):
    df = spark.createDataFrame([(None, "x" * 301), (200, "short")], "v int, t string")
    got = df.select(clamp("v", 0, 100).alias("v"), clean.excerpt("t").alias("t")).collect()
    assert got[0]["v"] is None and got[1]["v"] == 100
    assert got[0]["t"] == "x" * 300 + "..." and got[1]["t"] == "short"
    vitals = "heart_rate int, systolic_bp int, diastolic_bp int, temperature double, respiratory_rate int, oxygen_saturation int"
    status = clean.vital_status(spark.createDataFrame([(60, 141, None, 38.5, 21, 101)], vitals)).first()
    assert status["abnormal_vitals"] == ["systolic_bp", "respiratory_rate"] and status["diastolic_bp_status"] is None


def test_symptoms_and_imputation(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", None, 1)], "patient_id string, cough int, fever int")
    got = clean.clean_symptoms(df).orderBy("patient_id").collect()
    assert [r["symptom_count"] for r in got] == [1, 1] and got[0]["fever"] is None
    rows = [(20, 1.0), (None, float("nan")), (40, 3.0), (60, 2.0), (80, None)]
    filled = clean.impute_medians(spark.createDataFrame(rows, "age int, w double"), ["age", "w"], ("age",)).collect()
    assert [r["age"] for r in filled] == [20, 40, 40, 60, 80] and [r["w"] for r in filled] == [1.0, 2.0, 3.0, 2.0, 2.0]
    with pytest.raises(ValueError, match="height"):
        clean.clean_patients(spark.createDataFrame(rows, "age int, w double"))


def test_softmax_and_one_hot(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, 0.0],)], "z array<double>")
    assert df.select(fusion.softmax("z").alias("p")).first()["p"] == pytest.approx([0.5, 0.5, 0.0])
    assert df.select(fusion.one_hot(F.lit(1), 3).alias("h")).first()["h"] == [0.0, 1.0, 0.0]


def test_chart_takes_imputed_vitals(spark):
    from riskframe.functions.presets import SYMPTOMS
    from riskframe.operators import scorecard
    from riskframe.plans.views import Views

    v = Views(spark, "/root/testdata/sf0.001")
    filled = clean.impute_medians(v.patients, ["age", "heart_rate", "systolic_bp", "respiratory_rate", "oxygen_saturation"])
    plain = scorecard.chart_risk(v.patients, v.symptoms, v.labs, SYMPTOMS).select("patient_id", "factors").collect()
    got = {r["patient_id"]: r["factors"] for r in scorecard.chart_risk(filled, v.symptoms, v.labs, SYMPTOMS).collect()}
    assert len(got) == len(plain) and any("Tachycardia (HR " in f for x in got.values() for f in x)


def test_long_and_wide_fusion_agree_for_an_unlisted_modality(spark):
    rows = [("p", "structured", 0, 0.2), ("p", "other", 0, 0.9), ("q", "other", 0, 0.7)]
    long = spark.createDataFrame(rows, "patient_id string, modality string, class int, p double")
    got = {r["patient_id"]: r["p"] for r in fusion.fuse_long(long, {"structured": 0.3}).collect()}
    wide = spark.createDataFrame([("p", [0.2], [0.9]), ("q", None, [0.7])], "patient_id string, s array<double>, o array<double>")
    vector = fusion.fuse_vectors({"structured": "s", "other": "o"}, {"structured": 0.3}, 1)
    expected = {r["patient_id"]: r["v"][0] for r in wide.select("patient_id", vector.alias("v")).collect()}
    assert got["p"] == pytest.approx(0.6375) and got == pytest.approx(expected)


def test_medical_words_are_counted(spark):
    from riskframe.functions.lexicons import ENTITY_LEXICONS
    from riskframe.operators import text

    rows = [(name, " and ".join(list(words)[:3])) for name, words in ENTITY_LEXICONS.items()]
    got = text.with_entity_counts(spark.createDataFrame(rows, "name string, note_text string")).collect()
    assert all(r[r["name"]] >= 3 for r in got)
