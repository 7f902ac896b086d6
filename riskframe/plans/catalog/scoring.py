"""Scorecards, risk levels and heuristic risk of the entity table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.presets import COMORBIDITIES, SYMPTOM_CLUSTERS, SYMPTOMS
from riskframe.operators import clean, explore, scorecard
from riskframe.plans.catalog.registry import joined, query, rounded

_MEWS = """
  CASE WHEN systolic_bp <= 70 THEN 3 WHEN systolic_bp <= 80 THEN 2 WHEN systolic_bp <= 100 THEN 1
    WHEN systolic_bp <= 199 THEN 0 WHEN systolic_bp >= 200 THEN 2 ELSE 0 END
  + CASE WHEN heart_rate <= 40 THEN 2 WHEN heart_rate <= 50 THEN 1 WHEN heart_rate <= 100 THEN 0
    WHEN heart_rate <= 110 THEN 1 WHEN heart_rate <= 129 THEN 2 WHEN heart_rate >= 130 THEN 3 ELSE 0 END
  + CASE WHEN respiratory_rate < 9 THEN 2 WHEN respiratory_rate <= 14 THEN 0 WHEN respiratory_rate <= 20 THEN 1
    WHEN respiratory_rate <= 29 THEN 2 WHEN respiratory_rate >= 30 THEN 3 ELSE 0 END
  + CASE WHEN temperature < 35 THEN 2 WHEN temperature <= 38.4::DOUBLE THEN 0 WHEN temperature <= 38.9::DOUBLE THEN 1
    WHEN temperature >= 39 THEN 2 ELSE 0 END
  + CASE WHEN oxygen_saturation < 85 THEN 3 WHEN oxygen_saturation < 90 THEN 2 WHEN oxygen_saturation < 94 THEN 1 ELSE 0 END
"""
_QSOFA = """
  CASE WHEN systolic_bp <= 100 THEN 1 ELSE 0 END + CASE WHEN respiratory_rate >= 22 THEN 1 ELSE 0 END
  + CASE WHEN oxygen_saturation < 90 THEN 1 ELSE 0 END
"""
_INDEX = """
  coalesce(diabetes, 0) + coalesce(hypertension, 0) + 2 * coalesce(heart_disease_history, 0)
  + 3 * coalesce(liver_disease_history, 0) + coalesce(lung_disease_history, 0)
"""
_POINTS = """
  CASE WHEN oxygen_saturation < 90 THEN 3 WHEN oxygen_saturation < 94 THEN 2 WHEN oxygen_saturation < 96 THEN 1 ELSE 0 END
  + CASE WHEN heart_rate > 120 OR heart_rate < 50 THEN 2 WHEN heart_rate > 100 OR heart_rate < 60 THEN 1 ELSE 0 END
  + CASE WHEN temperature > 39.5::DOUBLE THEN 2 WHEN temperature > 38.5::DOUBLE THEN 1 ELSE 0 END
  + CASE WHEN age > 70 THEN 1 ELSE 0 END
"""
_LEVEL = "CASE WHEN severity_points >= 5 THEN 'Critical' WHEN severity_points >= 3 THEN 'High' WHEN severity_points >= 1 THEN 'Moderate' ELSE 'Low' END"


@query("score_vitals", f"SELECT patient_id, {_MEWS} AS mews_score, {_QSOFA} AS qsofa_score FROM patients")
def score_vitals(v):
    return scorecard.with_vital_scores(v.patients).select("patient_id", "mews_score", "qsofa_score")


@query("score_comorbidity", f"SELECT patient_id, {_INDEX} AS comorbidity_index FROM patients")
def score_comorbidity(v):
    return scorecard.with_comorbidity_index(v.patients).select("patient_id", "comorbidity_index")


@query(
    "score_interactions",
    f"""
    WITH indexed AS (SELECT *, {_INDEX} AS ci FROM patients)
    SELECT patient_id, CAST(age AS DOUBLE) * bmi AS age_bmi_interaction,
      CAST(CASE smoking_status WHEN 'Current' THEN 2 WHEN 'Former' THEN 1 ELSE 0 END * ci AS DOUBLE) AS smoking_comorbidity_interaction,
      CAST(systolic_bp * heart_rate AS DOUBLE) AS bp_heart_rate_interaction,
      CAST(age * ci AS DOUBLE) AS age_comorbidity_interaction,
      bmi * coalesce(diabetes, 0) AS bmi_diabetes_interaction
    FROM indexed
    """,
)
def score_interactions(v):
    scored = scorecard.with_interactions(scorecard.with_comorbidity_index(v.patients))
    return scored.select("patient_id", *[c for c in scored.columns if c.endswith("_interaction")])


_CLUSTERS = ", ".join(
    " + ".join(f"coalesce({s}, 0)" for s in flags) + f" AS {name}" for name, flags in SYMPTOM_CLUSTERS.items()
)


@query("score_symptom_clusters", f"SELECT patient_id, {_CLUSTERS} FROM symptoms")
def score_symptom_clusters(v):
    return scorecard.with_symptom_clusters(v.symptoms).select("patient_id", *SYMPTOM_CLUSTERS)




@query(
    "risk_severity_level",
    f"""
    WITH pointed AS (
      SELECT p.patient_id, final_diagnosis,
        CASE WHEN final_diagnosis = 'MACHINERY' THEN 0 ELSE {_POINTS} END AS severity_points
      FROM patients p JOIN truth t ON p.patient_id = t.patient_id),
    levelled AS (SELECT *, {_LEVEL} AS severity_level FROM pointed)
    SELECT *, CASE WHEN severity_level = 'Critical' THEN 1 ELSE 0 END AS needs_icu
    FROM levelled
    """,
)
def risk_severity_level(v):
    joined_rows = v.patients.join(v.truth, "patient_id")
    scored = scorecard.with_severity_level(joined_rows, healthy="MACHINERY")
    return scored.select("patient_id", "final_diagnosis", "severity_points", "severity_level", "needs_icu")


@query(
    "risk_level_by_segment",
    f"""
    WITH medians AS (
      SELECT (SELECT quantile_disc(age, 0.5) FROM patients WHERE age IS NOT NULL) AS m_age,
        (SELECT quantile_disc(bmi, 0.5) FROM patients WHERE bmi IS NOT NULL) AS m_bmi),
    filled AS (
      SELECT patient_id, CAST(coalesce(age, m_age) AS INT) AS age, coalesce(bmi, m_bmi) AS bmi, systolic_bp, heart_rate,
        respiratory_rate, temperature, oxygen_saturation, diabetes, hypertension, heart_disease_history,
        liver_disease_history, lung_disease_history
      FROM patients, medians),
    scored AS (
      SELECT patient_id, {_MEWS} AS mews_score, {_QSOFA} AS qsofa_score, {_INDEX} AS comorbidity_index,
        {_POINTS} AS severity_points,
        CASE WHEN age < 18 THEN 'pediatric' WHEN age < 35 THEN 'young_adult' WHEN age < 50 THEN 'middle_aged'
          WHEN age < 65 THEN 'senior' ELSE 'elderly' END AS age_group
      FROM filled)
    SELECT final_diagnosis AS segment, {_LEVEL} AS severity_level, age_group, count(*) AS n,
      round(avg(mews_score), 6) AS mean_mews, round(avg(qsofa_score), 6) AS mean_qsofa,
      round(avg(comorbidity_index), 6) AS mean_comorbidity
    FROM scored JOIN truth ON scored.patient_id = truth.patient_id
    GROUP BY final_diagnosis, {_LEVEL}, age_group
    """,
)
def risk_level_by_segment(v):
    cleaned = clean.clean_patients(v.patients, ["age", "bmi"])
    scored = scorecard.with_comorbidity_index(scorecard.with_vital_scores(cleaned))
    labelled = scored.join(v.truth.withColumnRenamed("final_diagnosis", "segment"), "patient_id")
    levelled = scorecard.with_severity_level(labelled, label="segment")
    counted = levelled.groupBy("segment", "severity_level", "age_group").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("mews_score").alias("mean_mews"),
        F.avg("qsofa_score").alias("mean_qsofa"),
        F.avg("comorbidity_index").alias("mean_comorbidity"),
    )
    return rounded(counted, ["mean_mews", "mean_qsofa", "mean_comorbidity"])


_HISTORY = " + ".join(f"CASE WHEN {c} = 1 THEN 5 ELSE 0 END" for c in COMORBIDITIES)
_HISTORY_TEXT = ", ".join(
    f"CASE WHEN {c} = 1 THEN 'History: {c.replace('_', ' ').title()}' END" for c in COMORBIDITIES
)
_LOAD = " + ".join(f"coalesce({s}, 0)" for s in SYMPTOMS)


@query(
    "risk_chart",
    f"""
    WITH load AS (SELECT patient_id, {_LOAD} AS n_symptoms FROM symptoms),
    abnormal AS (
      SELECT patient_id, sum(CASE WHEN value < reference_low OR value > reference_high THEN 1 ELSE 0 END) AS n_abnormal
      FROM labs GROUP BY patient_id),
    parts AS (
      SELECT p.*, n_symptoms, n_abnormal,
        CAST(least(30 + CASE WHEN age > 65 THEN 15 WHEN age > 50 THEN 8 ELSE 0 END
          + CASE WHEN bmi > 30 THEN 8 WHEN bmi < 18.5 THEN 6 ELSE 0 END + {_HISTORY}
          + CASE WHEN heart_rate > 100 THEN 8 WHEN heart_rate < 60 THEN 6 ELSE 0 END
          + CASE WHEN systolic_bp > 140 THEN 7 WHEN systolic_bp < 90 THEN 10 ELSE 0 END
          + CASE WHEN temperature > 38.5::DOUBLE THEN 8 WHEN temperature < 36 THEN 6 ELSE 0 END
          + CASE WHEN oxygen_saturation < 90 THEN 15 WHEN oxygen_saturation < 95 THEN 8 ELSE 0 END
          + CASE WHEN respiratory_rate > 20 THEN 6 ELSE 0 END
          + CASE smoking_status WHEN 'Current' THEN 6 WHEN 'Former' THEN 3 ELSE 0 END, 100) AS DOUBLE) AS structured_score,
        CAST(least(25 + coalesce(n_symptoms, 0) * 4.5, 100) AS DOUBLE) AS nlp_score,
        CAST(least(25 + coalesce(n_abnormal, 0) * 6, 100) AS DOUBLE) AS lab_score
      FROM patients p LEFT JOIN load ON p.patient_id = load.patient_id LEFT JOIN abnormal ON p.patient_id = abnormal.patient_id),
    summed AS (
      SELECT *, least((0.30::DOUBLE * structured_score + 0.25::DOUBLE * nlp_score + 0.25::DOUBLE * lab_score) / 0.8::DOUBLE,
        100) AS overall FROM parts)
    SELECT patient_id, structured_score, nlp_score, lab_score, round(overall, 1) AS overall_score,
      CASE WHEN overall >= 75 THEN 'Critical' WHEN overall >= 50 THEN 'High' WHEN overall >= 25 THEN 'Moderate' ELSE 'Low' END AS chart_level,
      array_to_string(list_filter([
        CASE WHEN age > 65 THEN concat('Advanced age (', age, ')') END,
        CASE WHEN bmi > 30 THEN concat('Elevated BMI (', bmi, ')') WHEN bmi < 18.5 THEN concat('Low BMI (', bmi, ')') END,
        {_HISTORY_TEXT},
        CASE WHEN heart_rate > 100 THEN concat('Tachycardia (HR ', heart_rate, ')')
          WHEN heart_rate < 60 THEN concat('Bradycardia (HR ', heart_rate, ')') END,
        CASE WHEN systolic_bp > 140 THEN concat('Hypertensive (SBP ', systolic_bp, ')')
          WHEN systolic_bp < 90 THEN concat('Hypotension (SBP ', systolic_bp, ')') END,
        CASE WHEN temperature > 38.5::DOUBLE THEN concat('Fever (', temperature, ' C)')
          WHEN temperature < 36 THEN concat('Hypothermia (', temperature, ' C)') END,
        CASE WHEN oxygen_saturation < 90 THEN concat('Severe hypoxia (SpO2 ', oxygen_saturation, '%)')
          WHEN oxygen_saturation < 95 THEN concat('Low SpO2 (', oxygen_saturation, '%)') END,
        CASE WHEN respiratory_rate > 20 THEN concat('Tachypnea (RR ', respiratory_rate, ')') END,
        CASE WHEN smoking_status = 'Current' THEN 'Current smoker' END,
        CASE WHEN n_symptoms >= 8 THEN concat('High symptom burden (', n_symptoms, ' symptoms)')
          WHEN n_symptoms >= 5 THEN concat('Moderate symptom burden (', n_symptoms, ' symptoms)') END,
        CASE WHEN n_abnormal >= 4 THEN concat('Multiple abnormal labs (', n_abnormal, ')')
          WHEN n_abnormal >= 2 THEN concat('Abnormal lab values (', n_abnormal, ')') END
      ], lambda x: x IS NOT NULL)[1:8], '|') AS factors
    FROM summed
    """,
)
def risk_chart(v):
    scored = scorecard.chart_risk(v.patients, v.symptoms, v.labs, SYMPTOMS)
    shown = scored.select(
        "patient_id",
        "structured_score",
        "nlp_score",
        "lab_score",
        "overall_score",
        "chart_level",
        joined("factors").alias("factors"),
    )
    return shown


_BATCH = """
  30 + CASE WHEN heart_rate > 100 OR heart_rate < 60 THEN 12 ELSE 0 END
  + CASE WHEN systolic_bp > 140 OR systolic_bp < 90 THEN 10 ELSE 0 END
  + CASE WHEN oxygen_saturation < 95 THEN 15 ELSE 0 END + CASE WHEN temperature > 38.5::DOUBLE THEN 10 ELSE 0 END
  + CASE WHEN age > 65 THEN 10 WHEN age > 50 THEN 5 ELSE 0 END
"""
_BATCH_SCORED = f"""
WITH scored AS (
  SELECT patient_id, greatest(0, least(100, CAST({_BATCH} AS DOUBLE))) AS score FROM patients),
levelled AS (
  SELECT patient_id, round(score, 1) AS risk_score, CASE WHEN score >= 75 THEN 'Critical' WHEN score >= 50 THEN 'High'
    WHEN score >= 25 THEN 'Moderate' ELSE 'Low' END AS risk_level FROM scored)
"""


@query("risk_batch", f"{_BATCH_SCORED} SELECT * FROM levelled")
def risk_batch(v):
    return scorecard.batch_risk(v.patients).select("patient_id", "risk_score", "risk_level")


@query(
    "risk_batch_level_counts",
    f"""{_BATCH_SCORED}
    SELECT position, d.risk_level, count(patient_id) AS n
    FROM (VALUES (0, 'Low'), (1, 'Moderate'), (2, 'High'), (3, 'Critical')) AS d (position, risk_level)
    LEFT JOIN levelled ON d.risk_level = levelled.risk_level GROUP BY position, d.risk_level
    """,
)
def risk_batch_level_counts(v):
    return explore.level_counts(scorecard.batch_risk(v.patients))


@query(
    "dashboard_kpis",
    """
    SELECT count(*) AS n_entities, round(100.0::DOUBLE * sum(CASE WHEN risk_level = 'Critical' THEN 1 ELSE 0 END) / count(*), 1) AS pct_critical,
      round(avg(CASE risk_level WHEN 'Low' THEN 15 WHEN 'Moderate' THEN 40 WHEN 'High' THEN 65 WHEN 'Critical' THEN 85 END), 1) AS mean_risk
    FROM truth
    """,
)
def dashboard_kpis(v):
    return scorecard.dashboard_kpis(v.truth)
