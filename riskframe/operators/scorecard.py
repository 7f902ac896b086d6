"""Scores and features of the entity table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.presets import (
    BATCH_SCORE,
    CHART_SCORE,
    COMORBIDITIES,
    COMORBIDITY_WEIGHTS,
    EARLY_WARNING,
    LEVEL_SCORES,
    MODALITY_WEIGHTS,
    RISK_FROM_POINTS,
    RISK_FROM_SCORE,
    SEPSIS_SCREEN,
    SEVERITY_POINTS,
    SYMPTOM_CLUSTERS,
)
from riskframe.functions.rules import Scorecard, clamp, flag_sum, weighted_sum
from riskframe.operators.clean import require, smoking_code


def with_vital_scores(df: DataFrame) -> DataFrame:
    """``mews_score`` and ``qsofa_score``; a NULL vital adds 0 points."""
    require(df, list(EARLY_WARNING.parts))
    return df.withColumns(
        {"mews_score": EARLY_WARNING.total().cast("int"), "qsofa_score": SEPSIS_SCREEN.total().cast("int")}
    )


def with_comorbidity_index(df: DataFrame, weights: dict[str, int] = COMORBIDITY_WEIGHTS) -> DataFrame:
    require(df, list(weights))
    return df.withColumn("comorbidity_index", weighted_sum(weights).cast("int"))


def with_interactions(df: DataFrame) -> DataFrame:
    """Five products; NULL inputs give NULL, except a NULL diabetes flag, which counts 0."""
    def number(name: str) -> Column:
        return F.col(name).cast("double")

    return df.withColumns(
        {
            "age_bmi_interaction": number("age") * number("bmi"),
            "smoking_comorbidity_interaction": smoking_code("smoking_status") * number("comorbidity_index"),
            "bp_heart_rate_interaction": number("systolic_bp") * number("heart_rate"),
            "age_comorbidity_interaction": number("age") * number("comorbidity_index"),
            "bmi_diabetes_interaction": number("bmi") * F.coalesce(number("diabetes"), F.lit(0.0)),
        }
    )


def with_symptom_clusters(df: DataFrame, clusters: dict[str, list[str]] = SYMPTOM_CLUSTERS) -> DataFrame:
    require(df, [flag for flags in clusters.values() for flag in flags])
    return df.withColumns({name: flag_sum(flags).cast("int") for name, flags in clusters.items()})


def with_severity_level(
    df: DataFrame,
    label: str = "final_diagnosis",
    healthy: str = "Healthy",
    points: Scorecard = SEVERITY_POINTS,
) -> DataFrame:
    """Severity points, risk level and the ICU flag (Critical)."""
    is_healthy = F.coalesce(F.col(label) == F.lit(healthy), F.lit(False))
    score = F.when(is_healthy, F.lit(0)).otherwise(points.total()).cast("int")
    level = RISK_FROM_POINTS.on("severity_points")
    icu = F.col("severity_level") == "Critical"
    return (
        df.withColumn("severity_points", score).withColumn("severity_level", level).withColumn("needs_icu", icu.cast("int"))
    )


def _chart_factors() -> list[Column]:
    """Factor phrases of the chart score in their fixed order; NULL where a factor does not apply."""

    def when(condition: Column, template: str, *values: Column) -> Column:
        return F.when(condition, F.format_string(template, *values) if values else F.lit(template))

    def either(*choices: Column) -> Column:
        return F.coalesce(*choices)

    def whole(name: str) -> Column:
        return F.col(name).cast("long")  # imputed columns are doubles

    c = F.col
    return [
        when(c("age") > 65, "Advanced age (%d)", whole("age")),
        either(
            when(c("bmi") > 30, "Elevated BMI (%.1f)", c("bmi").cast("double")),
            when(c("bmi") < 18.5, "Low BMI (%.1f)", c("bmi").cast("double")),
        ),
        *[when(c(f) == 1, f"History: {f.replace('_', ' ').title()}") for f in COMORBIDITIES],
        either(
            when(c("heart_rate") > 100, "Tachycardia (HR %d)", whole("heart_rate")),
            when(c("heart_rate") < 60, "Bradycardia (HR %d)", whole("heart_rate")),
        ),
        either(
            when(c("systolic_bp") > 140, "Hypertensive (SBP %d)", whole("systolic_bp")),
            when(c("systolic_bp") < 90, "Hypotension (SBP %d)", whole("systolic_bp")),
        ),
        either(
            when(c("temperature") > 38.5, "Fever (%.1f C)", c("temperature").cast("double")),
            when(c("temperature") < 36, "Hypothermia (%.1f C)", c("temperature").cast("double")),
        ),
        either(
            when(c("oxygen_saturation") < 90, "Severe hypoxia (SpO2 %d%%)", whole("oxygen_saturation")),
            when(c("oxygen_saturation") < 95, "Low SpO2 (%d%%)", whole("oxygen_saturation")),
        ),
        when(c("respiratory_rate") > 20, "Tachypnea (RR %d)", whole("respiratory_rate")),
        when(c("smoking_status") == "Current", "Current smoker"),
        either(
            when(c("n_symptoms") >= 8, "High symptom burden (%d symptoms)", c("n_symptoms")),
            when(c("n_symptoms") >= 5, "Moderate symptom burden (%d symptoms)", c("n_symptoms")),
        ),
        either(
            when(c("n_abnormal") >= 4, "Multiple abnormal labs (%d)", c("n_abnormal")),
            when(c("n_abnormal") >= 2, "Abnormal lab values (%d)", c("n_abnormal")),
        ),
    ]


def chart_risk(
    patients: DataFrame,
    symptoms: DataFrame,
    labs: DataFrame,
    flags: list[str],
    key: str = "patient_id",
    max_factors: int = 8,
) -> DataFrame:
    """Heuristic risk of every entity from vitals, symptom load and abnormal measurements.

    Adds the scores of the three modalities that have data (0-100), ``overall_score`` (their weighted mean),
    ``chart_level`` and ``factors``. Scores have one digit; the level is taken before rounding.
    """
    counted = symptoms.select(key, flag_sum(flags).cast("long").alias("n_symptoms"))
    outside = F.coalesce(
        (F.col("value") < F.col("reference_low")) | (F.col("value") > F.col("reference_high")), F.lit(False)
    )
    abnormal = labs.groupBy(key).agg(F.sum(outside.cast("long")).alias("n_abnormal"))
    joined = patients.join(counted, key, "left").join(abnormal, key, "left")
    scores = joined.withColumns(
        {
            "structured_score": F.least(CHART_SCORE.total(), F.lit(100.0)),
            "nlp_score": F.least(F.lit(25.0) + F.coalesce("n_symptoms", F.lit(0)) * 4.5, F.lit(100.0)),
            "lab_score": F.least(F.lit(25.0) + F.coalesce("n_abnormal", F.lit(0)) * 6.0, F.lit(100.0)),
        }
    )
    used = {m: w for m, w in MODALITY_WEIGHTS.items() if f"{m}_score" in scores.columns}
    overall = sum((F.col(f"{m}_score") * F.lit(w) for m, w in used.items()), F.lit(0.0)) / F.lit(sum(used.values()))
    return scores.withColumn("_overall", F.least(overall, F.lit(100.0))).withColumns(
        {
            "chart_level": RISK_FROM_SCORE.on("_overall"),
            **{f"{m}_score": F.round(f"{m}_score", 1) for m in used},
            "overall_score": F.round("_overall", 1),
            "factors": F.slice(F.filter(F.array(*_chart_factors()), lambda x: x.isNotNull()), 1, max_factors),
        }
    ).drop("_overall")


def batch_risk(df: DataFrame, card: Scorecard = BATCH_SCORE) -> DataFrame:
    """Heuristic score (one digit) and level of an uploaded batch; inputs that have no column add nothing."""
    present = {name: rules for name, rules in card.parts.items() if name in df.columns}
    score = clamp(Scorecard(present, card.base, card.inputs).total().cast("double"), 0.0, 100.0)
    scored = df.withColumn("_score", score).withColumn("risk_level", RISK_FROM_SCORE.on("_score"))
    return scored.withColumn("risk_score", F.round("_score", 1)).drop("_score")


def dashboard_kpis(truth: DataFrame, level: str = "risk_level") -> DataFrame:
    """Entity count, percentage of Critical and mean mapped risk, rounded to one digit."""
    entries = [F.lit(x) for pair in LEVEL_SCORES.items() for x in pair]
    mapped = F.create_map(*entries)[F.col(level)]
    critical = F.sum((F.col(level) == "Critical").cast("int"))
    return truth.agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.round(F.try_divide(critical * 100.0, F.count(F.lit(1))), 1).alias("pct_critical"),
        F.round(F.avg(mapped), 1).alias("mean_risk"),
    )
