"""Profiling and row-wise cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.presets import COMORBIDITIES, SYMPTOM_SYSTEM, SYMPTOMS, VITAL_RANGES
from riskframe.functions.rules import Rules, clamp
from riskframe.operators import clean, profile
from riskframe.plans.catalog.registry import joined, query, rounded

_COLUMNS = {
    "patient_id": "bigint", "age": "int", "sex": "string", "bmi": "double", "weight": "double", "height": "double",
    "smoking_status": "string", "diabetes": "int", "hypertension": "int", "heart_disease_history": "int",
    "liver_disease_history": "int", "lung_disease_history": "int", "systolic_bp": "int", "diastolic_bp": "int",
    "heart_rate": "int", "temperature": "double", "respiratory_rate": "int", "oxygen_saturation": "int",
}

_NULL_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, "
    f"count(*) - count({c}) AS n_null, round((count(*) - count({c})) / count(*) * 100, 6) AS pct_null FROM patients"
    for i, (c, t) in enumerate(_COLUMNS.items())
)


@query("profile_nulls", _NULL_ROWS)
def profile_nulls(v):
    return rounded(profile.null_profile(v.patients).drop("nullable"), ["pct_null"])


@query(
    "profile_row_counts",
    """
    SELECT 'patients' AS table_name, count(*) AS n_rows, 18 AS n_columns FROM patients
    UNION ALL SELECT 'symptoms', count(*), 32 FROM symptoms
    UNION ALL SELECT 'labs', count(*), 8 FROM labs
    UNION ALL SELECT 'notes', count(*), 5 FROM notes
    UNION ALL SELECT 'images', count(*), 9 FROM images
    UNION ALL SELECT 'truth', count(*), 4 FROM truth
    """,
)
def profile_row_counts(v):
    return profile.row_counts({n: v.view(n) for n in ("patients", "symptoms", "labs", "notes", "images", "truth")})


_FILLED = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in _COLUMNS)


@query("profile_completeness", f"SELECT patient_id, round(({_FILLED}) / 18.0, 4) AS data_completeness_score FROM patients")
def profile_completeness(v):
    return profile.with_completeness(v.patients).select("patient_id", "data_completeness_score")


_NUMERIC = [c for c, t in _COLUMNS.items() if t != "string" and c != "patient_id"]


@query(
    "profile_numeric_columns",
    "SELECT count(*) AS n, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in _NUMERIC) + " FROM patients",
)
def profile_numeric_columns(v):
    df = v.patients
    names = profile.numeric_columns(df)
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(c), 6).alias(c) for c in names])


_IMPUTED = ", ".join(
    f"(SELECT quantile_disc({c}, 0.5) FROM patients WHERE {c} IS NOT NULL) AS m_{c}"
    for c in ("age", "weight", "height", "bmi")
)


@query(
    "clean_patients",
    f"""
    WITH medians AS (SELECT {_IMPUTED}),
    filled AS (
      SELECT patient_id, CAST(coalesce(age, m_age) AS INT) AS age, coalesce(weight, CAST(m_weight AS DOUBLE)) AS weight,
        coalesce(height, CAST(m_height AS DOUBLE)) AS height, coalesce(bmi, CAST(m_bmi AS DOUBLE)) AS bmi
      FROM patients, medians)
    SELECT *,
      CASE WHEN age < 18 THEN 'pediatric' WHEN age < 35 THEN 'young_adult' WHEN age < 50 THEN 'middle_aged'
        WHEN age < 65 THEN 'senior' ELSE 'elderly' END AS age_group,
      CASE WHEN bmi < 18.5 THEN 'underweight' WHEN bmi < 25 THEN 'normal' WHEN bmi < 30 THEN 'overweight'
        ELSE 'obese' END AS bmi_category
    FROM filled
    """,
)
def clean_patients(v):
    return clean.clean_patients(v.patients).select(
        "patient_id", "age", "weight", "height", "bmi", "age_group", "bmi_category"
    )


@query(
    "clean_constant_fill",
    """
    SELECT patient_id, coalesce(smoking_status, 'Unknown') AS smoking_status, coalesce(diabetes, 0) AS diabetes,
      coalesce(hypertension, 0) AS hypertension FROM patients
    """,
)
def clean_constant_fill(v):
    filled = clean.fill_constants(v.patients, {"smoking_status": "Unknown", "diabetes": 0, "hypertension": 0})
    return filled.select("patient_id", "smoking_status", "diabetes", "hypertension")


_VALID = ", ".join(f"CASE WHEN {s} IN (0, 1) THEN {s} END AS {s}" for s in SYMPTOMS)
_COUNT = " + ".join(f"CASE WHEN {s} = 1 THEN 1 ELSE 0 END" for s in SYMPTOMS)


@query(
    "clean_symptoms",
    f"SELECT patient_id, recorded_date, {_VALID}, primary_diagnosis, {_COUNT} AS symptom_count FROM symptoms",
)
def clean_symptoms(v):
    return clean.clean_symptoms(v.symptoms)


@query(
    "clean_images",
    """
    SELECT patient_id, image_id, image_path, upper(trim(modality)) AS modality, lower(trim(body_part)) AS body_part,
      upper(trim(format)) AS format, width, height, finding_label,
      coalesce(length(trim(image_path)) > 0, false) AS path_valid,
      CASE WHEN width IS NOT NULL AND height > 0
        THEN CAST(round(CAST(CAST(width AS DOUBLE) / height AS DECIMAL(18, 8)), 2) AS DOUBLE) END AS aspect_ratio
    FROM images
    """,
)
def clean_images(v):
    return clean.clean_images(v.images)


@query(
    "clean_drop_missing",
    "SELECT patient_id, age, bmi, heart_rate FROM patients WHERE age IS NOT NULL AND bmi IS NOT NULL AND heart_rate IS NOT NULL",
)
def clean_drop_missing(v):
    return clean.drop_missing(v.patients, ["age", "bmi", "heart_rate"]).select("patient_id", "age", "bmi", "heart_rate")


@query(
    "clean_prefix_columns",
    "SELECT patient_id, final_diagnosis AS gt_final_diagnosis, risk_level AS gt_risk_level, requires_icu AS gt_requires_icu FROM truth",
)
def clean_prefix_columns(v):
    return clean.prefix_columns(v.truth, "gt")


@query(
    "clean_class_labels",
    """
    SELECT model, patient_id, CASE y_pred + patient_id % 2 WHEN 0 THEN 'Respiratory Disease' WHEN 1 THEN 'Cardiovascular Disease'
      WHEN 2 THEN 'Metabolic / Endocrine Disorder' WHEN 3 THEN 'Gastrointestinal Disorder'
      WHEN 4 THEN 'Neurological Disorder' ELSE concat('Class ', y_pred + patient_id % 2) END AS diagnosis
    FROM predictions
    """,
)
def clean_class_labels(v):
    from riskframe.functions.presets import CLASS_LABELS

    return v.predictions.select("model", "patient_id", clean.decode(F.col("y_pred") + F.col("patient_id") % 2, CLASS_LABELS).alias("diagnosis"))


_SYSTEM_ROWS = " UNION ALL ".join(
    f"SELECT patient_id, '{SYMPTOM_SYSTEM[s]}' AS organ_system, coalesce({s}, 0) AS f FROM symptoms"
    for s in SYMPTOMS
    if s in SYMPTOM_SYSTEM
)


@query(
    "clean_organ_systems",
    f"""
    SELECT patient_id, organ_system, CAST(sum(f) AS BIGINT) AS n_symptoms FROM ({_SYSTEM_ROWS}) flags
    GROUP BY patient_id, organ_system
    """,
)
def clean_organ_systems(v):
    return clean.organ_system_counts(v.symptoms, SYMPTOMS)


@query(
    "clean_smoking_code",
    "SELECT patient_id, CAST(CASE smoking_status WHEN 'Current' THEN 2 WHEN 'Former' THEN 1 ELSE 0 END AS DOUBLE) AS smoking_code FROM patients",
)
def clean_smoking_code(v):
    return v.patients.select("patient_id", clean.smoking_code("smoking_status").alias("smoking_code"))


@query(
    "clean_excerpt",
    """
    SELECT note_id, CASE WHEN length(note_text) > 300 THEN concat(substr(note_text, 1, 300), '...') ELSE note_text END AS excerpt
    FROM notes
    """,
)
def clean_excerpt(v):
    return v.notes.select("note_id", clean.excerpt("note_text").alias("excerpt"))


_ACTIVE = ", ".join(f"CASE WHEN {c} = 1 THEN '{c.replace('_', ' ').title()}' END" for c in COMORBIDITIES)
_SHOWN = ", ".join(f"CASE WHEN {s} = 1 THEN '{s}' END" for s in SYMPTOMS)


@query(
    "clean_active_flags",
    f"""
    SELECT p.patient_id, array_to_string(list_filter([{_ACTIVE}], lambda x: x IS NOT NULL), '|') AS comorbidities,
      array_to_string(list_filter([{_SHOWN}], lambda x: x IS NOT NULL), '|') AS symptoms
    FROM patients p JOIN symptoms s ON p.patient_id = s.patient_id
    """,
)
def clean_active_flags(v):
    return v.patients.join(v.symptoms, "patient_id").select(
        "patient_id",
        joined(clean.active_flags(COMORBIDITIES, title=True)).alias("comorbidities"),
        joined(clean.active_flags(SYMPTOMS)).alias("symptoms"),
    )


@query(
    "clean_label_index",
    """
    SELECT patient_id, final_diagnosis, CAST(dense_rank() OVER (ORDER BY final_diagnosis) - 1 AS INT) AS label_index
    FROM truth
    """,
)
def clean_label_index(v):
    return clean.index_labels(v.truth.select("patient_id", "final_diagnosis"), "final_diagnosis")


@query(
    "clean_clamp_and_convert",
    """
    SELECT patient_id, CASE WHEN heart_rate IS NOT NULL THEN greatest(50, least(110, heart_rate)) END AS heart_rate,
      CAST(round(CAST(temperature * 9.0 / 5.0 + 32.0 AS DECIMAL(18, 8)), 1) AS DOUBLE) AS temperature_f
    FROM patients
    """,
)
def clean_clamp_and_convert(v):
    return v.patients.select(
        "patient_id", clamp("heart_rate", 50, 110).alias("heart_rate"), clean.fahrenheit("temperature").alias("temperature_f")
    )


_STATUS = ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN CASE WHEN {c} < {lo}{f' OR {c} > {hi}' if hi is not None else ''} "
    f"THEN 'Abnormal' ELSE 'Normal' END END AS {c}_status"
    for c, (lo, hi) in VITAL_RANGES.items()
)
_ABNORMAL = ", ".join(
    f"CASE WHEN {c} < {lo}{f' OR {c} > {hi}' if hi is not None else ''} THEN '{c}' END"
    for c, (lo, hi) in VITAL_RANGES.items()
)


@query(
    "clean_vital_status",
    f"""
    SELECT patient_id, {_STATUS},
      array_to_string(list_filter([{_ABNORMAL}], lambda x: x IS NOT NULL), '|') AS abnormal_vitals
    FROM patients
    """,
)
def clean_vital_status(v):
    marked = clean.vital_status(v.patients)
    return marked.select("patient_id", *[f"{c}_status" for c in VITAL_RANGES], joined("abnormal_vitals").alias("abnormal_vitals"))


@query(
    "clean_value_bands",
    """
    SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium'
      ELSE 'large' END AS price_band FROM orders
    """,
)
def clean_value_bands(v):
    bands = Rules((("<", 100000, "small"), ("<", 300000, "medium")), "large")
    banded = clean.band_columns(v.orders, {"price_band": ("o_totalprice", bands)})
    return banded.select("o_orderkey", "price_band")
