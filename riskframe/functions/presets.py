"""Default clinical tables. All of them are parameters of the operators that use them."""

from __future__ import annotations

from riskframe.functions.rules import Rules, Scorecard

# --- Fixed values: bands -------------------------------------------------------------------------

AGE_BANDS = Rules(
    (("<", 18, "pediatric"), ("<", 35, "young_adult"), ("<", 50, "middle_aged"), ("<", 65, "senior")), "elderly"
)
BMI_BANDS = Rules((("<", 18.5, "underweight"), ("<", 25.0, "normal"), ("<", 30.0, "overweight")), "obese")

# Risk level from a probability: strict lower edges.
RISK_FROM_PROBABILITY = Rules(((">", 0.75, "Critical"), (">", 0.50, "High"), (">", 0.25, "Moderate")), "Low")
# Risk level from a 0-100 score: inclusive lower edges.
RISK_FROM_SCORE = Rules(((">=", 75, "Critical"), (">=", 50, "High"), (">=", 25, "Moderate")), "Low")
# Risk level from severity points.
RISK_FROM_POINTS = Rules(((">=", 5, "Critical"), (">=", 3, "High"), (">=", 1, "Moderate")), "Low")

RISK_LEVELS = ("Low", "Moderate", "High", "Critical")
LEVEL_SCORES = {"Low": 15, "Moderate": 40, "High": 65, "Critical": 85}

SMOKING_CODES = Rules((("==", "Current", 2.0), ("==", "Former", 1.0)), 0.0)

# --- Fixed values: scorecards --------------------------------------------------------------------

EARLY_WARNING = Scorecard(
    {
        "systolic_bp": Rules((("<=", 70, 3), ("<=", 80, 2), ("<=", 100, 1), ("<=", 199, 0), (">=", 200, 2)), 0),
        "heart_rate": Rules(
            (("<=", 40, 2), ("<=", 50, 1), ("<=", 100, 0), ("<=", 110, 1), ("<=", 129, 2), (">=", 130, 3)), 0
        ),
        "respiratory_rate": Rules((("<", 9, 2), ("<=", 14, 0), ("<=", 20, 1), ("<=", 29, 2), (">=", 30, 3)), 0),
        "temperature": Rules((("<", 35.0, 2), ("<=", 38.4, 0), ("<=", 38.9, 1), (">=", 39.0, 2)), 0),
        "oxygen_saturation": Rules((("<", 85, 3), ("<", 90, 2), ("<", 94, 1), (">=", 94, 0)), 0),
    }
)
SEPSIS_SCREEN = Scorecard(
    {
        "systolic_bp": Rules((("<=", 100, 1),), 0),
        "respiratory_rate": Rules(((">=", 22, 1),), 0),
        "oxygen_saturation": Rules((("<", 90, 1),), 0),
    }
)
SEVERITY_POINTS = Scorecard(
    {
        "oxygen_saturation": Rules((("<", 90, 3), ("<", 94, 2), ("<", 96, 1)), 0),
        "heart_rate": Rules(((">", 120, 2), ("<", 50, 2), (">", 100, 1), ("<", 60, 1)), 0),
        "temperature": Rules(((">", 39.5, 2), (">", 38.5, 1)), 0),
        "age": Rules(((">", 70, 1),), 0),
    }
)
COMORBIDITY_WEIGHTS = {
    "diabetes": 1,
    "hypertension": 1,
    "heart_disease_history": 2,
    "liver_disease_history": 3,
    "lung_disease_history": 1,
}
COMORBIDITIES = tuple(COMORBIDITY_WEIGHTS)

# Heuristic chart score, base 30.
CHART_SCORE = Scorecard(
    {
        "age": Rules(((">", 65, 15.0), (">", 50, 8.0)), 0.0),
        "bmi": Rules(((">", 30, 8.0), ("<", 18.5, 6.0)), 0.0),
        "diabetes": Rules((("==", 1, 5.0),), 0.0),
        "hypertension": Rules((("==", 1, 5.0),), 0.0),
        "heart_disease_history": Rules((("==", 1, 5.0),), 0.0),
        "liver_disease_history": Rules((("==", 1, 5.0),), 0.0),
        "lung_disease_history": Rules((("==", 1, 5.0),), 0.0),
        "heart_rate": Rules(((">", 100, 8.0), ("<", 60, 6.0)), 0.0),
        "systolic_bp": Rules(((">", 140, 7.0), ("<", 90, 10.0)), 0.0),
        "temperature": Rules(((">", 38.5, 8.0), ("<", 36, 6.0)), 0.0),
        "oxygen_saturation": Rules((("<", 90, 15.0), ("<", 95, 8.0)), 0.0),
        "respiratory_rate": Rules(((">", 20, 6.0),), 0.0),
        "smoking_status": Rules((("==", "Current", 6.0), ("==", "Former", 3.0)), 0.0),
    },
    base=30.0,
)
# Heuristic score of an uploaded batch, base 30.
BATCH_SCORE = Scorecard(
    {
        "heart_rate": Rules(((">", 100, 12.0), ("<", 60, 12.0)), 0.0),
        "systolic_bp": Rules(((">", 140, 10.0), ("<", 90, 10.0)), 0.0),
        "oxygen_saturation": Rules((("<", 95, 15.0),), 0.0),
        "temperature": Rules(((">", 38.5, 10.0),), 0.0),
        "age": Rules(((">", 65, 10.0), (">", 50, 5.0)), 0.0),
    },
    base=30.0,
)

# Chart display ranges, inclusive; None means the side is not checked.
VITAL_RANGES = {
    "heart_rate": (60, 100),
    "systolic_bp": (90, 140),
    "diastolic_bp": (60, 90),
    "temperature": (36.0, 38.5),
    "respiratory_rate": (12, 20),
    "oxygen_saturation": (95, None),
}
# Ranges behind the explanation phrases of a prediction.
FACTOR_RANGES = {
    "heart_rate": (60, 100, "Abnormal heart rate"),
    "systolic_bp": (90, 140, "Abnormal blood pressure"),
    "temperature": (36.1, 37.2, "Abnormal temperature"),
    "oxygen_saturation": (95, 100, "Low oxygen saturation"),
    "respiratory_rate": (12, 20, "Abnormal respiratory rate"),
}
FACTOR_FLAGS = (
    "fever",
    "cough",
    "shortness_of_breath",
    "chest_pain",
    "fatigue",
    "night_sweats",
    "weight_loss",
)

# --- Fixed values: symptoms ----------------------------------------------------------------------

SYMPTOMS = [
    "cough", "fever", "chest_pain", "shortness_of_breath", "fatigue", "nausea", "vomiting", "abdominal_pain",
    "headache", "dizziness", "weight_loss", "night_sweats", "joint_pain", "swelling", "jaundice", "dark_urine",
    "loss_of_appetite", "excessive_thirst", "frequent_urination", "blurred_vision", "palpitations", "wheezing",
    "sputum_production", "hemoptysis", "edema", "confusion", "muscle_weakness", "numbness", "skin_rash",
]
SYMPTOM_CLUSTERS = {
    "respiratory_cluster": ["cough", "wheezing", "shortness_of_breath", "sputum_production"],
    "cardiac_cluster": ["chest_pain", "palpitations", "edema"],
    "gi_cluster": ["nausea", "vomiting", "abdominal_pain"],
    "metabolic_cluster": ["excessive_thirst", "frequent_urination", "weight_loss"],
}
ORGAN_SYSTEMS = {
    "respiratory": ["cough", "shortness_of_breath", "wheezing", "sputum_production", "hemoptysis"],
    "cardiovascular": ["chest_pain", "palpitations", "edema", "syncope", "orthopnea"],
    "gastrointestinal": ["nausea", "vomiting", "abdominal_pain", "diarrhea", "constipation"],
    "neurological": ["headache", "dizziness", "seizure", "confusion", "numbness"],
    "musculoskeletal": ["joint_pain", "muscle_weakness", "back_pain", "swelling"],
    "systemic": ["fever", "fatigue", "weight_loss", "night_sweats", "malaise"],
    "metabolic": ["excessive_thirst", "frequent_urination", "blurred_vision"],
}
SYMPTOM_SYSTEM = {symptom: system for system, names in ORGAN_SYSTEMS.items() for symptom in names}

CLASS_LABELS = {
    0: "Respiratory Disease",
    1: "Cardiovascular Disease",
    2: "Metabolic / Endocrine Disorder",
    3: "Gastrointestinal Disorder",
    4: "Neurological Disorder",
}
SEVERE_CLASSES = (1, 4)

# --- Fixed values: laboratory tests --------------------------------------------------------------

LAB_RANGES = {
    "hemoglobin": (12.0, 17.5),
    "white_blood_cells": (4.5, 11.0),
    "platelets": (150.0, 400.0),
    "hematocrit": (36.0, 50.0),
    "glucose_fasting": (70.0, 100.0),
    "hba1c": (4.0, 5.6),
    "sodium": (136.0, 145.0),
    "potassium": (3.5, 5.0),
    "calcium": (8.5, 10.5),
    "chloride": (98.0, 106.0),
    "bicarbonate": (22.0, 29.0),
    "creatinine": (0.6, 1.2),
    "blood_urea_nitrogen": (7.0, 20.0),
    "alt": (7.0, 56.0),
    "ast": (10.0, 40.0),
    "total_bilirubin": (0.1, 1.2),
    "albumin": (3.5, 5.5),
    "alkaline_phosphatase": (44.0, 147.0),
    "crp": (0.0, 3.0),
    "esr": (0.0, 20.0),
    "total_cholesterol": (0.0, 200.0),
    "ldl": (0.0, 100.0),
    "hdl": (40.0, 60.0),
    "triglycerides": (0.0, 150.0),
    "tsh": (0.4, 4.0),
}
LAB_CRITICAL = {
    "hemoglobin": (7.0, 20.0),
    "white_blood_cells": (2.0, 30.0),
    "platelets": (50.0, 1000.0),
    "glucose_fasting": (40.0, 400.0),
    "sodium": (120.0, 160.0),
    "potassium": (2.5, 6.5),
    "creatinine": (0.0, 10.0),
    "blood_urea_nitrogen": (0.0, 100.0),
    "alt": (0.0, 1000.0),
    "ast": (0.0, 1000.0),
    "total_bilirubin": (0.0, 10.0),
    "crp": (0.0, 100.0),
    "hba1c": (0.0, 14.0),
}
LAB_PANELS = {
    "liver_panel_score": ["alt", "ast", "total_bilirubin", "albumin"],
    "renal_panel_score": ["creatinine", "blood_urea_nitrogen"],
    "metabolic_panel_score": ["glucose_fasting", "hba1c"],
    "inflammatory_score": ["white_blood_cells", "crp"],
}
# (test, sex or None, low, high, critical low, critical high, unit)
RANGE_DIMENSION = (
    ("hemoglobin", "M", 13.5, 17.5, 7.0, 20.0, "g/dL"),
    ("hemoglobin", "F", 12.0, 16.0, 7.0, 20.0, "g/dL"),
    ("white_blood_cells", None, 4.5, 11.0, 2.0, 30.0, "x10^3/uL"),
    ("platelets", None, 150.0, 400.0, 50.0, 1000.0, "x10^3/uL"),
    ("glucose_fasting", None, 70.0, 100.0, 40.0, 500.0, "mg/dL"),
    ("hba1c", None, 4.0, 5.6, 3.0, 15.0, "%"),
    ("creatinine", "M", 0.7, 1.3, 0.4, 10.0, "mg/dL"),
    ("creatinine", "F", 0.6, 1.1, 0.4, 10.0, "mg/dL"),
    ("blood_urea_nitrogen", None, 7.0, 20.0, 2.0, 100.0, "mg/dL"),
    ("sodium", None, 136.0, 145.0, 120.0, 160.0, "mEq/L"),
    ("potassium", None, 3.5, 5.0, 2.5, 6.5, "mEq/L"),
    ("chloride", None, 98.0, 106.0, 80.0, 120.0, "mEq/L"),
    ("calcium", None, 8.5, 10.5, 6.0, 13.0, "mg/dL"),
    ("alt", None, 7.0, 56.0, 0.0, 1000.0, "U/L"),
    ("ast", None, 10.0, 40.0, 0.0, 1000.0, "U/L"),
    ("total_bilirubin", None, 0.1, 1.2, 0.0, 15.0, "mg/dL"),
    ("albumin", None, 3.5, 5.5, 1.5, 6.0, "g/dL"),
    ("total_cholesterol", None, 0.0, 200.0, 0.0, 500.0, "mg/dL"),
    ("hdl", None, 40.0, 60.0, 20.0, 100.0, "mg/dL"),
    ("ldl", None, 0.0, 100.0, 0.0, 300.0, "mg/dL"),
    ("triglycerides", None, 0.0, 150.0, 0.0, 500.0, "mg/dL"),
    ("crp", None, 0.0, 3.0, 0.0, 200.0, "mg/L"),
    ("tsh", None, 0.4, 4.0, 0.01, 100.0, "mIU/L"),
)

# --- Fixed values: fusion ------------------------------------------------------------------------

MODALITY_WEIGHTS = {"structured": 0.30, "nlp": 0.25, "lab": 0.25, "imaging": 0.20}

# --- Fixed values: recommended actions -----------------------------------------------------------

SCORING_ACTIONS = {
    "Critical": [
        "URGENT: Immediate physician review required",
        "Consider ICU admission or rapid response team",
    ],
    "High": ["Schedule priority follow-up within 24 hours", "Order additional confirmatory diagnostics"],
    "Medium": ["Schedule routine follow-up within 1 week", "Monitor vital signs closely"],
    "Low": ["Continue current management plan", "Routine follow-up as scheduled"],
}
SCORING_FACTOR_ACTIONS = {
    "oxygen": "Assess respiratory function; consider ABG / pulse oximetry",
    "chest pain": "Obtain ECG and cardiac biomarkers",
}
FUSION_ACTIONS = {
    "Critical": [
        "URGENT: Immediate physician review required.",
        "Activate rapid response team for clinical assessment.",
        "Schedule emergency diagnostic workup within 1 hour.",
        "Notify attending physician and on-call specialist.",
        "Prepare for potential ICU admission.",
    ],
    "High": [
        "Priority physician review within 4 hours.",
        "Order comprehensive diagnostic panel.",
        "Increase monitoring frequency to every 2 hours.",
        "Schedule specialist consultation within 24 hours.",
        "Review and update current treatment plan.",
    ],
    "Moderate": [
        "Schedule physician review within 24 hours.",
        "Order follow-up lab tests for abnormal values.",
        "Continue standard monitoring protocol.",
        "Consider preventive interventions.",
        "Schedule follow-up appointment within 1 week.",
    ],
    "Low": [
        "Continue routine monitoring schedule.",
        "Maintain current care plan.",
        "Schedule standard follow-up as per protocol.",
        "Educate patient on warning signs to watch for.",
    ],
}
FUSION_FACTOR_HEADER = "--- Key Contributing Factors ---"
FUSION_FACTOR_ACTIONS = {
    "structured": "Review structured clinical data and vital signs trend.",
    "nlp": "Review clinical notes for context on flagged conditions.",
    "lab": "Prioritize review of abnormal lab values and repeat critical tests.",
    "imaging": "Review imaging findings and consider additional imaging if indicated.",
}
CHART_ACTIONS = {
    "Critical": [
        "Escalate to attending physician immediately",
        "Consider ICU admission",
        "Continuous vital sign monitoring",
        "Stat labs and imaging",
        "Initiate rapid response protocol",
    ],
    "High": [
        "Notify attending physician within 1 hour",
        "Increase monitoring frequency to q2h",
        "Review and optimize current treatment plan",
        "Consider specialist consultation",
        "Repeat labs in 6 hours",
    ],
    "Moderate": [
        "Continue current monitoring schedule (q4h)",
        "Review lab trends at next rounding",
        "Ensure follow-up appointments scheduled",
        "Patient education on warning signs",
    ],
    "Low": [
        "Continue routine monitoring",
        "Standard follow-up in 2 weeks",
        "Reinforce preventive care and lifestyle modifications",
    ],
}
