"""Declared schemas of the six source tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from riskframe.functions.presets import SYMPTOMS

STRING, INT, FLOAT, DOUBLE, DATE = StringType(), IntegerType(), FloatType(), DoubleType(), DateType()


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField("patient_id", STRING, False), *[StructField(n, t, True) for n, t in fields]])


SCHEMAS = {
    "patients": _schema(
        ("age", INT), ("sex", STRING), ("bmi", FLOAT), ("smoking_status", STRING), ("diabetes", INT),
        ("hypertension", INT), ("heart_disease_history", INT), ("liver_disease_history", INT),
        ("lung_disease_history", INT), ("systolic_bp", INT), ("diastolic_bp", INT), ("heart_rate", INT),
        ("temperature", FLOAT), ("respiratory_rate", INT), ("oxygen_saturation", INT),
    ),
    "symptoms": _schema(("timestamp", STRING), *[(s, INT) for s in SYMPTOMS], ("primary_diagnosis", STRING)),
    "lab_results": _schema(
        ("test_date", DATE), ("test_name", STRING), ("value", DOUBLE), ("unit", STRING), ("reference_low", DOUBLE),
        ("reference_high", DOUBLE),
    ),
    "clinical_notes": _schema(("note_date", DATE), ("note_type", STRING), ("note_text", STRING)),
    "image_metadata": _schema(
        ("image_id", STRING), ("image_path", STRING), ("modality", STRING), ("body_part", STRING),
        ("finding_label", STRING),
    ),
    "ground_truth": _schema(("final_diagnosis", STRING), ("risk_level", STRING), ("requires_icu", INT)),
}
