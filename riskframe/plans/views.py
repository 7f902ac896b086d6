"""Clinical-shaped views of the given tables.

The tables have no clinical columns, so the views derive them by integer arithmetic that Spark SQL and
ANSI SQL evaluate alike. ``VIEW_SQL`` holds the text of each view; the Spark side evaluates the same
text over the parquet tables (only the array syntax differs), whole tables always.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from riskframe.functions.presets import LAB_RANGES, SYMPTOMS

LAB_TESTS = (
    "hemoglobin white_blood_cells platelets glucose_fasting hba1c creatinine blood_urea_nitrogen sodium potassium "
    "calcium alt ast total_bilirubin albumin crp"
).split()
N_CLASSES = 5
MODELS = ("structured", "nlp", "lab", "imaging")

_PATIENTS = """
SELECT c_custkey AS patient_id,
  CASE WHEN c_custkey % 23 <> 0 THEN CAST(1 + (c_custkey * 7) % 95 AS INT) END AS age,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
  CASE WHEN c_custkey % 29 <> 0 THEN CAST(140 + (c_custkey * 13) % 260 AS DOUBLE) / 10 END AS bmi,
  CASE WHEN c_custkey % 31 <> 0 THEN CAST(45 + (c_custkey * 59) % 90 AS DOUBLE) END AS weight,
  CASE WHEN c_custkey % 37 <> 0 THEN CAST(145 + (c_custkey * 61) % 55 AS DOUBLE) END AS height,
  CASE c_custkey % 4 WHEN 0 THEN 'Current' WHEN 1 THEN 'Former' WHEN 2 THEN 'Never' END AS smoking_status,
  CASE WHEN c_custkey % 31 <> 0 THEN CASE WHEN (c_custkey * 11) % 97 < 20 THEN 1 ELSE 0 END END AS diabetes,
  CASE WHEN c_custkey % 43 <> 0 THEN CASE WHEN (c_custkey * 17) % 89 < 30 THEN 1 ELSE 0 END END AS hypertension,
  CASE WHEN (c_custkey * 19) % 83 < 12 THEN 1 ELSE 0 END AS heart_disease_history,
  CASE WHEN (c_custkey * 23) % 79 < 7 THEN 1 ELSE 0 END AS liver_disease_history,
  CASE WHEN (c_custkey * 29) % 73 < 11 THEN 1 ELSE 0 END AS lung_disease_history,
  CASE WHEN c_custkey % 37 <> 0 THEN CAST(60 + (c_custkey * 31) % 160 AS INT) END AS systolic_bp,
  CAST(40 + (c_custkey * 37) % 80 AS INT) AS diastolic_bp,
  CASE WHEN c_custkey % 41 <> 0 THEN CAST(35 + (c_custkey * 43) % 120 AS INT) END AS heart_rate,
  CASE WHEN c_custkey % 47 <> 0 THEN CAST(340 + (c_custkey * 43) % 73 AS DOUBLE) / 10 END AS temperature,
  CASE WHEN c_custkey % 53 <> 0 THEN CAST(6 + (c_custkey * 47) % 32 AS INT) END AS respiratory_rate,
  CASE WHEN c_custkey % 59 <> 0 THEN CAST(80 + (c_custkey * 53) % 22 AS INT) END AS oxygen_saturation
FROM customer
"""

_FLAGS = ",\n  ".join(
    f"CASE WHEN (c_custkey + {i}) % 61 = 0 THEN NULL WHEN (c_custkey + {i}) % 67 = 0 THEN 2 "
    f"WHEN (c_custkey * {2 * i + 3}) % 97 < {8 + i} THEN 1 ELSE 0 END AS {name}"
    for i, name in enumerate(SYMPTOMS)
)
_SYMPTOMS = f"""
SELECT c_custkey AS patient_id,
  DATE '2024-01-01' + CAST((c_custkey * 3) % 365 AS INT) AS recorded_date,
  {_FLAGS},
  c_mktsegment AS primary_diagnosis
FROM customer
"""


def _by_test(values: list[str]) -> str:
    return f"list_extract([{', '.join(values)}], test_no)"


_NAMES = _by_test([f"'{t}'" for t in LAB_TESTS])
_LOWS, _HIGHS = (_by_test([f"CAST({LAB_RANGES[t][side]} AS DOUBLE)" for t in LAB_TESTS]) for side in (0, 1))
_LABS = f"""
SELECT patient_id, test_date, test_name,
  CASE WHEN (l_orderkey + l_linenumber) % 53 <> 0 THEN
    (reference_low + (reference_high - reference_low) * (CAST(position AS DOUBLE) - 50) / 100)
    * CASE WHEN (l_orderkey * 3 + l_partkey) % 101 = 0 THEN 12 ELSE 1 END
  END AS value,
  reference_low, reference_high, l_orderkey AS order_no, l_linenumber AS line_no
FROM (
  SELECT *, {_NAMES} AS test_name, {_LOWS} AS reference_low, {_HIGHS} AS reference_high
  FROM (
    SELECT o_custkey AS patient_id, CAST(l_shipdate AS DATE) AS test_date, CAST(l_partkey % 15 AS INT) + 1 AS test_no,
      (l_partkey * 31 + l_orderkey * 7 + l_linenumber * 13) % 200 AS position,
      l_orderkey, l_partkey, l_linenumber
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  ) named
) ranged
"""

_NOTES = """
SELECT CAST(floor(doc_id / 2) AS BIGINT) AS patient_id, doc_id AS note_id,
  DATE '2024-01-01' + CAST((doc_id * 13) % 365 AS INT) AS note_date,
  lang AS note_type,
  CASE WHEN doc_id % 97 <> 0 THEN text END AS note_text
FROM documents
"""

_TRUTH = """
SELECT c_custkey AS patient_id, c_mktsegment AS final_diagnosis,
  CASE WHEN (c_custkey * 7) % 10 < 4 THEN 'Low' WHEN (c_custkey * 7) % 10 < 7 THEN 'Moderate'
    WHEN (c_custkey * 7) % 10 < 9 THEN 'High' ELSE 'Critical' END AS risk_level,
  CASE WHEN (c_custkey * 7) % 10 = 9 THEN 1 ELSE 0 END AS requires_icu
FROM customer
"""

_IMAGES = """
SELECT vec_id * 3 AS patient_id, concat('IMG-', vec_id) AS image_id,
  CASE WHEN vec_id % 11 = 0 THEN '  ' WHEN vec_id % 13 <> 0 THEN concat('images/', vec_id, '.png') END AS image_path,
  CASE vec_id % 3 WHEN 0 THEN ' xray' WHEN 1 THEN 'CT ' ELSE 'mri' END AS modality,
  CASE vec_id % 2 WHEN 0 THEN ' Chest' ELSE 'HEAD ' END AS body_part,
  CASE vec_id % 2 WHEN 0 THEN ' png' ELSE 'Dicom ' END AS format,
  CASE WHEN vec_id % 19 <> 0 THEN CAST(200 + (vec_id * 7) % 400 AS INT) END AS width,
  CASE WHEN vec_id % 17 = 0 THEN 0 ELSE CAST(201 + (vec_id * 11) % 390 AS INT) END AS height,
  concat('finding ', label) AS finding_label
FROM embeddings
"""

# Five class weights per prediction; the modulus and the factor make the models differ.
_WEIGHTS = ", ".join(
    f"CAST(1 + (o_orderkey * (7 + {2 * j} * model_no + 17 * model_no) + {31 * j}) % (101 - model_no) AS DOUBLE) AS w{j}"
    for j in range(N_CLASSES)
)
_SUM = " + ".join(f"w{j}" for j in range(N_CLASSES))
_TOP = (
    "CASE "
    + " ".join(
        f"WHEN {' AND '.join(f'p{j} >= p{i}' for i in range(N_CLASSES) if i != j)} THEN {j}" for j in range(N_CLASSES)
    )
    + " END"
)
_PREDICTIONS = f"""
SELECT model, patient_id, CAST(CASE WHEN patient_id % 3 <> 0 THEN {_TOP} ELSE (patient_id * 13 + 2) % 5 END AS INT) AS y_true,
  CAST({_TOP} AS INT) AS y_pred, {", ".join(f"p{j}" for j in range(N_CLASSES))}
FROM (
  SELECT model, patient_id, {", ".join(f"w{j} / ({_SUM}) AS p{j}" for j in range(N_CLASSES))}
  FROM (
    SELECT CASE model_no WHEN 1 THEN 'structured' WHEN 2 THEN 'nlp' WHEN 3 THEN 'lab' ELSE 'imaging' END AS model,
      o_orderkey AS patient_id, {_WEIGHTS}
    FROM (SELECT o_orderkey, unnest([1, 2, 3, 4]) AS model_no FROM orders) numbered
  ) weighted
) shared
"""

# The share of modality m of an order: each modality misses some orders.
_MODALITIES = """
SELECT model AS modality, patient_id, p1 AS prob FROM predictions
WHERE (patient_id + CASE model WHEN 'structured' THEN 0 WHEN 'nlp' THEN 1 WHEN 'lab' THEN 2 ELSE 3 END) % 7 <> 0
"""

VIEW_SQL = {
    "patients": _PATIENTS,
    "symptoms": _SYMPTOMS,
    "labs": _LABS,
    "notes": _NOTES,
    "truth": _TRUTH,
    "images": _IMAGES,
    "predictions": _PREDICTIONS,
    "modality_scores": _MODALITIES,
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _mentions(name: str, sql: str) -> bool:
    return re.search(rf"\b{name}\b", sql) is not None


def with_views(body: str) -> str:
    """Prefix a query with the definitions of the views it mentions."""
    needed: list[str] = []

    def visit(sql: str, own: str | None = None) -> None:
        for name, text in VIEW_SQL.items():
            if name != own and name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql, re.I):
                visit(text, name)
                needed.append(name)

    visit(body)
    if not needed:
        return body
    views = ", ".join(f"{name} AS ({VIEW_SQL[name]})" for name in needed)
    head = body.lstrip()
    return f"WITH {views}, {head[5:]}" if head[:5].upper() == "WITH " else f"WITH {views} {head}"


_SPARK_FORMS = (
    (r"unnest\(\[(.*?)\]\)", r"explode(array(\1))"),
    (r"list_extract\(\[(.*?)\], (\w+)\)", r"element_at(array(\1), \2)"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Views:
    """The views over one folder of tables, each a lazy DataFrame.

    ``spread`` deals the rows of every table over that many tasks. It is for files with a single row group,
    which one task would read alone; tables of many files do not need it.
    """

    def __init__(self, spark: SparkSession, folder: str, spread: int | None = None):
        self.spark, self.folder, self.spread = spark, folder.rstrip("/"), spread

    def table(self, name: str) -> DataFrame:
        rows = table(self.spark, self.folder, name)
        return rows.repartition(self.spread) if self.spread else rows

    def view(self, name: str) -> DataFrame:
        sql = with_views(VIEW_SQL[name])
        for pattern, spark_form in _SPARK_FORMS:
            sql = re.sub(pattern, spark_form, sql)
        used = {t: self.table(t) for t in TABLES if _mentions(t, sql)}
        for t in used:
            sql = re.sub(rf"\b(FROM|JOIN)(\s+){t}\b", rf"\1\2{{{t}}}", sql)
        return self.spark.sql(sql, **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEW_SQL:
            return self.view(name)
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    @property
    def scored(self) -> DataFrame:
        """Predictions with the class probabilities as one array."""
        wide = self.view("predictions")
        probs = ", ".join(f"p{j}" for j in range(N_CLASSES))
        return wide.selectExpr("model", "patient_id", "y_true", "y_pred", f"array({probs}) AS prob")
