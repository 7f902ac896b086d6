"""Latest rows, joins, pivots, set operations and text concatenation."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.presets import SYMPTOMS
from riskframe.operators import clean, integrate, labs
from riskframe.plans.catalog.laboratory import _LATEST, _PIVOT, latest_wide
from riskframe.plans.catalog.registry import query, rounded
from riskframe.plans.views import LAB_TESTS


@query(
    "latest_lab_row",
    """
    SELECT patient_id, test_date, test_name, value, reference_low, reference_high, order_no, line_no FROM (
      SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY test_date DESC, order_no DESC, line_no DESC, test_name DESC) AS rn
      FROM labs) ranked WHERE rn = 1
    """,
)
def latest_lab_row(v):
    return integrate.latest_rows(v.labs, ["patient_id"], "test_date", ("order_no", "line_no", "test_name"))


@query(
    "latest_event_per_user_and_type",
    """
    SELECT user_id, event_type, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) ranked WHERE rn = 1
    """,
)
def latest_event_per_user_and_type(v):
    latest = integrate.latest_rows(v.events, ["user_id", "event_type"], "ts", ("event_id",))
    return latest.select("user_id", "event_type", "event_id", "ts", "value")


_SYM = ", ".join(f"CASE WHEN {s} IN (0, 1) THEN {s} END AS sym_{s}" for s in SYMPTOMS)
_LAB = ", ".join(f"{t} AS lab_{t}, {t}_abnormal AS lab_{t}_abnormal" for t in LAB_TESTS)
_ALL = (
    "patient_id age sex bmi weight height smoking_status diabetes hypertension heart_disease_history "
    "liver_disease_history lung_disease_history systolic_bp diastolic_bp heart_rate temperature respiratory_rate "
    "oxygen_saturation sym_recorded_date sym_primary_diagnosis sym_symptom_count note_note_id note_note_date "
    "note_note_type note_note_text img_image_id img_image_path img_modality img_body_part img_format img_width "
    "img_height img_finding_label img_path_valid img_aspect_ratio gt_final_diagnosis gt_risk_level gt_requires_icu"
).split() + [f"sym_{s}" for s in SYMPTOMS] + [f"lab_{t}{x}" for t in LAB_TESTS for x in ("", "_abnormal")]
_SHOWN = (
    "patient_id age sex sym_symptom_count sym_primary_diagnosis lab_hemoglobin lab_crp_abnormal note_note_id "
    "note_note_date img_image_id img_modality img_path_valid gt_final_diagnosis gt_risk_level data_completeness_score"
).split()


@query(
    "integrate_entities",
    f"""{_LATEST},
    wide AS (SELECT patient_id, {_PIVOT} FROM newest GROUP BY patient_id),
    sym AS (
      SELECT patient_id, recorded_date AS sym_recorded_date, {_SYM}, primary_diagnosis AS sym_primary_diagnosis,
        {" + ".join(f"CASE WHEN {s} = 1 THEN 1 ELSE 0 END" for s in SYMPTOMS)} AS sym_symptom_count FROM symptoms),
    lab AS (SELECT patient_id, {_LAB} FROM wide),
    note AS (
      SELECT patient_id, note_id AS note_note_id, note_date AS note_note_date, note_type AS note_note_type,
        note_text AS note_note_text FROM (
        SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY note_date DESC, note_id DESC) AS rn FROM notes) x
      WHERE rn = 1),
    img AS (
      SELECT patient_id, image_id AS img_image_id, image_path AS img_image_path, upper(trim(modality)) AS img_modality,
        lower(trim(body_part)) AS img_body_part, upper(trim(format)) AS img_format, width AS img_width, height AS img_height,
        finding_label AS img_finding_label, coalesce(length(trim(image_path)) > 0, false) AS img_path_valid,
        CASE WHEN width IS NOT NULL AND height > 0 THEN round(width / height, 2) END AS img_aspect_ratio FROM (
        SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY image_id DESC) AS rn FROM images) x
      WHERE rn = 1),
    gt AS (
      SELECT patient_id, final_diagnosis AS gt_final_diagnosis, risk_level AS gt_risk_level, requires_icu AS gt_requires_icu
      FROM truth),
    unified AS (
      SELECT * FROM patients LEFT JOIN sym USING (patient_id) LEFT JOIN lab USING (patient_id)
        LEFT JOIN note USING (patient_id) LEFT JOIN img USING (patient_id) LEFT JOIN gt USING (patient_id))
    SELECT {", ".join(_SHOWN[:-1])},
      round(({" + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in _ALL)}) / {len(_ALL)}.0, 4)
        AS data_completeness_score
    FROM unified
    """,
)
def integrate_entities(v):
    unified = integrate.integrate_entities(
        v.patients,
        {
            "sym": (clean.clean_symptoms(v.symptoms), None, ()),
            "lab": (latest_wide(v), None, ()),
            "note": (v.notes, "note_date", ("note_id",)),
            "img": (clean.clean_images(v.images), "image_id", ()),
            "gt": (v.truth, None, ()),
        },
    )
    return unified.select(*_SHOWN)


@query(
    "join_entities_with_flags_and_labels",
    """
    SELECT p.patient_id, p.age, p.bmi, s.cough, s.fever, t.final_diagnosis, t.risk_level
    FROM patients p JOIN symptoms s ON p.patient_id = s.patient_id JOIN truth t ON p.patient_id = t.patient_id
    """,
)
def join_entities_with_flags_and_labels(v):
    joined = integrate.join_all([v.patients, v.symptoms, v.truth], ["patient_id"])
    return joined.select("patient_id", "age", "bmi", "cough", "fever", "final_diagnosis", "risk_level")


@query(
    "join_labs_with_labels",
    """
    SELECT l.patient_id, order_no, line_no, test_name, value, final_diagnosis FROM labs l JOIN truth t ON l.patient_id = t.patient_id
    """,
)
def join_labs_with_labels(v):
    joined = integrate.join_all([v.labs, v.truth], ["patient_id"], heavy=True)
    return joined.select("patient_id", "order_no", "line_no", "test_name", "value", "final_diagnosis")


@query(
    "join_notes_with_labels",
    """
    SELECT n.patient_id, note_id, note_type, final_diagnosis FROM notes n JOIN truth t ON n.patient_id = t.patient_id
    WHERE note_text IS NOT NULL
    """,
)
def join_notes_with_labels(v):
    joined = integrate.join_all([clean.drop_missing(v.notes, ["note_text"]), v.truth], ["patient_id"], heavy=True)
    return joined.select("patient_id", "note_id", "note_type", "final_diagnosis")


@query(
    "join_images_with_labels",
    """
    SELECT i.patient_id, image_id, final_diagnosis, quality FROM images i
    LEFT JOIN truth t ON i.patient_id = t.patient_id LEFT JOIN labels d ON i.patient_id = d.doc_id
    """,
)
def join_images_with_labels(v):
    labelled = integrate.with_label(v.images, v.truth)
    quality = v.labels.select(F.col("doc_id").alias("patient_id"), "quality")
    return integrate.with_label(labelled, quality).select("patient_id", "image_id", "final_diagnosis", "quality")


@query(
    "join_feature_tables",
    """
    WITH load AS (SELECT o_custkey AS patient_id, count(*) AS n, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey),
    img AS (SELECT patient_id, count(*) AS n FROM images GROUP BY patient_id)
    SELECT coalesce(load.patient_id, img.patient_id) AS patient_id, coalesce(load.n, 0) AS orders_n,
      coalesce(spent, 0) AS orders_spent, coalesce(img.n, 0) AS images_n
    FROM load FULL JOIN img ON load.patient_id = img.patient_id
    """,
)
def join_feature_tables(v):
    orders = v.orders.groupBy(F.col("o_custkey").alias("patient_id")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("spent")
    )
    images = v.images.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"))
    return integrate.join_features({"orders": orders, "images": images})


@query("ids_kept", "SELECT * FROM truth WHERE patient_id IN (SELECT patient_id FROM images)")
def ids_kept(v):
    return integrate.keep_ids(v.truth, v.images)


@query("ids_dropped", "SELECT * FROM truth WHERE patient_id NOT IN (SELECT patient_id FROM images)")
def ids_dropped(v):
    return integrate.drop_ids(v.truth, v.images)


#: Characters of an entity's texts that one row may hold; longer texts continue in the next part.
PART_CHARS = 1_000_000


def _parts_sql(source: str, key: str, text: str, order: str, label: str = "") -> str:
    """The texts of an entity in order, cut into parts after about ``PART_CHARS`` characters."""
    before = f"sum(length({text}) + 1) OVER (PARTITION BY {key} ORDER BY {order}, {text} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    chosen = f", min({label}) AS {label}" if label else ""
    return f"""
    WITH sized AS (SELECT *, CAST(floor(coalesce({before}, 0) / {PART_CHARS}) AS INT) AS part FROM ({source}) WHERE {text} IS NOT NULL)
    SELECT {key}, part, string_agg({text}, ' ' ORDER BY {order}, {text}) AS {text}{chosen} FROM sized GROUP BY {key}, part
    """


@query(
    "notes_concatenated",
    _parts_sql(
        "SELECT n.*, final_diagnosis FROM notes n JOIN truth t ON n.patient_id = t.patient_id",
        "patient_id", "note_text", "note_date, note_id", "final_diagnosis",
    ),
)
def notes_concatenated(v):
    joined = integrate.join_all([v.notes, v.truth], ["patient_id"], heavy=True)
    return integrate.concat_texts(joined, order=("note_date", "note_id"), label="final_diagnosis", max_chars=PART_CHARS)


@query("conversation_texts", _parts_sql("SELECT conv_id, text, turn, role FROM conversations", "conv_id", "text", "turn, role"))
def conversation_texts(v):
    return integrate.concat_texts(
        v.conversations, "conv_id", "text", ("turn", "role"), bucket=F.floor(F.col("turn") / 100).cast("int"), max_chars=PART_CHARS
    )


@query(
    "patient_chart",
    """
    SELECT 'entity' AS source, patient_id, CAST(NULL AS DATE) AS happened, sex AS detail FROM patients WHERE patient_id = 77
    UNION ALL SELECT 'labs', patient_id, test_date, concat(test_name, ' ', coalesce(is_abnormal, 0)) FROM (
      SELECT *, CASE WHEN value < reference_low OR value > reference_high THEN 1 ELSE 0 END AS is_abnormal FROM labs) l
      WHERE patient_id = 77
    UNION ALL SELECT 'notes', patient_id, note_date, note_type FROM notes WHERE patient_id = 77
    UNION ALL SELECT 'truth', patient_id, NULL, final_diagnosis FROM truth WHERE patient_id = 77
    """,
)
def patient_chart(v):
    measured = v.labs.withColumn("detail", F.concat_ws(" ", "test_name", labs.abnormal_flag().cast("string")))
    chart = integrate.patient_chart(
        v.patients.select("patient_id", F.col("sex").alias("detail")),
        {
            "labs": measured.select("patient_id", F.col("test_date").alias("happened"), "detail"),
            "notes": v.notes.select("patient_id", F.col("note_date").alias("happened"), F.col("note_type").alias("detail")),
            "truth": v.truth.select("patient_id", F.col("final_diagnosis").alias("detail")),
        },
        77,
    )
    rows = integrate.stack([df.withColumn("source", F.lit(name)) for name, df in chart.items()])
    return rows.select("source", "patient_id", "happened", "detail")


@query(
    "cohort_by_label",
    "SELECT *, 0 AS match_rank FROM truth WHERE regexp_matches(lower(final_diagnosis), 'machin') ORDER BY patient_id LIMIT 1",
)
def cohort_by_label(v):
    return integrate.select_cohort(v.truth, "machin")


@query(
    "cohort_by_fallback",
    "SELECT *, 1 AS match_rank FROM truth WHERE lower(risk_level) = 'high' ORDER BY patient_id LIMIT 3",
)
def cohort_by_fallback(v):
    return integrate.select_cohort(v.truth, "pneumonia", n=3)


@query(
    "stack_frames",
    """
    SELECT patient_id, risk_level, final_diagnosis, CAST(NULL AS STRING) AS sex FROM truth WHERE risk_level = 'High'
    UNION ALL SELECT patient_id, risk_level, NULL, NULL FROM truth WHERE risk_level = 'Low'
    UNION ALL SELECT patient_id, NULL, NULL, sex FROM patients WHERE age > 90
    """,
)
def stack_frames(v):
    truth = v.truth
    return integrate.stack(
        [
            truth.filter("risk_level = 'High'").select("patient_id", "risk_level", "final_diagnosis"),
            truth.filter("risk_level = 'Low'").select("patient_id", "risk_level"),
            v.patients.filter("age > 90").select("patient_id", "sex"),
        ]
    )


@query(
    "measurement_rate_by_label",
    """
    SELECT final_diagnosis, test_name, count(*) AS n, round(avg(value), 6) AS mean_value
    FROM labs l LEFT JOIN truth t ON l.patient_id = t.patient_id GROUP BY final_diagnosis, test_name
    """,
)
def measurement_rate_by_label(v):
    joined = integrate.with_label(v.labs, v.truth)
    means = joined.groupBy("final_diagnosis", "test_name").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    return rounded(means, ["mean_value"])
