"""Fusion of modality predictions, explanations and actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.presets import (
    CHART_ACTIONS,
    CLASS_LABELS,
    FUSION_ACTIONS,
    FUSION_FACTOR_ACTIONS,
    FUSION_FACTOR_HEADER,
    MODALITY_WEIGHTS,
    SCORING_ACTIONS,
    SYMPTOMS,
)
from riskframe.operators import clean, fusion
from riskframe.plans.catalog.registry import joined, query, rounded
from riskframe.plans.views import MODELS, N_CLASSES

_COLLECTED = (
    "WITH collected AS (SELECT patient_id, "
    + ", ".join(f"coalesce(max(CASE WHEN modality = '{m}' THEN prob END), 0.5::DOUBLE) AS {m}_prob" for m in MODELS)
    + " FROM modality_scores GROUP BY patient_id)"
)
_FUSED = " + ".join(f"{w}::DOUBLE * {m}_prob" for m, w in MODALITY_WEIGHTS.items())
_CATEGORY = "CASE WHEN f > 0.75 THEN 'Critical' WHEN f > 0.5 THEN 'High' WHEN f > 0.25 THEN 'Moderate' ELSE 'Low' END"


def collected(v):
    return fusion.collect_long(v.modality_scores, "prob")


@query("fusion_collect_modalities", f"{_COLLECTED} SELECT * FROM collected")
def fusion_collect_modalities(v):
    return collected(v)


@query(
    "fusion_weighted",
    f"""{_COLLECTED}, fused AS (SELECT *, {_FUSED} AS f FROM collected)
    SELECT patient_id, round(f, 9) AS fused_probability, {_CATEGORY} AS risk_category,
      {", ".join(f"round({m}_prob * {w}::DOUBLE / greatest(f, 1e-8), 9) AS {m}_contribution" for m, w in MODALITY_WEIGHTS.items())}
    FROM fused
    """,
)
def fusion_weighted(v):
    fused = fusion.with_contributions(fusion.weighted_fusion(collected(v)))
    parts = [f"{m}_contribution" for m in MODALITY_WEIGHTS]
    return rounded(fused.select("patient_id", "fused_probability", "risk_category", *parts), ["fused_probability", *parts], 9)


@query(
    "explain_by_weights",
    f"{_COLLECTED} "
    + " UNION ALL ".join(
        f"SELECT patient_id, '{m}' AS modality, {w}::DOUBLE AS weight, {m}_prob AS feature_value, "
        f"{m}_prob * {w}::DOUBLE AS weighted_contribution FROM collected"
        for m, w in MODALITY_WEIGHTS.items()
    ),
)
def explain_by_weights(v):
    return fusion.explain_weights(collected(v))


_COEFFICIENTS = {"structured_prob": 1.5, "nlp_prob": -0.75, "lab_prob": 0.5, "imaging_prob": 0.25}


@query(
    "explain_linear",
    f"{_COLLECTED} "
    + " UNION ALL ".join(
        f"SELECT patient_id, '{c}' AS feature, {c} AS feature_value, "
        f"round(({c} - (SELECT avg({c}) FROM collected)) * {w}, 8) AS attribution, "
        f"CASE WHEN round(({c} - (SELECT avg({c}) FROM collected)) * {w}, 8) > 0 THEN 'positive' ELSE 'negative' END AS contribution "
        "FROM collected"
        for c, w in _COEFFICIENTS.items()
    ),
)
def explain_linear(v):
    return rounded(fusion.explain_linear(collected(v), _COEFFICIENTS), ["attribution"], 8)


# Wide class vectors: each model misses some entities.
_HAS = {m: f"(patient_id + {i}) % 7 <> 0" for i, m in enumerate(MODELS)}
_WIDE = (
    "WITH wide AS (SELECT patient_id, "
    + ", ".join(
        f"max(CASE WHEN model = '{m}' AND {_HAS[m]} THEN p{j} END) AS {m}{j}" for m in MODELS for j in range(N_CLASSES)
    )
    + " FROM predictions GROUP BY patient_id)"
)


def vectors(v):
    """One nullable array per modality and entity."""
    scored = v.scored
    chosen = [
        F.max(F.when((F.col("model") == m) & F.expr(_HAS[m]), F.col("prob"))).alias(f"{m}_vector") for m in MODELS
    ]
    return scored.groupBy("patient_id").agg(*chosen)


VECTORS = {m: f"{m}_vector" for m in MODELS}


def _weighted_class(j: int) -> str:
    top = " + ".join(f"{w}::DOUBLE * coalesce({m}{j}, 0)" for m, w in MODALITY_WEIGHTS.items())
    bottom = " + ".join(f"CASE WHEN {m}{j} IS NULL THEN 0::DOUBLE ELSE {w}::DOUBLE END" for m, w in MODALITY_WEIGHTS.items())
    return f"coalesce(({top}) / nullif({bottom}, 0), 0.2::DOUBLE) AS c{j}"


_ENSEMBLE = f"{_WIDE}, ensemble AS (SELECT wide.*, {', '.join(_weighted_class(j) for j in range(N_CLASSES))} FROM wide)"
_ARGMAX = (
    "CASE "
    + " ".join(f"WHEN {' AND '.join(f'c{j} >= c{i}' for i in range(N_CLASSES) if i != j)} THEN {j}" for j in range(N_CLASSES))
    + " END"
)
_DECODED = "CASE k " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in CLASS_LABELS.items()) + " END"
_DECIDED = f"""{_ENSEMBLE},
decided AS (SELECT ensemble.*, greatest(c0, c1, c2, c3, c4) AS conf, {_ARGMAX} AS k FROM ensemble),
levelled AS (
  SELECT decided.*, {_DECODED} AS diagnosis, CASE WHEN conf >= 0.85 AND k IN (1, 4) THEN 'Critical' WHEN conf >= 0.7 THEN 'High'
    WHEN conf >= 0.5 THEN 'Medium' ELSE 'Low' END AS level FROM decided)
"""


@query(
    "fusion_class_vectors",
    f"{_ENSEMBLE} SELECT patient_id, {', '.join(f'round(c{j}, 9) AS c{j}' for j in range(N_CLASSES))} FROM ensemble",
)
def fusion_class_vectors(v):
    fused = vectors(v).select("patient_id", fusion.fuse_vectors(VECTORS, MODALITY_WEIGHTS, N_CLASSES).alias("f"))
    return fused.select("patient_id", *[F.round(F.col("f")[j], 9).alias(f"c{j}") for j in range(N_CLASSES)])


@query(
    "fusion_class_vectors_long",
    f"{_ENSEMBLE} "
    + " UNION ALL ".join(
        f"SELECT patient_id, {j} AS class, round(c{j}, 9) AS p FROM ensemble WHERE NOT ({' AND '.join(f'{m}{j} IS NULL' for m in MODELS)})"
        for j in range(N_CLASSES)
    ),
)
def fusion_class_vectors_long(v):
    present = v.scored.filter(
        F.expr(" OR ".join(f"(model = '{m}' AND {condition})" for m, condition in _HAS.items()))
    )
    long = present.select("patient_id", F.col("model").alias("modality"), F.posexplode("prob").alias("class", "p"))
    return rounded(fusion.fuse_long(long, MODALITY_WEIGHTS), ["p"], 9)


@query(
    "fusion_decision",
    f"{_DECIDED} SELECT patient_id, k AS predicted_class, round(conf, 4) AS confidence, diagnosis, level FROM levelled",
)
def fusion_decision(v):
    return decided(v).select("patient_id", "predicted_class", F.round("conf", 4).alias("confidence"), "diagnosis", "level")


def decided(v):
    fused = vectors(v).withColumn("f", fusion.fuse_vectors(VECTORS, MODALITY_WEIGHTS, N_CLASSES))
    return fused.withColumns({"predicted_class": fusion.argmax("f"), "conf": F.array_max("f")}).withColumns(
        {
            "diagnosis": clean.decode("predicted_class", CLASS_LABELS),
            "level": fusion.confidence_level("conf", "predicted_class"),
        }
    )


@query(
    "fusion_meta_features",
    f"{_WIDE} "
    + " UNION ALL ".join(
        f"SELECT patient_id, {i * N_CLASSES + j} AS position, coalesce({m}{j}, 0.2::DOUBLE) AS p FROM wide"
        for i, m in enumerate(MODELS)
        for j in range(N_CLASSES)
    ),
)
def fusion_meta_features(v):
    stacked = vectors(v).select("patient_id", fusion.meta_features(VECTORS, N_CLASSES).alias("x"))
    return stacked.select("patient_id", F.posexplode("x").alias("position", "p"))


_PEAK = {m: f"greatest({', '.join(f'{m}{j}' for j in range(N_CLASSES))})" for m in MODELS}
_VITAL_TEXT = ", ".join(
    f"CASE WHEN {c} < {lo}::DOUBLE OR {c} > {hi}::DOUBLE THEN concat('{text}: ', CAST(CAST({c} AS DOUBLE) AS STRING)) END"
    for c, (lo, hi, text) in {
        "heart_rate": (60, 100, "Abnormal heart rate"),
        "systolic_bp": (90, 140, "Abnormal blood pressure"),
        "temperature": (36.1, 37.2, "Abnormal temperature"),
        "oxygen_saturation": (95, 100, "Low oxygen saturation"),
        "respiratory_rate": (12, 20, "Abnormal respiratory rate"),
    }.items()
)
_SYMPTOM_TEXT = ", ".join(
    f"CASE WHEN {s} = 1 THEN 'Symptom present: {s.replace('_', ' ')}' END"
    for s in ("fever", "cough", "shortness_of_breath", "chest_pain", "fatigue", "night_sweats", "weight_loss")
)
_STRONGEST = "CASE " + " ".join(
    f"WHEN {_PEAK[m]} >= greatest({', '.join(f'coalesce({_PEAK[o]}, -1)' for o in MODELS)}) "
    f"THEN 'Strongest signal from {m} modality'"
    for m in MODELS
) + " END"
PRESENT = ", ".join(f"{m}0 IS NOT NULL AS has_{m}" for m in MODELS)
MODALITY_NAMES = ", ".join(f"CASE WHEN has_{m} THEN '{m}' END" for m in MODELS)
FACTORED = f"""{_DECIDED},
factored AS (
  SELECT l.patient_id, level, diagnosis, conf, {PRESENT}, list_filter([{_VITAL_TEXT}, {_SYMPTOM_TEXT}, {_STRONGEST}],
    lambda x: x IS NOT NULL)[1:5] AS factors
  FROM levelled l JOIN patients p ON l.patient_id = p.patient_id JOIN symptoms s ON l.patient_id = s.patient_id)
"""


def factored(v):
    rows = decided(v).join(v.patients, "patient_id").join(v.symptoms, "patient_id")
    return rows.withColumn("factors", fusion.top_factors([*v.patients.columns, *SYMPTOMS], VECTORS))


@query("fusion_top_factors", f"{FACTORED} SELECT patient_id, array_to_string(factors, '|') AS factors FROM factored")
def fusion_top_factors(v):
    return factored(v).select("patient_id", joined("factors").alias("factors"))


def _list(lines: list[str]) -> str:
    return "[" + ", ".join("'" + line.replace("'", "''") + "'" for line in lines) + "]"


SCORING_ACTIONS_SQL = f"""list_concat(list_concat(
      CASE level {" ".join(f"WHEN '{k}' THEN {_list(a)}" for k, a in SCORING_ACTIONS.items())} END,
      [concat('Evaluate for: ', diagnosis)]),
      list_filter([
        CASE WHEN len(list_filter(factors, lambda f: contains(lower(f), 'oxygen'))) > 0
          THEN 'Assess respiratory function; consider ABG / pulse oximetry' END,
        CASE WHEN len(list_filter(factors, lambda f: contains(lower(f), 'chest pain'))) > 0
          THEN 'Obtain ECG and cardiac biomarkers' END], lambda x: x IS NOT NULL))"""


@query(
    "actions_for_predictions",
    f"""{FACTORED}
    SELECT patient_id, array_to_string({SCORING_ACTIONS_SQL}, '|') AS actions
    FROM factored
    """,
)
def actions_for_predictions(v):
    chosen = fusion.scoring_actions("level", "diagnosis", "factors")
    return factored(v).select("patient_id", joined(chosen).alias("actions"))


_FUSED_LINES = ", ".join(
    f"concat('  [{m.upper()} (score: ', printf('%.2f', floor({m}_prob * 100) / 100), ')]: {FUSION_FACTOR_ACTIONS[m]}')"
    for m in MODELS
)


@query(
    "actions_for_fusion",
    f"""{_COLLECTED}, fused AS (SELECT *, {_FUSED} AS f FROM collected),
    levelled AS (SELECT *, {_CATEGORY} AS level FROM fused)
    SELECT patient_id, array_to_string(list_concat(
      CASE level {" ".join(f"WHEN '{k}' THEN {_list(a)}" for k, a in FUSION_ACTIONS.items())} END,
      ['{FUSION_FACTOR_HEADER}', {_FUSED_LINES}]), '|') AS actions
    FROM levelled
    """,
)
def actions_for_fusion(v):
    fused = fusion.weighted_fusion(collected(v))
    factors = F.array(
        *[
            F.struct(F.lit(f"{m}_prob").alias("name"), (F.floor(F.col(f"{m}_prob") * 100) / 100).alias("score"))
            for m in MODELS
        ]
    )
    chosen = fusion.fusion_actions("risk_category", factors)
    return fused.select("patient_id", joined(chosen).alias("actions"))


@query(
    "actions_for_chart",
    f"""
    SELECT patient_id, array_to_string(CASE risk_level {" ".join(f"WHEN '{k}' THEN {_list(a)}" for k, a in CHART_ACTIONS.items())} END, '|') AS actions
    FROM truth
    """,
)
def actions_for_chart(v):
    return v.truth.select("patient_id", joined(fusion.level_actions("risk_level", CHART_ACTIONS)).alias("actions"))


@query(
    "probability_from_score",
    """
    SELECT event_id, round(1 / (1 + exp(value / 10)), 9) AS p,
      array_to_string(list_transform([0, 1, 2, 3, 4], lambda i: CASE WHEN i = event_id % 5 THEN 1 ELSE 0 END), ',') AS one_hot
    FROM events
    """,
)
def probability_from_score(v):
    hot = F.transform(fusion.one_hot(F.col("event_id") % 5, 5), lambda x: x.cast("int").cast("string"))
    return v.events.select(
        "event_id", F.round(fusion.anomaly_probability(F.col("value") / 10), 9).alias("p"), joined(hot, ",").alias("one_hot")
    )


@query(
    "score_inverted_min_max",
    """
    SELECT event_id, round(1 - (value - (SELECT min(value) FROM events)) / (SELECT max(value) - min(value) FROM events), 9) AS anomaly_score
    FROM events
    """,
)
def score_inverted_min_max(v):
    return rounded(fusion.min_max_inverted(v.events, "value").select("event_id", "anomaly_score"), ["anomaly_score"], 9)


@query(
    "softmax_of_logits",
    f"""
    WITH powers AS (
      SELECT model, patient_id, {", ".join(f"exp(8 * p{j} - 8 * greatest(p0, p1, p2, p3, p4)) AS e{j}" for j in range(5))} FROM predictions)
    SELECT model, patient_id, {", ".join(f"round(e{j} / (e0 + e1 + e2 + e3 + e4), 9) AS s{j}" for j in range(5))} FROM powers
    """,
)
def softmax_of_logits(v):
    logits = v.predictions.withColumn("z", F.array(*[F.col(f"p{j}") * 8 for j in range(N_CLASSES)]))
    soft = logits.select("model", "patient_id", fusion.softmax("z").alias("s"))
    return soft.select("model", "patient_id", *[F.round(F.col("s")[j], 9).alias(f"s{j}") for j in range(N_CLASSES)])
