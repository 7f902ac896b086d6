"""Models. SQL states what must hold of each result: its keys, true classes, ranges and sums; the tests check the models' properties."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.functions.presets import MODALITY_WEIGHTS, SYMPTOMS
from riskframe.operators import anomaly, clean, entity_text, forest_search, integrate, models, profile, scorecard, split, stacking
from riskframe.plans.catalog.fusing import FACTORED, MODALITY_NAMES, SCORING_ACTIONS_SQL, VECTORS, collected, vectors
from riskframe.plans.catalog.laboratory import latest_wide
from riskframe.plans.catalog.registry import joined, query, rounded
from riskframe.plans.scoring import ScoringPlan
from riskframe.plans.training import TrainingSettings, entity_features, train
from riskframe.plans.views import LAB_TESTS, N_CLASSES
from riskframe.session import materialize



def _held_out_sql(rows: str, key: str, label: str) -> str:
    """Held-out rows of the stratified split with the alphabetical index of their class."""
    return f"""
    WITH all_rows AS ({rows}), ranked AS (
      SELECT {key}, {label}, row_number() OVER (PARTITION BY {label} ORDER BY md5(concat('42:', {key})), {key}) AS r,
        count(*) OVER (PARTITION BY {label}) AS n, dense_rank() OVER (ORDER BY {label}) - 1 AS y FROM all_rows),
    trained AS (SELECT count(DISTINCT {label}) AS k FROM ranked WHERE r <= floor(n * 0.8))
    SELECT {key}, y AS y_true, 1.0::DOUBLE AS prob_sum, k AS n_classes, true AS in_range
    FROM ranked, trained WHERE r > floor(n * 0.8)
    """


def _judged(predictions, key="patient_id"):
    """Key and true class of each prediction, the sum and number of its probabilities, and whether all lie in range."""
    prob = F.col("prob")
    inside = F.forall(prob, lambda p: (p >= 0) & (p <= 1)) & (F.col("y_pred") >= 0) & (F.col("y_pred") < F.size(prob))
    total = F.aggregate(prob, F.lit(0.0), lambda a, b: a + b)
    return predictions.select(key, "y_true", F.round(total, 6).alias("prob_sum"), F.size(prob).alias("n_classes"), inside.alias("in_range"))


_VITALS = ["age", "bmi", "heart_rate", "systolic_bp", "respiratory_rate", "temperature", "oxygen_saturation"]


@query(
    "model_feature_vector",
    "SELECT patient_id, "
    + " + ".join(f"coalesce({c}, 0)::DOUBLE" for c in _VITALS)
    + f" AS total, {len(_VITALS)} AS size FROM patients",
)
def model_feature_vector(v):
    assembled = models.assemble(v.patients, _VITALS).withColumn("x", vector_to_array("features"))
    return assembled.select(
        "patient_id", F.aggregate("x", F.lit(0.0), lambda a, b: a + b).alias("total"), F.size("x").alias("size")
    )


@query(
    "model_feature_vector_skipping",
    "SELECT patient_id, age + bmi AS total FROM patients WHERE age IS NOT NULL AND bmi IS NOT NULL",
)
def model_feature_vector_skipping(v):
    assembled = models.assemble(v.patients.select("patient_id", "age", "bmi"), ["age", "bmi"], invalid="skip")
    x = vector_to_array("features")
    return assembled.select("patient_id", (x[0] + x[1]).alias("total"))


def _structured(v):
    rows = entity_features(v.patients, v.symptoms.drop("recorded_date"), v.truth, list(SYMPTOMS), "patient_id")
    columns = profile.numeric_columns(rows, profile.TRAINING_EXCLUSIONS)
    return split.stratified_split(materialize(rows.na.fill(0, columns)), "final_diagnosis"), columns


@query("model_forest_predictions", _held_out_sql("SELECT patient_id, final_diagnosis FROM truth", "patient_id", "final_diagnosis"))
def model_forest_predictions(v):
    rows, columns = _structured(v)
    model = models.forest_pipeline(columns, "final_diagnosis").fit(rows.filter("is_train"))
    return _judged(models.prediction_frame(model, rows.filter("NOT is_train")))


_IMPORTANCE_COLUMNS = """
  age bmi systolic_bp diastolic_bp heart_rate temperature respiratory_rate oxygen_saturation
""".split()


@query(
    "model_forest_importances",
    "SELECT feature, 1.0::DOUBLE AS total, true AS in_range FROM (VALUES "
    + ", ".join(f"('{c}')" for c in _IMPORTANCE_COLUMNS)
    + ") AS t (feature)",
)
def model_forest_importances(v):
    rows, columns = _structured(v)
    model = models.forest_pipeline(columns, "final_diagnosis").fit(rows.filter("is_train"))
    found = models.feature_importances(v.spark, model, columns)
    total = F.round(found.agg(F.sum("importance")).scalar(), 6)
    return found.filter(F.col("feature").isin(_IMPORTANCE_COLUMNS)).select(
        "feature", total.alias("total"), F.col("importance").between(0, 1).alias("in_range")
    )


_GRID = [(depth, trees) for depth in (5, 8, 10) for trees in (50, 100, 200)]


@query(
    "model_forest_grid_search",
    "SELECT depth, trees, true AS in_range FROM (VALUES " + ", ".join(map(str, _GRID)) + ") AS t (depth, trees)",
)
def model_forest_grid_search(v):
    columns = _VITALS
    rows = v.patients.na.fill(0, columns).join(v.truth, "patient_id")
    pipeline = models.forest_pipeline(columns, "risk_level")
    found = models.grid_search(pipeline, materialize(rows), parallelism=4)
    return models.grid_scores(v.spark, found).select("depth", "trees", F.col("f1").between(0, 1).alias("in_range"))


@query(
    "model_forest_search",
    "SELECT depth, trees, true AS in_range FROM (VALUES " + ", ".join(map(str, _GRID)) + ") AS t (depth, trees)",
)
def model_forest_search(v):
    """The same grid; the result names the best point and holds its model."""
    rows = v.patients.na.fill(0, _VITALS).join(v.truth, "patient_id")
    found = forest_search.search_forest(models.forest_pipeline(_VITALS, "risk_level"), materialize(rows), parallelism=4)
    return found.frame(v.spark).select("depth", "trees", F.col("f1").between(0, 1).alias("in_range"))


_COMPLETE = " AND ".join(f"count(CASE WHEN test_name = '{t}' THEN value END) > 0" for t in LAB_TESTS)


@query(
    "model_lab_predictions",
    _held_out_sql(
        f"SELECT t.patient_id, t.final_diagnosis FROM truth t JOIN (SELECT patient_id FROM labs GROUP BY patient_id HAVING {_COMPLETE}) l "
        "ON t.patient_id = l.patient_id",
        "patient_id",
        "final_diagnosis",
    ),
)
def model_lab_predictions(v):
    wide = integrate.join_all([integrate.pivot_mean(v.labs, LAB_TESTS), v.truth], ["patient_id"])
    rows = split.stratified_split(materialize(clean.drop_missing(wide, LAB_TESTS)), "final_diagnosis")
    model = models.forest_pipeline(LAB_TESTS, "final_diagnosis", 200, 10, scale=False).fit(rows.filter("is_train"))
    return _judged(models.prediction_frame(model, rows.filter("NOT is_train")))


@query(
    "model_text_predictions",
    _held_out_sql(
        "SELECT d.doc_id, CAST(quality AS STRING) AS quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id", "doc_id", "quality"
    ),
)
def model_text_predictions(v):
    joined = v.documents.join(v.labels, "doc_id").select("doc_id", "text", F.col("quality").cast("string").alias("quality"))
    rows = split.stratified_split(joined, "quality", "doc_id")
    model = models.fit_text_classifier(rows.filter("is_train"), "quality", "text")
    return _judged(models.prediction_frame(model, rows.filter("NOT is_train"), ["doc_id"]), "doc_id")


@query("model_clusters", "SELECT DISTINCT patient_id, true AS in_range FROM labs")
def model_clusters(v):
    _, clustered, silhouette = models.fit_clusters(materialize(latest_wide(v)), LAB_TESTS)
    inside = F.col("cluster").between(0, 3) & F.lit(-1 <= silhouette <= 1)
    return clustered.select("patient_id", inside.alias("in_range"))


@query("model_principal_components", "SELECT patient_id, 0.0::DOUBLE AS mean_1, 0.0::DOUBLE AS mean_2, true AS ordered FROM patients")
def model_principal_components(v):
    projected, shares = models.principal_components(v.patients, _VITALS)
    moments = projected.agg(F.struct(F.avg("pc1").alias("a"), F.avg("pc2").alias("b"), F.var_pop("pc1").alias("v"), F.var_pop("pc2").alias("w")).alias("m"))
    m = moments.scalar()
    ordered = (m.getField("v") >= m.getField("w")) & F.lit(1 <= models.components_for(shares) <= len(_VITALS))
    return projected.select(
        "patient_id", F.abs(F.round(m.getField("a"), 6)).alias("mean_1"), F.abs(F.round(m.getField("b"), 6)).alias("mean_2"), ordered.alias("ordered")
    )


@query(
    "model_anomalies",
    "SELECT DISTINCT patient_id, true AS in_range, true AS share_fits FROM labs",
)
def model_anomalies(v):
    _, judged = anomaly.fit_and_detect(materialize(latest_wide(v)), LAB_TESTS)
    found = judged.select("patient_id", "anomaly_score", "is_anomaly")
    # The threshold is the lower 90 % quantile, so at most a tenth lies above it.
    share = found.agg(F.avg("is_anomaly")).scalar()
    return found.select("patient_id", F.col("anomaly_score").between(0, 1).alias("in_range"), (share <= 0.1).alias("share_fits"))


def _meta(v):
    wide = vectors(v).join(
        v.predictions.filter("model = 'structured'").select("patient_id", "y_true"), "patient_id"
    )
    plan = ScoringPlan(VECTORS)
    from riskframe.operators.fusion import meta_features

    stacked = wide.withColumn("_meta", meta_features(VECTORS, N_CLASSES))
    names = [f"f{i}" for i in range(N_CLASSES * len(VECTORS))]
    return plan, stacked.select("patient_id", "y_true", *[F.col("_meta")[i].alias(n) for i, n in enumerate(names)]), names


@query(
    "model_stack_fold_scores",
    """
    SELECT CAST(('0x' || substr(md5(concat('42:', patient_id)), 1, 8))::BIGINT % 5 AS INT) AS fold, count(*) AS n, true AS in_range
    FROM predictions WHERE model = 'structured' GROUP BY fold
    """,
)
def model_stack_fold_scores(v):
    _, rows, names = _meta(v)
    _, held_out = stacking.fit_stack(rows, names)
    scores = stacking.fold_scores(held_out)
    return scores.select("fold", "n", F.col("accuracy").between(0, 1).alias("in_range"))


@query(
    "model_stacked_probabilities",
    "SELECT patient_id, y_true, 1.0::DOUBLE AS prob_sum, true AS in_range FROM predictions WHERE model = 'structured'",
)
def model_stacked_probabilities(v):
    _, rows, names = _meta(v)
    _, held_out = stacking.fit_stack(rows, names)
    return _judged(held_out.withColumn("y_pred", F.lit(0))).drop("n_classes")


@query(
    "model_final_prediction",
    """
    WITH collected AS (
      SELECT patient_id, """
    + ", ".join(f"coalesce(max(CASE WHEN modality = '{m}' THEN prob END), 0.5::DOUBLE) AS {m}_prob" for m in MODALITY_WEIGHTS)
    + """ FROM modality_scores GROUP BY patient_id),
    fused AS (SELECT patient_id, """
    + " + ".join(f"{w}::DOUBLE * {m}_prob" for m, w in MODALITY_WEIGHTS.items())
    + """ AS f FROM collected)
    SELECT patient_id, round(f, 9) AS confidence, CASE WHEN f > 0.75 THEN 'Critical' WHEN f > 0.5 THEN 'High'
      WHEN f > 0.25 THEN 'Moderate' ELSE 'Low' END AS risk_category FROM fused
    """,
)
def model_final_prediction(v):
    final = stacking.predict_final(collected(v))
    return rounded(final.select("patient_id", "confidence", "risk_category"), ["confidence"], 9)


@query(
    "model_final_prediction_stacked",
    """
    SELECT DISTINCT s.patient_id, true AS in_range, true AS category_fits
    FROM modality_scores s JOIN predictions p ON s.patient_id = p.patient_id AND p.model = 'structured'
    """,
)
def model_final_prediction_stacked(v):
    rows = collected(v).join(
        v.predictions.filter("model = 'structured'").select("patient_id", "y_true"), "patient_id"
    )
    model, _ = stacking.fit_stack(rows, [f"{m}_prob" for m in MODALITY_WEIGHTS])
    final = stacking.predict_final(rows, model)
    c = F.col("confidence")
    category = F.when(c > 0.75, "Critical").when(c > 0.5, "High").when(c > 0.25, "Moderate").otherwise("Low")
    inside = F.col("predicted_class").between(0, N_CLASSES - 1) & c.between(1.0 / N_CLASSES - 1e-9, 1 + 1e-9)
    return final.select("patient_id", inside.alias("in_range"), (F.col("risk_category") == category).alias("category_fits"))


@query(
    "batch_scoring_records",
    f"""{FACTORED}
    SELECT CAST(f.patient_id AS STRING) AS patient_id, level AS risk_level, round(conf, 4) AS confidence, diagnosis AS predicted_diagnosis,
      array_to_string(list_filter([{MODALITY_NAMES}], lambda x: x IS NOT NULL), '|') AS per_modality_scores,
      array_to_string(factors, '|') AS top_factors, array_to_string({SCORING_ACTIONS_SQL}, '|') AS recommended_actions
    FROM factored f
    """,
)
def batch_scoring_records(v):
    entities = vectors(v).join(v.patients, "patient_id").join(v.symptoms, "patient_id")
    records = ScoringPlan(VECTORS).records(entities)
    lists = {"per_modality_scores": F.map_keys("per_modality_scores"), "top_factors": F.col("top_factors"), "recommended_actions": F.col("recommended_actions")}
    return records.withColumns({name: joined(values) for name, values in lists.items()})


@query(
    "model_entity_text_predictions",
    _held_out_sql(
        "SELECT DISTINCT n.patient_id, final_diagnosis FROM notes n JOIN truth t ON n.patient_id = t.patient_id WHERE note_text IS NOT NULL",
        "patient_id",
        "final_diagnosis",
    ),
)
def model_entity_text_predictions(v):
    notes = clean.drop_missing(v.notes, ["note_text"])
    joined = integrate.join_all([notes, v.truth], ["patient_id"], heavy=True)
    entities = materialize(joined.select("patient_id", "final_diagnosis").distinct())
    rows = materialize(split.stratified_split(entities, "final_diagnosis"))
    train, test = rows.filter("is_train"), rows.filter("NOT is_train")
    order = ("note_date", "note_id")
    spoken = entity_text.EntityNotes(joined, order=order)
    model = entity_text.fit_entity_text_classifier(train, spoken.only(train), "final_diagnosis")
    return _judged(model.predict(test, spoken.only(test)))


_SHARES = ("accuracy", "precision_macro", "recall_macro", "f1_macro")


@query(
    "training_run_metrics",
    "SELECT model, metric, true AS in_range FROM (VALUES ('structured'), ('nlp'), ('lab'), ('imaging'), ('ensemble')) AS m (model), (VALUES "
    + ", ".join(f"('{x}')" for x in _SHARES)
    + ") AS t (metric)",
)
def training_run_metrics(v):
    settings = TrainingSettings(
        lab_tests=tuple(LAB_TESTS), note_order=("note_date", "note_id")
    )
    images = v.embeddings.select((F.col("vec_id") * 3).alias("patient_id"), "embedding")
    run = train(v.patients, v.symptoms.drop("recorded_date"), v.labs, v.notes, v.truth, settings, images)
    shares = run.metrics().filter(F.col("class").isNull() & F.col("metric").isin(list(_SHARES)))
    return shares.select("model", "metric", F.col("value").between(0, 1).alias("in_range"))
