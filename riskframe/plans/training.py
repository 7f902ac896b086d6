"""End-to-end training run: clean, integrate, features, split, modality models, stack, metrics."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.presets import SYMPTOMS
from riskframe.operators import clean, entity_text, evaluate, fusion, integrate, models, profile, scorecard, split
from riskframe.operators.forest_search import search_forest
from riskframe.operators.sizing import evenly
from riskframe.operators.stacking import StackedModel, fit_stack, fold_scores
from riskframe.plans.scoring import ScoringPlan
from riskframe.session import materialize
from riskframe.sources import writers

log = logging.getLogger(__name__)

MODALITIES = ("structured", "nlp", "lab", "imaging")


@dataclass
class TrainingSettings:
    label: str = "final_diagnosis"
    key: str = "patient_id"
    train_share: float = 0.8
    seed: int = 42
    forest_trees: int = 150
    forest_depth: int = 10
    lab_trees: int = 200
    lab_depth: int = 10
    text_features: int = 5000
    search_depths: tuple[int, ...] = ()
    search_trees: tuple[int, ...] = ()
    flags: tuple[str, ...] = tuple(SYMPTOMS)
    lab_tests: tuple[str, ...] = ()
    note_order: tuple[str, ...] = ("note_date",)


@dataclass
class TrainingRun:
    """Everything a run produces; a modality that failed is in ``failures`` and missing from ``models``."""

    labels: list[str]
    models: dict[str, PipelineModel] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)
    stacked: StackedModel | None = None
    predictions: DataFrame | None = None
    counts: DataFrame | None = None
    stack_scores: DataFrame | None = None

    def metrics(self) -> DataFrame:
        """Long metrics of every modality and of the ensemble, all on held-out rows."""
        return evaluate.all_metrics(self.predictions)

    def comparison(self) -> DataFrame:
        return evaluate.compare_models(self.predictions)

    def scoring_plan(self, vectors: dict[str, str]) -> ScoringPlan:
        return ScoringPlan(vectors, labels=dict(enumerate(self.labels)), stacked=self.stacked)

    def save(self, spark: SparkSession, path: str) -> None:
        for name, model in self.models.items():
            model.write().overwrite().save(f"{path}/models/{name}")
        if self.stacked is not None:
            self.stacked.save(spark, f"{path}/models/ensemble")
            writers.write_metrics(self.stack_scores, f"{path}/stack_scores")
        failed = spark.createDataFrame(list(self.failures.items()), "modality string, error string")
        writers.write_metrics(failed, f"{path}/failures")
        writers.write_metrics(self.metrics(), f"{path}/metrics")
        writers.write_comparison(self.comparison(), f"{path}/comparison")
        writers.write_predictions(self.predictions, f"{path}/predictions")


def load_models(spark: SparkSession, path: str) -> dict[str, object]:
    """The saved models of a run by modality; a missing one is left out."""
    from riskframe.sources.readers import _exists

    found: dict[str, object] = {}
    for name in MODALITIES:
        if _exists(spark, f"{path}/models/{name}"):
            found[name] = PipelineModel.load(f"{path}/models/{name}")
    if _exists(spark, f"{path}/models/ensemble"):
        found["ensemble"] = StackedModel.load(spark, f"{path}/models/ensemble")
    return found


def entity_features(patients: DataFrame, symptoms: DataFrame, labels: DataFrame, flags: list[str], key: str) -> DataFrame:
    """Filled and joined entity rows with all structured features."""
    filled = clean.fill_constants(patients, {"smoking_status": "Unknown"})
    marked = clean.fill_constants(symptoms, {f: 0 for f in flags}).withColumn("symptom_count", clean.flag_sum(flags).cast("int"))
    joined = integrate.join_all([filled, marked, labels], [key])
    scored = scorecard.with_comorbidity_index(scorecard.with_vital_scores(joined))
    return scorecard.with_symptom_clusters(scorecard.with_interactions(scored))


def train(
    patients: DataFrame,
    symptoms: DataFrame,
    labs: DataFrame,
    notes: DataFrame,
    truth: DataFrame,
    settings: TrainingSettings | None = None,
    images: DataFrame | None = None,
) -> TrainingRun:
    """Fit every modality and the ensemble on one common split of the entities.

    ``images`` is an optional table of embeddings ``(key, embedding)``. Each modality predicts the held-out
    entities; the ensemble is stacked by entity over those predictions and evaluated out of fold.
    """
    s = settings or TrainingSettings()
    key, label = s.key, s.label
    labelled = truth.filter(F.col(label).isNotNull())
    parts = materialize(split.stratified_split(labelled.select(key, label), label, key, s.train_share, s.seed))
    train_ids, test_ids = parts.filter("is_train"), parts.filter("NOT is_train")
    names = [r[label] for r in clean.label_dimension(parts, label).orderBy("label_index").collect()]
    run = TrainingRun(names)
    run.counts = profile.row_counts(
        {"patients": patients, "symptoms": symptoms, "labs": labs, "notes": notes, "truth": truth}
    )

    def structured() -> tuple[PipelineModel, DataFrame]:
        features = entity_features(patients, symptoms, labelled, list(s.flags), key)
        columns = profile.numeric_columns(features, profile.TRAINING_EXCLUSIONS)
        # Fitting passes over the rows many times; saving them also keeps the plan of each pass short.
        rows = materialize(features.na.fill(0, columns))
        fit_on = materialize(evenly(integrate.keep_ids(rows, train_ids, key)))
        pipeline = models.forest_pipeline(columns, label, s.forest_trees, s.forest_depth, s.seed, labels=names)
        if s.search_depths and s.search_trees:
            model = search_forest(pipeline, fit_on, key, s.search_depths, s.search_trees).best
        else:
            model = pipeline.fit(fit_on)
        return model, rows

    def nlp() -> tuple[PipelineModel, DataFrame, PipelineModel]:
        joined = integrate.join_all([notes, labelled.select(key, label)], [key], heavy=True)
        spoken = clean.drop_missing(joined, ["note_text"])
        sides = parts.groupBy(key).agg(F.max("is_train").alias("_train"), F.max(~F.col("is_train")).alias("_test"))
        entities = materialize(spoken.select(key, label).distinct().join(sides, key))
        known = entity_text.EntityNotes(spoken, key, "note_text", s.note_order)
        n = entities.filter("_train").count()
        words = entity_text.fit_vocabulary(known.only(train_ids), n, max_features=s.text_features)
        # One more pass counts the terms of the vocabulary, of the entities to fit on and of those to score.
        vectors = materialize(entity_text.entity_vectors(entities, known, words, key))
        fit_on = materialize(evenly(vectors.filter("_train").select(label, entity_text.VECTOR)))
        model = entity_text.fit_on_vectors(fit_on, words, label, n, labels=names)
        return model.for_texts("note_text"), vectors.filter("_test"), model.classifier

    def lab() -> tuple[PipelineModel, DataFrame]:
        tests = list(s.lab_tests) or sorted(r[0] for r in labs.select("test_name").distinct().collect())
        wide = integrate.join_all([integrate.pivot_mean(labs, tests, key), labelled.select(key, label)], [key])
        rows = materialize(clean.drop_missing(wide, tests))
        pipeline = models.forest_pipeline(tests, label, s.lab_trees, s.lab_depth, s.seed, scale=False, labels=names)
        return pipeline.fit(materialize(evenly(integrate.keep_ids(rows, train_ids, key)))), rows

    def imaging() -> tuple[PipelineModel, DataFrame]:
        size = images.select(F.max(F.size("embedding"))).first()[0]
        columns = [f"e{i}" for i in range(size)]
        flat = images.select(key, *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(columns)])
        rows = materialize(integrate.join_all([flat, labelled.select(key, label)], [key]))
        pipeline = models.forest_pipeline(columns, label, s.lab_trees, s.lab_depth, s.seed, scale=False, labels=names)
        return pipeline.fit(materialize(evenly(integrate.keep_ids(rows, train_ids, key)))), rows

    steps = {"structured": structured, "nlp": nlp, "lab": lab}
    if images is not None:
        steps["imaging"] = imaging

    def judged(step: Callable[[], tuple]) -> tuple[PipelineModel, DataFrame]:
        model, rows, *on_rows = step()  # the last is given where the saved model takes other rows than these
        scored = models.prediction_frame((on_rows or [model])[0], integrate.keep_ids(rows, test_ids, key), (key,))
        # An entity with several images gets the mean vector.
        mean = F.array(*[F.avg(F.col("prob")[i]) for i in range(len(names))]).alias("prob")
        return model, materialize(scored.groupBy(key).agg(F.max("y_true").alias("y_true"), mean))

    # The text model's rounds are many short jobs, so they leave cores to the forests, which follow each other beside it.
    spark = truth.sparkSession
    with ThreadPoolExecutor(2) as pool:
        waiting = sorted(steps, key=lambda name: name != "nlp")
        running = {name: pool.submit(inheritable_thread_target(spark)(judged), steps[name]) for name in waiting}
    held_out: dict[str, DataFrame] = {}
    for name in steps:
        try:
            run.models[name], held_out[name] = running[name].result()
        except Exception as error:  # a failing modality is reported and left out
            log.warning("modality %s failed: %s", name, error)
            run.failures[name] = str(error)
    if not held_out:
        raise RuntimeError(f"every modality failed: {run.failures}")

    n = len(names)
    index = clean.index_labels(test_ids.select(key, label), label).select(key, F.col("label_index").alias("y_true"))
    wide = index
    for name, rows in held_out.items():
        wide = wide.join(rows.select(key, F.col("prob").alias(name)), key, "left")
    vectors = {m: m for m in MODALITIES if m in held_out}
    all_vectors = {m: m for m in MODALITIES}
    for name in MODALITIES:
        if name not in vectors:
            wide = wide.withColumn(name, F.lit(None).cast("array<double>"))
    stacked_rows = wide.withColumn("_meta", fusion.meta_features(all_vectors, n))
    features = [f"_f{i}" for i in range(n * len(MODALITIES))]
    flat = stacked_rows.select(key, "y_true", *[F.col("_meta")[i].alias(f) for i, f in enumerate(features)])
    run.stacked, out_of_fold = fit_stack(flat, features, "y_true", key, seed=s.seed)
    run.stack_scores = materialize(fold_scores(out_of_fold, key=key, seed=s.seed))

    frames = [
        rows.select(F.lit(name).alias("model"), key, "y_true", fusion.argmax("prob").alias("y_pred"), "prob")
        for name, rows in held_out.items()
    ]
    frames.append(
        out_of_fold.select(
            F.lit("ensemble").alias("model"), key, "y_true", fusion.argmax("prob").alias("y_pred"), "prob"
        )
    )
    run.predictions = materialize(integrate.stack(frames))
    return run
