"""Sessions, readers and sinks: tables go through files in the shared folder and come back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.operators import evaluate, models, text
from riskframe.plans.catalog.evaluation import ALL_METRICS
from riskframe.plans.catalog.registry import query, rounded
from riskframe.plans.views import N_CLASSES, TABLES
from riskframe.session import build_session, ensure_checkpoint_dir
from riskframe.sources import readers, writers
from riskframe.sources.schemas import SCHEMAS


def _folder(v, name: str) -> str:
    return f"{ensure_checkpoint_dir(v.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _write_csv(df, path: str) -> None:
    df.select(*[F.col(c).cast("string") for c in df.columns]).write.option("header", "true").csv(path)


@query("session_tables", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES))
def session_tables(v):
    spark = build_session(v.spark.sparkContext.appName)
    counted = [spark.read.parquet(f"{v.folder}/{t}.parquet").agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n")) for t in TABLES]
    found = counted[0]
    for one in counted[1:]:
        found = found.union(one)
    return found


_TRUTH_COLUMNS = list(SCHEMAS["ground_truth"].fieldNames())
_BAD = "patient_id % 7 = 3"


def _dirty_truth(v) -> str:
    """The truth as CSV; in one row of seven a number is no number."""
    path = _folder(v, "truth")
    flag = F.when(F.expr(_BAD), F.lit("unknown")).otherwise(F.col("requires_icu").cast("string"))
    _write_csv(v.truth.withColumn("requires_icu", flag).select(*_TRUTH_COLUMNS), path)
    return path


@query(
    "source_csv_rows",
    f"SELECT CAST(patient_id AS VARCHAR) AS patient_id, final_diagnosis, risk_level, requires_icu FROM truth WHERE NOT ({_BAD})",
)
def source_csv_rows(v):
    return readers.load(v.spark, "ground_truth", _dirty_truth(v))


@query(
    "source_csv_quarantine",
    f"SELECT concat_ws(',', patient_id, final_diagnosis, risk_level, 'unknown') AS _corrupt_record FROM truth WHERE {_BAD}",
)
def source_csv_quarantine(v):
    return readers.read_quarantine(v.spark, _dirty_truth(v), SCHEMAS["ground_truth"])


_SOURCES = {"patients": "patients", "lab_results": "labs", "clinical_notes": "notes", "ground_truth": "truth"}


@query(
    "source_load_all",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, {f'(SELECT count(*) FROM {_SOURCES[name]})' if name in _SOURCES else 'CAST(0 AS BIGINT)'} AS n, "
        f"{len(schema.fields)} AS n_columns"
        for name, schema in SCHEMAS.items()
    ),
)
def source_load_all(v):
    """Four of the six tables exist, as parquet; the two others are empty tables."""
    root = _folder(v, "sources")
    for name, view in _SOURCES.items():
        rows = getattr(v, view)
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields
        ]
        writers.write_parquet(rows.select(*columns), f"{root}/{name}.parquet")
    counted = None
    for name, df in readers.load_all(v.spark, root, "parquet").items():
        one = df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.lit(len(df.columns)).alias("n_columns"))
        counted = one if counted is None else counted.union(one)
    return counted


@query("sink_partitioned", "SELECT patient_id, final_diagnosis, requires_icu, risk_level FROM truth")
def sink_partitioned(v):
    path = _folder(v, "by-level")
    writers.write_parquet(v.truth, path, ["risk_level"])
    return v.spark.read.parquet(path).select("patient_id", "final_diagnosis", "requires_icu", "risk_level")


@query("sink_bucketed", "SELECT patient_id, order_no, line_no, test_name, value FROM labs")
def sink_bucketed(v):
    path = _folder(v, "buckets")
    writers.write_bucketed(v.labs.select("patient_id", "order_no", "line_no", "test_name", "value"), path, buckets=16)
    return v.spark.read.parquet(path).drop("bucket")


@query(
    "colocated_join",
    """
    SELECT p.patient_id, p.age, p.sex, s.primary_diagnosis, t.risk_level
    FROM patients p JOIN symptoms s ON p.patient_id = s.patient_id JOIN truth t ON p.patient_id = t.patient_id
    """,
)
def colocated_join(v):
    tables = {}
    for name in ("patients", "symptoms", "truth"):
        own = f"riskframe_{name}_{uuid.uuid4().hex}"
        tables[name] = writers.write_colocated(getattr(v, name), own, _folder(v, name), buckets=16)
    joined = tables["patients"].join(tables["symptoms"], "patient_id").join(tables["truth"], "patient_id")
    return joined.select("patient_id", "age", "sex", "primary_diagnosis", "risk_level")


_PROBS = [f"p{j}" for j in range(N_CLASSES)]


@query("sink_predictions", f"SELECT model, patient_id, y_true, y_pred, {', '.join(_PROBS)} FROM predictions")
def sink_predictions(v):
    path = _folder(v, "predictions")
    writers.write_predictions(v.scored, path)
    schema = "model string, patient_id bigint, y_true int, y_pred int, prob array<double>"
    back = readers.read_predictions(v.spark, path, schema)
    return back.select("model", "patient_id", "y_true", "y_pred", *[F.col("prob")[j].alias(p) for j, p in enumerate(_PROBS)])


@query("report_metrics", ALL_METRICS)
def report_metrics(v):
    folder = _folder(v, "report")
    evaluate.save_report(v.scored, folder)
    return rounded(readers.read_metrics(v.spark, f"{folder}/metrics"), ["value"], 7)


@query("sink_array_column", "SELECT page_id, 64 AS size, true AS ok, round(1.0::DOUBLE, 4) AS total FROM pages")
def sink_array_column(v):
    path = _folder(v, "vectors")
    content = v.pages.select("page_id", F.col("html").cast("binary").alias("content"))
    writers.write_parquet(text.embed_files(content, keep=["page_id"]), path)
    back = v.spark.read.schema("page_id bigint, embedding array<float>, ok boolean").parquet(path)
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return back.select("page_id", F.size("embedding").alias("size"), "ok", F.round(total, 4).alias("total"))


# Images with an even number have a file; the others only have a row.
@query(
    "source_existing_images",
    "SELECT patient_id, image_id, image_path FROM images WHERE image_path LIKE 'images/%' AND (patient_id // 3) % 2 = 0",
)
def source_existing_images(v):
    root = _folder(v, "files")
    images = v.images
    written = images.filter(F.col("image_path").like("images/%") & (F.expr("patient_id div 3") % 2 == 0))
    writers.write_files(written.select(F.col("image_path").alias("path"), F.col("image_id").alias("content")), root)
    return readers.existing_images(images, root).select("patient_id", "image_id", "image_path")


@query(
    "model_saved_and_loaded",
    "SELECT p.patient_id, true AS same FROM patients p JOIN truth t ON p.patient_id = t.patient_id",
)
def model_saved_and_loaded(v):
    from pyspark.ml import PipelineModel

    columns = ["age", "bmi", "heart_rate", "systolic_bp"]
    rows = v.patients.na.fill(0, columns).join(v.truth, "patient_id").select("patient_id", "risk_level", *columns)
    fitted = models.forest_pipeline(columns, "risk_level", trees=10, depth=4).fit(rows)
    path = _folder(v, "model")
    fitted.write().save(path)
    one, two = (models.prediction_frame(m, rows).select("patient_id", "y_pred", "prob") for m in (fitted, PipelineModel.load(path)))
    both = one.join(two.withColumnsRenamed({"y_pred": "_pred", "prob": "_prob"}), "patient_id")
    return both.select("patient_id", ((F.col("y_pred") == F.col("_pred")) & (F.col("prob") == F.col("_prob"))).alias("same"))
