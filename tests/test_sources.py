import pytest
from pyspark.sql import functions as F

from riskframe.session import build_session
from riskframe.sources import readers, schemas, writers


@pytest.fixture()
def truth_csv(tmp_path):
    path = tmp_path / "ground_truth.csv"
    path.write_text(
        "patient_id,final_diagnosis,risk_level,requires_icu\n"
        "P1,Healthy,Low,0\nP2,Sepsis,High,not_a_number\nP3,Flu,Moderate,\n"
    )
    return path


def test_malformed_rows_are_set_apart(spark, truth_csv):
    schema = schemas.SCHEMAS["ground_truth"]
    good = readers.read_csv(spark, str(truth_csv), schema)
    assert [r["patient_id"] for r in good.orderBy("patient_id").collect()] == ["P1", "P3"]
    assert good.count() == 2 and good.select("patient_id").count() == 2
    bad = readers.read_quarantine(spark, str(truth_csv), schema).collect()
    assert len(bad) == 1 and "not_a_number" in bad[0][0]


def test_load_all_gives_empty_tables(spark, truth_csv):
    tables = readers.load_all(spark, str(truth_csv.parent))
    assert set(tables) == set(schemas.SCHEMAS) and tables["ground_truth"].count() == 2
    assert tables["patients"].count() == 0 and tables["patients"].columns[:2] == ["patient_id", "age"]
    assert len(tables["symptoms"].columns) == 32


def test_parquet_sinks(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("patient_id"), (F.col("id") % 3).alias("level"))
    writers.write_parquet(df, str(tmp_path / "p"), ["level"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100
    writers.write_bucketed(df, str(tmp_path / "b"), buckets=4)
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.count() == 100 and back.select("bucket").distinct().count() <= 4
    writers.write_bucketed(df.limit(10), str(tmp_path / "b"), buckets=4)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 10


def test_predictions_and_metrics(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, [0.25, 0.75])], "patient_id string, y_pred int, prob array<double>")
    writers.write_predictions(df, str(tmp_path / "pred"))
    back = readers.read_predictions(spark, str(tmp_path / "pred"), "patient_id string, y_pred int, prob string").first()
    assert tuple(back) == ("a", 1, "[0.25,0.75]")
    metrics = spark.createDataFrame([("m", "accuracy", None, 0.5), ("m", "ppv", 1, 1.0)], "model string, metric string, class int, value double")
    writers.write_metrics(metrics, str(tmp_path / "metrics"))
    assert sorted(map(str, readers.read_metrics(spark, str(tmp_path / "metrics")).collect())) == sorted(map(str, metrics.collect()))


def test_existing_images(spark, tmp_path):
    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "1.png").write_bytes(b"png")
    df = spark.createDataFrame([("a", "images/1.png"), ("b", "images/2.png")], "patient_id string, image_path string")
    for root in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}/"):
        kept = readers.existing_images(df, root).collect()
        assert [r["patient_id"] for r in kept] == ["a"] and kept[0]["full_path"].endswith("images/1.png")


def test_session_accepts_only_spark_settings(spark):
    with pytest.raises(ValueError, match="executor_memory"):
        build_session(conf={"executor_memory": "4g"})


def test_colocated_tables_join_without_exchange(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = []
        for name in ("one", "two", "three"):
            df = spark.range(500).select((F.col("id") * 7 % 500).alias("patient_id"), F.col("id").alias(name))
            tables.append(writers.write_colocated(df, f"colocated_{name}", str(tmp_path / name), buckets=4))
        joined = tables[0].join(tables[1], "patient_id").join(tables[2], "patient_id")
        grouped = joined.groupBy("patient_id").agg(F.sum("one").alias("s"))
        plan = grouped._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and grouped.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("one", "two", "three"):
            spark.sql(f"DROP TABLE IF EXISTS colocated_{name}")


def test_files_are_written_once_each(spark, tmp_path):
    rows = [("a/1.bin", b"x"), ("a/2.bin", None), (None, b"y")]
    df = spark.createDataFrame(rows, "path string, content binary")
    written = writers.write_files(df, str(tmp_path / "files"))
    assert sorted(map(tuple, written.collect())) == [("a/1.bin", 1), ("a/2.bin", 0)]
    found = readers.image_files(spark, str(tmp_path / "files")).select("content").collect()
    assert [bytes(r[0]) for r in found] == [b"x"]  # Spark lists no empty files


def test_every_part_of_a_bucket_is_a_task_of_its_own(spark, tmp_path):
    """Several parts in one task would be sorted together; then some file names would hold more than one bucket."""
    path = str(tmp_path / "parts")
    rows = spark.range(4000).withColumnRenamed("id", "patient_id")
    writers.write_bucketed(rows, path, buckets=16, rows_per_file=100)
    tasks = {}
    for file in (tmp_path / "parts").glob("bucket=*/part-*.parquet"):
        tasks.setdefault(file.name.split("-")[1], set()).add(file.parent.name)
    assert len(tasks) > 16 and all(len(b) == 1 for b in tasks.values())
    assert spark.read.parquet(path).count() == 4000
