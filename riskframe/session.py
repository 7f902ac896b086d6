"""Spark session factory and the shared folder for reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "riskframe", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Create (or get) a session; only ``spark.*`` keys are accepted in ``conf``."""
    conf = dict(conf or {})
    wrong = sorted(key for key in conf if not key.startswith("spark."))
    if wrong:
        raise ValueError(f"not Spark settings: {wrong}")
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taken from ``spark.checkpoint.dir`` when the cluster names one.

    A local session without the setting (tests) gets its own folder; a cluster without it is an
    error, because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="riskframe-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the checkpoint folder and continue from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
