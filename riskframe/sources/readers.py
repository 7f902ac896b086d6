"""Readers. Malformed CSV rows are split off into a quarantine table instead of vanishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from riskframe.sources.schemas import SCHEMAS

CORRUPT = "_corrupt_record"


def _parsed(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """All rows of a CSV file with the corrupt-record column."""
    widened = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    reader = (
        spark.read.schema(widened)
        .option("header", "true")
        .option("enforceSchema", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    return reader.options(**options).csv(path)


def _verdict(schema: StructType, corrupt: bool) -> Column:
    """Whether a row is corrupt. The condition names every column, by a test that always holds: Spark only
    converts the columns a query uses, so a narrower one would miss bad values in the others."""
    whole = F.hash(*schema.fieldNames()) >= F.lit(-(2**31))
    return whole & (F.col(CORRUPT).isNotNull() if corrupt else F.col(CORRUPT).isNull())


def read_csv(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Well-formed rows of a CSV file with a declared schema."""
    return _parsed(spark, path, schema, **options).filter(_verdict(schema, False)).drop(CORRUPT)


def read_quarantine(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """The malformed rows of the same file, as text."""
    return _parsed(spark, path, schema, **options).filter(_verdict(schema, True)).select(CORRUPT)


def load(spark: SparkSession, name: str, path: str, fmt: str = "csv") -> DataFrame:
    """One of the six source tables, from CSV or parquet."""
    schema = SCHEMAS[name]
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def load_all(spark: SparkSession, folder: str, fmt: str = "csv", suffix: str | None = None) -> dict[str, DataFrame]:
    """All source tables of a folder; a missing file gives an empty table with the declared schema."""
    suffix = f".{fmt}" if suffix is None else suffix
    tables = {}
    for name, schema in SCHEMAS.items():
        path = f"{folder.rstrip('/')}/{name}{suffix}"
        found = _exists(spark, path)
        tables[name] = load(spark, name, path, fmt) if found else spark.createDataFrame([], schema)
    return tables


def read_predictions(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Predictions written by ``write_predictions``; array, map and struct columns are parsed from their JSON text."""
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    nested = {f.name for f in wanted.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    flat = StructType([StructField(f.name, StringType() if f.name in nested else f.dataType) for f in wanted.fields])
    rows = spark.read.schema(flat).option("header", "true").option("escape", '"').csv(path)
    return rows.select(
        *[F.from_json(f.name, f.dataType).alias(f.name) if f.name in nested else F.col(f.name) for f in wanted.fields]
    )


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    """The table of models written by ``write_comparison``."""
    schema = "model string, accuracy double, precision_macro double, recall_macro double, f1_macro double, auc_roc_macro double"
    return spark.read.schema(schema).option("header", "true").csv(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("model string, metric string, class int, value double").json(path)


def image_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Files below ``root`` as ``path``, ``modificationTime``, ``length``, ``content`` (read only when used)."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    )


def existing_images(df: DataFrame, root: str, path: str = "image_path") -> DataFrame:
    """Rows whose file exists below ``root``, with ``full_path``; the file contents are not read."""
    base = root.rstrip("/")
    names = df.withColumn("full_path", F.concat_ws("/", F.lit(base), F.col(path)))
    listed = image_files(df.sparkSession, base).select(F.col("path").alias("_listed"))
    return names.join(listed, F.concat_ws("/", F.lit(_qualified(df.sparkSession, base)), F.col(path)) == F.col("_listed"), "left_semi")


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as its file system names it, the form in which files are listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
