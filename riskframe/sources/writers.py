"""Sinks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialize


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet partitioned by low-cardinality columns."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_bucketed(
    df: DataFrame, path: str, key: str = "patient_id", buckets: int = 64, mode: str = "overwrite", rows_per_file: int = 5_000_000
) -> None:
    """Parquet in ``buckets`` folders by the hash of the key (one folder per key would be one file per entity).

    The rows of the fullest bucket are counted first: each bucket is written by as many tasks as keep a file
    of that bucket below ``rows_per_file``, chosen by a second hash. Every such part is a task of its own: dealt by a hash of the part,
    some tasks would get several, and sort the rows of all of them.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")
    others = [F.col(c) for c, t in df.dtypes if not t.startswith("map")]
    largest = df.select(bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    tasks = max(1, -(-largest // rows_per_file))
    part = F.pmod(F.hash(*others), F.lit(tasks))
    spread = df.select("*", bucket).repartitionById(buckets * tasks, F.col("bucket") * F.lit(tasks) + part)
    spread.write.mode(mode).partitionBy("bucket").parquet(path)


def write_colocated(df: DataFrame, name: str, path: str, key: str = "patient_id", buckets: int = 64) -> DataFrame:
    """A catalog table ``name`` bucketed and sorted by the key, with its files at ``path``; returns the table.

    Tables with the same number of buckets join on the key, and are grouped by it, without an exchange. Every bucket is one file.
    """
    ordered = df.repartition(buckets, key).sortWithinPartitions(key)
    writer = ordered.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def write_files(df: DataFrame, root: str, name: str = "path", content: str = "content") -> DataFrame:
    """One file per row below ``root``, written by the tasks; gives the saved ``(name, length)`` of every file.

    A file is put in place when it is complete, so a task that runs again leaves the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            names, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for file, body in zip(names, bodies, strict=True):
                target = f"{base}/{file}"
                draft = f"{target}.{uuid.uuid4().hex}.draft"
                system.create_dir(target.rpartition("/")[0], recursive=True)
                with system.open_output_stream(draft) as stream:
                    stream.write(body or b"")
                system.move(draft, target)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(b or b"") for b in bodies], pa.int64())], names=[name, "length"])

    rows = df.filter(F.col(name).isNotNull()).select(F.col(name).cast("string"), F.col(content).cast("binary"))
    return materialize(rows.mapInArrow(run, f"`{name}` string, length bigint"))


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; array and map columns become JSON text."""
    columns = [
        F.to_json(f.name).alias(f.name) if f.dataType.simpleString().startswith(("array", "map", "struct")) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*columns).write.mode(mode).option("header", "true").option("escape", '"').csv(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long metrics table as JSON lines."""
    metrics.coalesce(1).write.mode(mode).json(path)


def write_comparison(comparison: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One row per model, as CSV."""
    comparison.coalesce(1).write.mode(mode).option("header", "true").csv(path)
