"""Shared pieces: saved intermediate tables, checked broadcasts, the hash that makes folds and samples."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir

#: Rows that are at most 64 bytes wide may be broadcast up to this number (64 MB); beyond it a shuffle is used.
BROADCAST_ROWS = 1_000_000
SALTS = 64
HASH_BITS = 12
WHITE = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own in the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str = "step") -> DataFrame:
    """Write an intermediate table to the shared folder and continue from there; lost tasks reread it."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small_join(big: DataFrame, small: DataFrame, on: list[str] | Column, how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a saved table of narrow rows: broadcast while its counted size is bounded, else an ordinary join.

    ``small`` must be cheap to read twice (saved or a scan of a small file). ``rows`` may be greater for narrower rows.
    """
    if small.limit(rows + 1).count() <= rows:
        small = F.broadcast(small)
    return big.join(small, on, how)


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key written as text, modulo ``folds``; null without a key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


def sample_keys(df: DataFrame, key: str, label: str, per_label: int, seed: int = 0) -> DataFrame:
    """The ``per_label`` rows (key, label) of each label that come first by a seeded hash of the key.

    Rows are counted per label and part of the hash range before anything is shuffled. Only the parts up to the one in which a label
    reaches its number are ranked: about ``per_label`` rows and one in ``2**HASH_BITS`` of the label's, dealt over ``SALTS`` tasks first.
    """
    rows = df.select(key, label, F.xxhash64(F.lit(seed), F.col(key)).alias("_order"))
    rows = rows.withColumn("_range", F.shiftright("_order", 64 - HASH_BITS))
    counts = rows.groupBy(F.col(label).alias("_label"), "_range").agg(F.count(F.lit(1)).alias("_n"))
    lower = Window.partitionBy("_label").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(lower), F.lit(0))
    cuts = counts.withColumn("_before", before).filter(F.col("_before") < per_label).groupBy("_label").agg(F.max("_range").alias("_cut"))
    cuts = saved(cuts, "cuts")  # one row per label
    rows = small_join(rows, cuts, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_range") <= F.col("_cut")))
    rows = rows.select(key, label, "_order", F.pmod("_order", F.lit(SALTS)).alias("_part"))
    for group in ([label, "_part"], [label]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy("_order", key))
        rows = rows.withColumn("_rank", rank).filter(F.col("_rank") <= per_label)
    return rows.select(key, label)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made different from every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: str) -> list[bytes]:
    """Words between blanks, tabs and line ends (U+0020, U+0009 to U+000D), as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterable[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def parts_for(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))


def has_letter(text: str | None) -> bool:
    """Whether a text has a letter; numbers of any kind, such as fractions and numerals, are none."""
    return bool(text) and any(map(str.isalpha, text))


def finite_vectors(df: DataFrame, key: str, vector: str, dims: int | None = None) -> DataFrame:
    """(key, vector) of the rows whose vector has ``dims`` entries (if given), none of them null, NaN or infinite."""
    whole = F.col(vector).cast("array<double>")
    good = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    if dims is not None:
        good = good & (F.size(whole) == dims)
    return df.filter(F.coalesce(good, F.lit(False))).select(F.col(key), whole.alias("vector"))


def vectors_of(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors of a batch as a matrix."""
    return batch.column(batch.schema.get_field_index("vector")).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
