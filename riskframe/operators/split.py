"""Deterministic sampling and splitting by the hash of the key: independent of partitioning and of retries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.prefix import hash_bucket
from riskframe.operators.sizing import lookup_join

#: Rows per group up to which Spark prunes a ranking in the map tasks.
PRUNED = 1000


def key_digest(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def digest_number(digest: Column) -> Column:
    """First 32 bits of a digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def stratified_split(
    df: DataFrame, label: str, key: str = "patient_id", train_share: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add ``is_train``: exactly ``floor(share * n)`` rows of every class.

    Rows are counted per class and digest bucket. All buckets before the one in which the share is reached
    are training rows, all after it are not; only the rows of that one bucket are ranked. The cuts are one row
    per class, so the table itself is neither sorted nor joined by a shuffle while there are few classes.
    """
    share = lambda n: F.floor(n * F.lit(train_share))
    sure, border = _first_of_class(df, label, key, seed, share)
    return sure.unionByName(border).select(*df.columns, F.col("_first").alias("is_train"))


def _first_of_class(
    df: DataFrame, label: str, key: str, seed: int, wanted_of: Callable[[Column], Column]
) -> tuple[DataFrame, DataFrame]:
    """The rows with ``_first``: whether a row is among the wanted number of its class, in the order of the digests. First the rows that
    their digest bucket alone decides, then the ranked rows of the one open bucket of each class."""
    names = df.columns
    staged = df.select("*", hash_bucket(key_digest(key, seed)).alias("_bucket"))
    counts = staged.groupBy(F.col(label).alias("_class"), "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("_class")
    before = F.coalesce(F.sum("_n").over(group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = wanted_of(F.sum("_n").over(group))
    placed = counts.select("_class", "_bucket", before.alias("_before"), wanted.alias("_wanted"), "_n")
    inside = (F.col("_before") <= F.col("_wanted")) & (F.col("_wanted") < F.col("_before") + F.col("_n"))
    cuts = placed.filter(inside | (F.col("_before") + F.col("_n") == F.col("_wanted"))).groupBy("_class").agg(
        F.max_by(F.struct(F.col("_bucket").alias("b"), (F.col("_wanted") - F.col("_before")).alias("open")), "_bucket").alias("_cut")
    )
    marked = lookup_join(staged.withColumn("_class", F.col(label)), cuts, ["_class"])
    sure = marked.filter(F.col("_bucket") != F.col("_cut.b")).select(*names, (F.col("_bucket") < F.col("_cut.b")).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("_class").orderBy(key_digest(key, seed), key))
    border = marked.filter(F.col("_bucket") == F.col("_cut.b"))
    return sure, border.select(*names, (rank <= F.col("_cut.open")).alias("_first"))


def sample_per_class(df: DataFrame, label: str, n: int, key: str = "patient_id", seed: int = 42) -> DataFrame:
    """``n`` rows of every class (all rows of a smaller class), the first by the digest of their key.

    Up to ``PRUNED`` rows, map tasks hand on at most ``n`` rows of a class. For more, the rows are counted per digest bucket, and only
    one bucket of a class is ranked. Rows without a class are left out of the second form's joins, so they form no class in either.
    """
    df = df.filter(F.col(label).isNotNull())
    if n > PRUNED:
        sure, border = _first_of_class(df, label, key, seed, lambda total: F.least(total, F.lit(n).cast("long")))
        return sure.unionByName(border).filter("_first").select(*df.columns)
    rank = F.row_number().over(Window.partitionBy(label).orderBy(key_digest(key, seed), key))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).select(*df.columns)


def random_split(df: DataFrame, key: str = "patient_id", train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``is_train`` by a hash threshold, without any shuffle."""
    limit = int(train_share * 2**32)
    return df.withColumn("is_train", digest_number(key_digest(key, seed)) < F.lit(limit))


def with_fold(df: DataFrame, key: str = "patient_id", k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add the fold number 0 to k-1."""
    return df.withColumn(name, F.pmod(digest_number(key_digest(key, seed)), F.lit(k)).cast("int"))
