"""Two-pass external shuffle into shards of equal row counts.

Pass one scatters the rows by a seeded hash of key and text into buckets whose expected size is
``bucket_bytes``; pass two loads one bucket at a time, puts it into a canonical order (so that a rerun task
sees the same rows in the same order), shuffles it with Fisher-Yates under a seed of its own and writes it. The
buckets one after the other are a random permutation of all rows; shard ``s`` of ``n`` shards is its
``s``-th stretch, so row counts differ by at most one. Only counts per bucket are gathered in between.

Defined results: a null text has zero bytes; null keys are allowed; equal texts under different keys are
scattered like any others; rows equal in key and text are told apart by nothing and share a bucket; an empty
table gives an empty table; input columns named like the added ones keep their name, and the added ones get
an underscore.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from riskframe.llm.common import fresh, new_folder, saved, small_join

SHARDS, BUCKET_BYTES, OVERHEAD, SEED = 40, 16 << 20, 16, 7


def fisher_yates(count: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of ``count`` places; ``Generator.shuffle`` is the Fisher-Yates algorithm."""
    order = np.arange(count)
    np.random.default_rng([seed, bucket]).shuffle(order)
    return order


def shuffle_to_shards(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
                      bucket_bytes: int = BUCKET_BYTES, seed: int = SEED, folder: str | None = None) -> DataFrame:
    """Write ``df`` in shuffled order to ``folder`` (by shard) and return what is read back.

    The rows come with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).
    """
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + OVERHEAD
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    mark = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    rows = df.select(mark.alias("mark"), F.pmod("mark", F.lit(buckets)).alias("bucket"), F.struct("*").alias("row"))
    counts = df.select(F.pmod(mark, F.lit(buckets)).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = saved(counts, "buckets")
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))  # one short row per bucket
    starts = saved(counts.select("bucket", F.coalesce(before, F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("all")), "starts")
    names = fresh(df, "shard"), fresh(df, "slot")

    def run(key: tuple, bucket: pa.Table) -> pa.Table:
        canonical = bucket.take(pa.compute.sort_indices(bucket, [("mark", "ascending")]))
        order = fisher_yates(len(canonical), seed, key[0].as_py())
        mixed = canonical.take(pa.array(order))
        first, every = mixed.column("start")[0].as_py(), mixed.column("all")[0].as_py()
        places = first + np.arange(len(mixed), dtype=np.int64)
        shard = (shards * (places + 1) - 1) // every
        slot = places - shard * every // shards
        return pa.table({"row": mixed.column("row"), names[0]: pa.array(shard, pa.int32()), names[1]: pa.array(slot, pa.int64())})

    schema = StructType([StructField("row", df.schema), StructField(names[0], IntegerType()), StructField(names[1], LongType())])
    mixed = small_join(rows, starts, "bucket").groupBy("bucket").applyInArrow(run, schema).sortWithinPartitions(*names)
    folder = folder or new_folder(df.sparkSession, "shards")
    mixed.select("row.*", *names).write.partitionBy(names[0]).parquet(folder)
    schema = StructType([*df.schema.fields, *[StructField(names[1], LongType()), StructField(names[0], IntegerType())]])
    return df.sparkSession.read.schema(schema).parquet(folder).select(*df.columns, *names)
