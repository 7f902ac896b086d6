"""Ordered running totals, ranks and quantiles that do not put a whole group into one task.

A plain window over a group sorts the group in one task. Here every group is cut into ordered
buckets by a monotone expression of the sort column. Totals per bucket are partially aggregated and
accumulated over the (few) buckets; the exact order is only resolved inside a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.rules import as_column
from riskframe.session import materialize

STEPS_PER_OCTAVE = 1024
#: Rows of a group that one bucket may hold before it is cut further.
BUCKET_ROWS = 200_000
BRACKET_ACCURACY = 10_000


def value_bucket(value: str | Column) -> Column:
    """Monotone bucket of a number: its sign and the logarithm of its size."""
    value = as_column(value).cast("double")
    size = F.floor(F.log2(F.abs(value)) * F.lit(STEPS_PER_OCTAVE)) + F.lit(1100 * STEPS_PER_OCTAVE)
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value).cast("long") * size).cast("long")


def hash_bucket(hex_digest: str | Column) -> Column:
    """Monotone bucket of a hexadecimal digest: its first three digits (4096 buckets)."""
    return F.conv(F.substring(as_column(hex_digest), 1, 3), 16, 10).cast("int")


def adaptive_buckets(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, limit: int = BUCKET_ROWS
) -> DataFrame:
    """``df`` with ``_bucket``, ordered like the rows of a group, in which no bucket has many more than ``limit`` rows.

    The first part of ``_bucket`` is the caller's ``bucket``, a monotone expression such as a day. Where a group has more than
    ``limit`` rows in one of them, these rows alone are cut at splitters sampled from the order columns (range partitioning), and
    their range is the second part. Rows that are equal in all order columns stay together.
    """
    from riskframe.operators.sizing import lookup_join

    keys = list(keys)
    staged = df.withColumn("_first", bucket)
    sizes = staged.groupBy(*keys, "_first").agg(F.count(F.lit(1)).alias("_rows"))
    full = materialize(sizes.filter(F.col("_rows") > limit))
    whole = full.agg(F.sum("_rows")).first()[0]
    if not whole:
        return staged.withColumn("_bucket", F.struct(F.col("_first").alias("first"), F.lit(0).alias("part"))).drop("_first")
    marked = lookup_join(staged, full, [*keys, "_first"], "left")
    large = marked.filter(F.col("_rows").isNotNull())
    parts = 2 * -(-whole // limit)
    cut = materialize(large.repartitionByRange(parts, *keys, "_first", *order).withColumn("_part", F.spark_partition_id()))
    rest = marked.filter(F.col("_rows").isNull()).withColumn("_part", F.lit(0))
    both = F.struct(F.col("_first").alias("first"), F.col("_part").alias("part"))
    return cut.unionByName(rest).withColumn("_bucket", both).select(*df.columns, "_bucket")


def adjacent_pairs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], last: str, first: str, bucket: Column, limit: int = BUCKET_ROWS
) -> DataFrame:
    """(keys, before, after) for every two rows of a group that follow each other: ``last`` of the one and ``first`` of the other.

    Neighbours are found inside buckets; the pairs across buckets come from one row per bucket. ``first`` must not be null.
    """
    keys = list(keys)
    staged = adaptive_buckets(df, keys, order, bucket, limit)
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    inside = staged.select(*keys, F.col(last).alias("before"), F.lead(first).over(inner).alias("after"))
    place = F.struct(*order)
    ends = staged.groupBy(*keys, "_bucket").agg(F.min_by(first, place).alias("_f"), F.max_by(last, place).alias("before"))
    across = ends.select(*keys, "before", F.lead("_f").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("after"))
    return inside.union(across).filter(F.col("after").isNotNull())


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    measures: dict[str, Column],
    bucket: Column | str,
) -> DataFrame:
    """Add ``<name>_before`` (total of all earlier rows of the group) and ``<name>_total`` per measure.

    ``order`` must be a total order of the rows of a group and ``bucket`` must not decrease along it.
    """
    keys = list(keys)
    staged = df.withColumns({"_bucket": as_column(bucket), **{f"_m_{n}": c for n, c in measures.items()}})
    per_bucket = staged.groupBy(*keys, "_bucket").agg(*[F.sum(f"_m_{n}").alias(f"_s_{n}") for n in measures])
    group = Window.partitionBy(*keys)
    earlier_buckets = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_bucket").alias("_k__bucket"),
        *[F.coalesce(F.sum(f"_s_{n}").over(earlier_buckets), F.lit(0)).alias(f"_o_{n}") for n in measures],
        *[F.sum(f"_s_{n}").over(group).alias(f"{n}_total") for n in measures],
    )
    earlier_rows = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = staged.withColumns(
        {f"_l_{n}": F.coalesce(F.sum(f"_m_{n}").over(earlier_rows), F.lit(0)) for n in measures}
    )
    return local.join(offsets, _same(local, offsets, [*keys, "_bucket"])).select(
        *df.columns,
        *[(F.col(f"_o_{n}") + F.col(f"_l_{n}")).alias(f"{n}_before") for n in measures],
        *[F.col(f"{n}_total") for n in measures],
    )


def group_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], bucket: Column, name: str = "rank"
) -> DataFrame:
    """Add the 1-based position of a row in its group as ``name`` and the group size as ``<name>_of``."""
    counted = running_totals(df, keys, order, {name: F.lit(1).cast("long")}, bucket)
    return counted.select(
        *df.columns, (F.col(f"{name}_before") + 1).alias(name), F.col(f"{name}_total").alias(f"{name}_of")
    )


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], interpolate: bool = True
) -> DataFrame:
    """Exact quantiles per group, one column per entry of ``probs``.

    Equal values are counted before the shuffle. ``interpolate`` gives the linear rule
    (rank ``(n-1)p``); without it the lowest value whose share reaches ``p``.
    """
    keys = list(keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, keys, [value], {"n": F.col("n")}, value_bucket(value))
    first, last = F.col("n_before"), F.col("n_before") + F.col("n") - 1
    picks, results = [], []
    for name, p in probs.items():
        if interpolate:
            position = (F.col("n_total") - 1) * F.lit(float(p))
        else:
            position = F.greatest(F.ceil(F.col("n_total") * F.lit(float(p))) - 1, F.lit(0)).cast("double")
        for side, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.max(F.when((first <= index) & (index <= last), F.col(value))).alias(f"_{side}_{name}"))
        picks.append(F.max(position - F.floor(position)).alias(f"_part_{name}"))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        results.append((low + (high - low) * F.col(f"_part_{name}")).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *results)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    bounded_groups: bool = False,
    accuracy: int = BRACKET_ACCURACY,
) -> DataFrame:
    """Exact lower quantiles per group (the lowest value whose share reaches the probability), at every size.

    A mergeable summary only brackets each quantile (its rank error is at most ``1 / accuracy``). The rows
    below the bracket are counted, and only those inside it (a few in ``accuracy``) are ordered.
    ``bounded_groups`` says that there are few groups, so that their brackets are broadcast unchecked.
    """
    from riskframe.operators.sizing import lookup_join

    keys, names = list(keys), list(probs)
    some = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    margin = 2.0 / accuracy
    points = [x for p in probs.values() for x in (max(0.0, p - margin), min(1.0, p + margin))]
    brackets = some.groupBy(*keys).agg(F.percentile_approx("_v", points, accuracy).alias("_b"))
    placed = some.join(F.broadcast(brackets), keys) if bounded_groups else lookup_join(some, brackets, keys)
    low = [F.col("_b")[2 * i] for i in range(len(names))]
    high = [F.col("_b")[2 * i + 1] for i in range(len(names))]
    below = [F.sum((F.col("_v") < x).cast("long")).alias(f"_below{i}") for i, x in enumerate(low)]
    sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *below)
    which = F.array(
        *[F.when((F.col("_v") >= a) & (F.col("_v") <= b), F.lit(i)) for i, (a, b) in enumerate(zip(low, high, strict=True))]
    )
    inside = placed.select(*keys, "_v", F.explode(F.array_compact(which)).alias("_i"))
    counts = inside.groupBy(*keys, "_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_totals(counts, [*keys, "_i"], ["_v"], {"_c": F.col("_c")}, value_bucket("_v"))
    joined = ranked.join(sizes, keys)
    picks = []
    for i, (name, p) in enumerate(probs.items()):
        need = F.greatest(F.ceil(F.col("_n") * F.lit(float(p))), F.lit(1)) - F.col(f"_below{i}")
        reached = (F.col("_i") == i) & (F.col("_c_before") + F.col("_c") >= need)
        picks.append(F.min(F.when(reached, F.col("_v"))).alias(name))
    return joined.groupBy(*keys).agg(*picks)
