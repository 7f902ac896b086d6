"""Exploratory summaries: every one is an aggregation, nothing is collected."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.presets import RISK_LEVELS
from riskframe.operators.prefix import exact_quantiles, group_quantiles, running_totals, value_bucket
from riskframe.operators.sizing import lookup_join
from riskframe.session import materialize

#: Distinct values whose neighbours are found in one task.
NEIGHBOUR_BLOCK = 4096


def _melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "feature") -> DataFrame:
    entries = [F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*keys, F.inline(F.array(*entries)))


def flag_prevalence(df: DataFrame, flags: Sequence[str], label: str) -> DataFrame:
    """Percentage of rows with each flag per class, long form."""
    means = df.groupBy(label).agg(*[F.avg(f).alias(f) for f in flags])
    rows = [F.struct(F.lit(f).alias("flag"), (F.col(f) * 100).alias("pct")) for f in flags]
    return means.select(label, F.inline(F.array(*rows)))


def long_prevalence(df: DataFrame, name: str, label: str, key: str = "patient_id") -> DataFrame:
    """Rows per class and name as a percentage of the distinct entities of the class (long flag table)."""
    entities = df.groupBy(label).agg(F.count_distinct(key).alias("n_entities"))
    counts = df.groupBy(label, name).agg(F.count(F.lit(1)).alias("n"))
    return lookup_join(counts, entities, [label]).select(
        label, name, (F.col("n") / F.col("n_entities") * 100).alias("pct")
    )


def describe_by(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles (linear) and maximum per class and column."""
    long = _melt(df, [label], columns).filter(F.col("value").isNotNull())
    keys = [label, "feature"]
    moments = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = group_quantiles(long, keys, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return moments.join(quartiles, keys).select(*keys, "n", "mean", "std", "min", "p25", "p50", "p75", "max")


def summarize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of each column in one scan, long form."""
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of each value; the share uses the total of the counts, not a second scan of the rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n"))
    return counts.withColumn("pct", F.col("n") / total.scalar() * 100)


def imbalance_ratio(df: DataFrame, column: str) -> DataFrame:
    """Number of classes and largest count over smallest count."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.count(F.lit(1)).alias("n_classes"), F.try_divide(F.max("n"), F.min("n")).alias("ratio"))


def flag_rate(df: DataFrame, flag: str, label: str) -> DataFrame:
    return df.groupBy(label).agg((F.avg(flag) * 100).alias("pct"))


def count_by(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct values per column, long form: one aggregation by (column, value)."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in columns]
    pairs = df.select(F.inline(F.array(*entries))).filter(F.col("v").isNotNull()).distinct()
    return pairs.groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"))


def correlations(df: DataFrame, columns: Sequence[str], per_row: int = 100) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete rows), always in one scan.

    Up to ``per_row`` pairs are columns of one aggregation. More are matrices of co-moments, added up per task and merged
    row by row, so that what is shuffled does not depend on the number of rows.
    """
    pairs = list(combinations(columns, 2))
    value = {c: F.col(c).cast("double") for c in columns}
    if len(pairs) <= per_row:
        rows = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.corr(value[a], value[b]).alias("r")) for a, b in pairs]
        return df.agg(F.array(*rows).alias("x")).select(F.inline("x"))
    packed = df.select(F.array(*[value[c] for c in columns]).alias("v"))
    size, names = len(columns), F.array(*[F.lit(c) for c in columns])
    parts = packed.mapInArrow(partial(_co_moments, size), "i int, n array<double>, m array<double>, mt array<double>, c array<double>, s array<double>")
    schema = "i int, j array<int>, n array<double>, c array<double>, s array<double>"
    merged = parts.groupBy("i").applyInArrow(_merged_co_moments, schema)  # one row per column and task
    entries = merged.select("i", F.inline(F.arrays_zip("j", "n", "c", "s")))
    other = F.min(F.when(F.col("i") > F.col("j"), F.col("s")))
    low, high = F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")
    both = entries.filter(F.col("i") != F.col("j")).groupBy(low, high).agg(
        F.max("n").alias("n"), F.max("c").alias("c"), F.min(F.when(F.col("i") < F.col("j"), F.col("s"))).alias("sa"), other.alias("sb")
    )
    r = F.when(F.col("n") >= 2, F.when((F.col("sa") > 0) & (F.col("sb") > 0), F.col("c") / F.sqrt(F.col("sa") * F.col("sb"))).otherwise(F.lit(float("nan"))))
    return both.select(F.get(names, F.col("a")).alias("feature_a"), F.get(names, F.col("b")).alias("feature_b"), r.alias("r"))


def _combine(one: tuple, two: tuple) -> tuple:
    """Merge counts, means, co-moments and square sums of pairs of columns (matrices or rows of them) of two sets of rows.

    Each is over the rows where both columns are present; ``m`` and ``s`` are of the first column, ``mt`` the mean of the other.
    """
    (na, ma, mta, ca, sa), (nb, mb, mtb, cb, sb) = one, two
    n = na + nb
    safe = np.where(n > 0, n, 1)
    d, dt, weight = mb - ma, mtb - mta, na * nb / safe
    return n, ma + d * nb / safe, mta + dt * nb / safe, ca + cb + d * dt * weight, sa + sb + d * d * weight


def _co_moments(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = tuple(np.zeros((size, size)) for _ in range(5))
    for batch in batches:
        flat = batch.column(0).flatten()
        if not len(flat):
            continue
        here = (~flat.is_null().to_numpy(zero_copy_only=False)).reshape(-1, size).astype(float)
        x = np.where(here > 0, flat.to_numpy(zero_copy_only=False).reshape(-1, size), 0.0)
        centre = x.sum(axis=0) / np.maximum(here.sum(axis=0), 1)
        x = (x - centre) * here
        n = here.T @ here
        sums, squares = x.T @ here, (x * x).T @ here
        safe = np.where(n > 0, n, 1)
        spread = squares - sums * sums / safe
        total = _combine(total, (n, centre[:, None] + sums / safe, centre[None, :] + sums.T / safe, x.T @ x - sums * sums.T / safe, spread))
    columns = [pa.array(np.arange(size, dtype=np.int32)), *[pa.array(list(part), pa.list_(pa.float64())) for part in total]]
    yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "m", "mt", "c", "s"])


def _merged_co_moments(table: pa.Table) -> pa.Table:
    parts = [np.stack(table[name].to_numpy()) for name in ("n", "m", "mt", "c", "s")]
    total = tuple(p[0] for p in parts)
    for k in range(1, len(table)):
        total = _combine(total, tuple(p[k] for p in parts))
    total[4][total[4] <= 64 * np.finfo(float).eps ** 2 * total[0] * total[1] ** 2] = 0.0  # a constant, up to rounding
    size = len(total[0])
    lists = [pa.array([part.tolist()], pa.list_(pa.float64())) for part in (total[0], total[3], total[4])]
    return pa.table([table["i"].slice(0, 1).combine_chunks(), pa.array([list(range(size))], pa.list_(pa.int32())), *lists], names=["i", "j", "n", "c", "s"])


def strongest_pairs(matrix: DataFrame, n: int = 10) -> DataFrame:
    return matrix.filter(F.col("r").isNotNull()).orderBy(F.abs("r").desc(), "feature_a", "feature_b").limit(n)


def level_counts(df: DataFrame, level: str = "risk_level", levels: Sequence[str] = RISK_LEVELS) -> DataFrame:
    """Count per level in a fixed order, zero for an absent level; one scan."""
    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias(level),
            F.sum(F.coalesce((F.col(level) == name).cast("long"), F.lit(0))).alias("n"),
        )
        for position, name in enumerate(levels)
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r")).withColumn("n", F.coalesce("n", F.lit(0)))


def cluster_profile(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Class mean over the largest value of the whole table (0 when that is not positive), long form."""
    largest = df.agg(F.struct(*[F.max(c).alias(c) for c in columns]).alias("m")).scalar()
    means = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.when(largest.getField(c) > 0, F.col(c) / largest.getField(c)).otherwise(F.lit(0.0)).alias("profile"),
        )
        for c in columns
    ]
    return means.select(label, F.inline(F.array(*rows)))


def mean_by(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    return df.groupBy(label).agg(*[F.avg(c).alias(c) for c in columns])


def histogram(df: DataFrame, column: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram between minimum and maximum; the last bin is closed; empty bins are absent."""
    limits = df.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).alias("x"))
    lo, hi = limits.scalar().getField("lo"), limits.scalar().getField("hi")
    low = F.when(lo == hi, lo - 0.5).otherwise(lo)
    width = F.when(lo == hi, F.lit(1.0)).otherwise(hi - lo)
    value = F.col(column).cast("double")
    bin_no = F.least(F.floor((value - low) / width * bins), F.lit(bins - 1)).cast("int")
    counts = df.filter(value.isNotNull()).groupBy(*by, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumns(
        {"bin_low": low + width * F.col("bin") / bins, "bin_high": low + width * (F.col("bin") + 1) / bins}
    )


def box_summary(df: DataFrame, columns: Sequence[str], label: str, reach: float = 1.5) -> DataFrame:
    """Quartiles and whiskers (most extreme values within ``reach`` quartile ranges) per class and column."""
    keys = [label, "feature"]
    long = _melt(df, [label], columns).filter(F.col("value").isNotNull() & F.col(label).isNotNull())
    quartiles = group_quantiles(long, keys, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    low = F.col("q1") - (F.col("q3") - F.col("q1")) * reach
    high = F.col("q3") + (F.col("q3") - F.col("q1")) * reach
    joined = lookup_join(long, quartiles, keys)
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.least(F.min(F.when(F.col("value") >= low, F.col("value"))), F.first("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(F.col("value") <= high, F.col("value"))), F.first("q3")).alias("whisker_high"),
    )


def class_weights(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """Balanced weight ``N / (K * n_c + 1e-6)`` per class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    return counts.withColumn(name, totals.getField("n") / (totals.getField("k") * F.col("n") + F.lit(1e-6)))


def with_class_weight(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    return lookup_join(df, class_weights(df, label, name).select(label, name), [label], "left")


def top_features(scores: DataFrame, n: int = 20, name: str = "feature", score: str = "importance") -> DataFrame:
    return scores.orderBy(F.desc(score), name).limit(n)


def top_labels(df: DataFrame, label: str, n: int = 10) -> DataFrame:
    return count_by(df.filter(F.col(label).isNotNull()), label).orderBy(F.desc("n"), label).limit(n)


def first_rows(df: DataFrame, key: str = "patient_id", n: int = 20) -> DataFrame:
    return df.orderBy(key).limit(n)


def mutual_information(df: DataFrame, columns: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) between each quantile-binned column and the class; NULL counts as 0."""
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    probs = [i / bins for i in range(1, bins)]
    melted = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), v.alias("x")) for c, v in value.items()])))
    names = {f"e{i}": p for i, p in enumerate(probs)}
    found = exact_quantiles(melted, ["feature"], "x", names, bounded_groups=True).select("feature", F.array(*names).alias("e"))
    edges = found.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col("e"))).alias(c) for c in columns]).alias("e")).scalar()
    # As a column of its own the subquery is planned once, not once for every edge.
    placed = df.withColumn("_edges", edges)

    def bin_of(c: str) -> Column:
        below = [(F.col("_edges").getField(c)[i] < value[c]).cast("int") for i in range(bins - 1)]
        return sum(below, F.lit(0))

    entries = [F.struct(F.lit(c).alias("feature"), bin_of(c).alias("bin")) for c in columns]
    named = F.coalesce(F.col(label), F.lit("unknown")).alias("class")
    joint = (
        placed.select(named, F.inline(F.array(*entries)))
        .groupBy("feature", "bin", "class")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The joint table has at most features x bins x classes rows.
    def total(*keys: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*keys))

    shares = joint.select(
        "feature",
        F.col("n").cast("double").alias("n"),
        total("feature").cast("double").alias("n_all"),
        total("feature", "bin").cast("double").alias("n_bin"),
        total("feature", "class").cast("double").alias("n_class"),
    )
    term = F.col("n") / F.col("n_all") * F.log(F.col("n") * F.col("n_all") / (F.col("n_bin") * F.col("n_class")))
    return shares.groupBy("feature").agg(F.greatest(F.sum(term), F.lit(0.0)).alias("mi_score"))


def digamma(n: Column) -> Column:
    """Digamma of a whole number of at least 1, by its series eight steps higher."""
    x = n.cast("double")
    y = x + 8.0
    square = 1.0 / (y * y)
    series = F.log(y) - 0.5 / y - square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square / 240)))
    return series - sum((1.0 / (x + float(i)) for i in range(8)), F.lit(0.0))


def mutual_information_nearest(
    df: DataFrame, columns: Sequence[str], label: str, k: int = 3, block: int = NEIGHBOUR_BLOCK
) -> DataFrame:
    """Mutual information (nats) of each column and the class by nearest neighbours, without bins; NULL counts as 0.

    For every row the distance to the ``k``-th neighbour of its class (fewer in a small class) is compared with the number of rows
    of any class that are nearer. Equal values are counted first. Neighbours are found in blocks of consecutive values, each of which gets the
    ``k`` values beyond its borders; the numbers of nearer rows are differences of running counts. Classes of one row are left out.
    """
    keys, value = ["feature", "class"], {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    named = F.coalesce(F.col(label).cast("string"), F.lit("unknown")).alias("class")
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), x.alias("x")) for c, x in value.items()])
    counts = df.select(named, F.inline(entries)).groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(
        materialize(counts), keys, ["x"], {"r": F.lit(1).cast("long"), "c": F.col("n")}, value_bucket("x")
    ).filter(F.col("c_total") > 1)
    own, within = F.floor(F.col("r_before") / block), F.pmod("r_before", F.lit(block))
    blocks = F.array(
        own, F.when((within < k) & (own > 0), own - 1), F.when(within >= block - k, own + 1)
    )
    staged = placed.withColumn("_own", own).withColumn("_block", F.explode(F.array_compact(blocks)))
    around = Window.partitionBy(*keys, "_block").orderBy("x").rowsBetween(-k, k)
    near = staged.withColumn("_near", F.collect_list(F.struct("x", "n")).over(around)).filter(F.col("_own") == F.col("_block"))
    wanted = F.least(F.lit(k).cast("long"), F.col("c_total") - 1)
    others = F.array_sort(
        F.transform("_near", lambda p: F.struct(F.abs(p["x"] - F.col("x")).alias("d"), (p["n"] - (p["x"] == F.col("x")).cast("long")).alias("n")))
    )
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0.0).alias("d"))
    reach = F.aggregate(
        others, start,
        lambda s, p: F.when(s["seen"] < F.col("_k"), F.struct((s["seen"] + p["n"]).alias("seen"), p["d"].alias("d"))).otherwise(s),
        lambda s: s["d"],
    )
    points = near.withColumn("_k", wanted).select(*keys, "x", "n", F.col("c_total").alias("c"), "_k", reach.alias("d"))
    points = materialize(points)

    def asked(q: Column, after: Column, sign: int) -> Column:
        side = F.when(after, F.lit(2)).otherwise(F.lit(0))  # before or behind the rows of the same value
        return F.struct(q.alias("q"), side.alias("side"), F.lit(sign).alias("sign"))

    apart = F.col("d") > 0
    bounds = F.array(asked(F.col("x") + F.col("d"), ~apart, 1), asked(F.col("x") - F.col("d"), apart, -1))
    zero = F.lit(0).cast("long")
    questions = points.select(*keys, "x", "n", "c", "_k", F.inline(bounds), zero.alias("w"))
    rows = points.select(*keys, "x", "n", "c", "_k", F.col("x").alias("q"), F.lit(1).alias("side"), F.lit(0).alias("sign"), F.col("n").alias("w"))
    counted = running_totals(questions.union(rows), ["feature"], ["q", "side"], {"w": F.col("w")}, value_bucket("q"))
    nearer = counted.filter("sign <> 0").groupBy(*keys, "x", "n", "c", "_k").agg(F.sum(F.col("sign") * F.col("w_before")).alias("m"))
    term = F.col("n") * (digamma(F.col("_k")) - digamma(F.col("c")) - digamma(F.col("m")))
    sums = nearer.groupBy("feature").agg(F.sum(term).alias("_t"), F.sum("n").alias("_n"))
    return sums.select("feature", F.greatest(digamma(F.col("_n")) + F.col("_t") / F.col("_n"), F.lit(0.0)).alias("mi_score"))


def standardize_columns(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
        ).alias("x")
    ).scalar()
    return df.withColumns(
        {
            f"{c}{suffix}": (F.col(c).cast("double") - moments.getField(f"m_{c}"))
            / F.when(moments.getField(f"s_{c}") > 0, moments.getField(f"s_{c}")).otherwise(F.lit(1.0))
            for c in columns
        }
    )
