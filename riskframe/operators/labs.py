"""Measurements against reference ranges: fences, flags, deviations, panels and trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.functions.presets import LAB_CRITICAL, LAB_PANELS, LAB_RANGES, RANGE_DIMENSION
from riskframe.functions.rules import clamp
from riskframe.operators.clean import out_of_range, require
from riskframe.operators.prefix import BUCKET_ROWS, adaptive_buckets, exact_quantiles
from riskframe.operators.sizing import lookup_join
from riskframe.session import materialize

Ranges = dict[str, tuple[float, float]]


def iqr_fences(
    df: DataFrame, group: str = "test_name", value: str = "value", width: float = 3.0
) -> DataFrame:
    """Exact quartiles and outlier fences per group; a group without values has NULL fences."""
    found = exact_quantiles(df, [group], value, {"q1": 0.25, "q3": 0.75})
    quartiles = df.select(group).distinct().join(found, group, "left")
    q1, q3 = F.col("q1"), F.col("q3")
    return quartiles.select(
        group,
        q1.alias("q1"),
        q3.alias("q3"),
        (q1 - (q3 - q1) * width).alias("fence_low"),
        (q3 + (q3 - q1) * width).alias("fence_high"),
    )


def drop_outliers(
    df: DataFrame, group: str = "test_name", value: str = "value", width: float = 3.0
) -> DataFrame:
    """Keep the rows inside the fences of their group; a NULL value is outside.

    Groups and values are saved once for the fences; the rows themselves are only read by the filter.
    """
    fences = iqr_fences(materialize(df.select(group, value)), group, value, width).select(group, "fence_low", "fence_high")
    inside = (F.col(value) >= F.col("fence_low")) & (F.col(value) <= F.col("fence_high"))
    return lookup_join(df, fences, [group]).filter(inside).select(*df.columns)


def abnormal_flag(value: str = "value", low: str = "reference_low", high: str = "reference_high") -> Column:
    return out_of_range(value, F.col(low), F.col(high)).cast("int")


def range_dimension(spark: SparkSession, rows: Sequence[tuple] = RANGE_DIMENSION) -> DataFrame:
    """Reference ranges as a table; ``sex`` is NULL where the range is not split."""
    return spark.createDataFrame(
        list(rows),
        "test_name string, sex string, low double, high double, critical_low double, critical_high double, unit string",
    )


def with_ranges(df: DataFrame, dimension: DataFrame, test: str = "test_name", sex: str = "sex") -> DataFrame:
    """Attach the reference range of each measurement; a sex-specific range wins over the general one.

    The dimension is an ordinary table; Spark broadcasts it when its size allows.
    """
    fields = [c for c in dimension.columns if c not in ("test_name", "sex")]

    def side(prefix: str) -> list[Column]:
        return [F.col(c).alias(f"{prefix}{c}") for c in fields]

    general = dimension.filter(F.col("sex").isNull()).select(F.col("test_name").alias(test), *side("_g_"))
    specific = dimension.filter(F.col("sex").isNotNull()).select(
        F.col("test_name").alias(test), F.col("sex").alias(sex), *side("_s_")
    )
    joined = df.join(specific, [test, sex], "left").join(general, test, "left")
    return joined.select(*df.columns, *[F.coalesce(f"_s_{c}", f"_g_{c}").alias(c) for c in fields])


def _present(df: DataFrame, ranges: dict) -> list[str]:
    return [name for name in ranges if name in df.columns]


def deviation(value: str | Column, low: float, high: float) -> Column:
    """Distance from the middle of the range in half ranges; an empty range counts as half range 1."""
    value = F.col(value) if isinstance(value, str) else value
    half = (high - low) / 2.0 or 1.0
    return (value.cast("double") - F.lit((low + high) / 2.0)) / F.lit(half)


def with_deviations(df: DataFrame, ranges: Ranges = LAB_RANGES) -> DataFrame:
    """``<test>_deviation`` for every test that has a column."""
    return df.withColumns({f"{t}_deviation": deviation(t, *ranges[t]) for t in _present(df, ranges)})


def with_abnormality_count(df: DataFrame, ranges: Ranges = LAB_RANGES) -> DataFrame:
    flags = [out_of_range(F.col(t).cast("double"), *ranges[t]).cast("int") for t in _present(df, ranges)]
    return df.withColumn("abnormality_count", sum(flags, F.lit(0)))


def with_critical_flags(df: DataFrame, thresholds: Ranges = LAB_CRITICAL) -> DataFrame:
    """``<test>_critical`` for every test that has a column, and their sum."""
    flags = {
        f"{t}_critical": out_of_range(F.col(t).cast("double"), *thresholds[t]).cast("int")
        for t in _present(df, thresholds)
    }
    return df.withColumns({**flags, "total_critical_flags": sum(flags.values(), F.lit(0))})


def with_panel_scores(df: DataFrame, panels: dict[str, list[str]] = LAB_PANELS) -> DataFrame:
    """Mean absolute deviation per panel over the deviation columns that exist; NULL adds 0."""
    scores = {}
    for panel, tests in panels.items():
        sizes = [
            F.abs(F.coalesce(F.col(f"{t}_deviation"), F.lit(0.0))) for t in tests if f"{t}_deviation" in df.columns
        ]
        scores[panel] = sum(sizes, F.lit(0.0)) / F.lit(float(max(len(sizes), 1)))
    return df.withColumns(scores)


def with_rule_risk(df: DataFrame, ranges: Ranges, name: str = "rule_risk") -> DataFrame:
    """Share of abnormal tests in 0-1: far outside (half a span or more) counts 1, outside 0.5.

    The divisor is the number of all ranges, whether or not the column exists; NULL is normal.
    """
    points = []
    for test in _present(df, ranges):
        low, high = ranges[test]
        value, margin = F.col(test).cast("double"), 0.5 * (high - low)
        far = out_of_range(value, low - margin, high + margin)
        points.append(F.when(far, F.lit(1.0)).when(out_of_range(value, low, high), F.lit(0.5)).otherwise(F.lit(0.0)))
    total = sum(points, F.lit(0.0)) / F.lit(float(max(len(ranges), 1)))
    return df.withColumn(name, clamp(total, 0.0, 1.0))


def combined_risk(ml: str | Column, rule: str | Column, ml_weight: float = 0.6, rule_weight: float = 0.4) -> Column:
    ml = F.col(ml) if isinstance(ml, str) else ml
    rule = F.col(rule) if isinstance(rule, str) else rule
    return clamp(ml * F.lit(ml_weight) + rule * F.lit(rule_weight), 0.0, 1.0)


def trend_slopes(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    bucket: Column,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Least-squares slope of each value against the row's ordinal within its group; 0 when undefined.

    One row per group. ``bucket`` is monotone along ``order``: ordinals are counted inside a bucket and
    shifted by the size of the earlier buckets, and all sums are mergeable, so a group with very many
    rows is spread over its buckets. A bucket with more than ``bucket_rows`` rows of a group is cut further.
    """
    require(df, [*keys, *order, *values])
    keys = list(keys)
    narrow = df.select(*keys, *order, *[F.col(v).cast("double").alias(v) for v in values])
    staged = adaptive_buckets(narrow, keys, order, bucket, bucket_rows)
    local = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = staged.withColumn("_r", F.row_number().over(local).cast("double"))
    sums = [F.count(F.lit(1)).cast("double").alias("_rows")]
    for v in values:
        y = F.col(v)
        r = F.when(y.isNotNull(), F.col("_r"))
        sums += [
            F.count(y).cast("double").alias(f"_n_{v}"),
            F.sum(r).alias(f"_r_{v}"),
            F.sum(r * r).alias(f"_rr_{v}"),
            F.sum(y).alias(f"_y_{v}"),
            F.sum(r * y).alias(f"_ry_{v}"),
        ]
    per_bucket = numbered.groupBy(*keys, "_bucket").agg(*sums)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifted = per_bucket.withColumn("_o", F.coalesce(F.sum("_rows").over(before), F.lit(0.0)))
    o = F.col("_o")
    totals, slopes = [], []
    for v in values:
        n, r, rr, y, ry = (F.col(f"_{p}_{v}") for p in ("n", "r", "rr", "y", "ry"))
        totals += [
            F.sum(n).alias(f"n_{v}"),
            F.sum(n * o + r).alias(f"x_{v}"),
            F.sum(n * o * o + o * r * 2 + rr).alias(f"xx_{v}"),
            F.sum(y).alias(f"y_{v}"),
            F.sum(o * y + ry).alias(f"xy_{v}"),
        ]
        n, x, xx, y, xy = (F.col(f"{p}_{v}") for p in ("n", "x", "xx", "y", "xy"))
        spread = n * xx - x * x
        slopes.append(F.when(spread != 0, (n * xy - x * y) / spread).otherwise(F.lit(0.0)).alias(f"{v}_trend"))
    return shifted.groupBy(*keys).agg(*totals).select(*keys, *slopes)


def with_trends(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], bucket: Column
) -> DataFrame:
    """Every row with the slopes of its group."""
    return lookup_join(df, trend_slopes(df, keys, order, values, bucket), list(keys), "left")


def long_deviations(df: DataFrame, value: str = "value", low: str = "low", high: str = "high") -> DataFrame:
    """Deviation column of a long table that carries its own range."""
    half = F.when(F.col(high) == F.col(low), F.lit(1.0)).otherwise((F.col(high) - F.col(low)) / 2.0)
    middle = (F.col(low) + F.col(high)) / 2.0
    return df.withColumn("deviation", (F.col(value).cast("double") - middle) / half)
