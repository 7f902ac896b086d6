"""Bringing tables together: one row per entity, joins, pivots and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.rules import as_column
from riskframe.operators.clean import prefix_columns, require
from riskframe.operators.prefix import BUCKET_ROWS, adaptive_buckets, running_totals
from riskframe.operators.profile import with_completeness
from riskframe.operators.sizing import skewed_join


def latest_rows(df: DataFrame, keys: Sequence[str], time: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """The latest row per key. ``row_number() = 1`` is pruned on the map side (WindowGroupLimit), so a
    key with very many rows sends one row per map task through the shuffle."""
    require(df, [*keys, time, *tie_break])
    order = [F.col(time).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def integrate_entities(
    spine: DataFrame,
    parts: dict[str, tuple[DataFrame, str | None, Sequence[str]]],
    key: str = "patient_id",
    completeness_name: str = "data_completeness_score",
) -> DataFrame:
    """Left-join every part onto the spine, one row per entity, and score the completeness of each row.

    ``parts`` maps a column prefix to ``(table, time column or None, tie-break columns)``. A table with a
    time column is first reduced to the latest row per entity; None means it already has one.
    """
    joined = spine
    for prefix, (table, time, tie_break) in parts.items():
        one = table if time is None else latest_rows(table, [key], time, tie_break)
        joined = joined.join(prefix_columns(one, prefix, (key,)), key, "left")
    return with_completeness(joined, completeness_name)


def join_all(tables: Sequence[DataFrame], keys: Sequence[str], how: str = "inner", heavy: bool = False) -> DataFrame:
    """Chain of equi-joins on the same keys, which share one partitioning.

    ``heavy`` says that the first table has many rows per key; its most frequent keys are then spread (inner and left joins).
    """
    if heavy:
        return reduce(lambda left, right: skewed_join(left, right, list(keys), how), tables)
    return reduce(lambda left, right: left.join(right, list(keys), how), tables)


def join_features(tables: dict[str, DataFrame], key: str = "patient_id") -> DataFrame:
    """Full outer join of feature tables with prefixed columns; missing numbers become 0."""
    prefixed = [prefix_columns(df, name, (key,)) for name, df in tables.items()]
    return join_all(prefixed, [key], "full").na.fill(0)


def with_label(df: DataFrame, labels: DataFrame, key: str = "patient_id") -> DataFrame:
    """Every row with the label of its entity, if there is one; entities with very many rows are spread."""
    return skewed_join(df, labels, [key], "left")


def keep_ids(df: DataFrame, ids: DataFrame, key: str = "patient_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, key: str = "patient_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def pivot_latest(
    df: DataFrame,
    names: Sequence[str],
    key: str = "patient_id",
    name: str = "test_name",
    value: str = "value",
    flag: str | None = "is_abnormal",
    time: str = "test_date",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Wide table with the latest value (and ``<name>_abnormal`` flag) of every measurement.

    The latest row per entity and name is kept first, so value and flag come from the same row and a
    repeated measurement collapses before the shuffle; one aggregation then spreads the names.
    """
    kept = df.select(key, name, time, *tie_break, value, *([flag] if flag else []))
    newest = latest_rows(kept, [key, name], time, tie_break)
    wanted = []
    for n in names:
        mine = F.col(name) == F.lit(n)
        wanted.append(F.max(F.when(mine, F.col(value))).alias(n))
        if flag:
            wanted.append(F.max(F.when(mine, F.col(flag))).alias(f"{n}_abnormal"))
    return newest.groupBy(key).agg(*wanted)


def pivot_mean(
    df: DataFrame, names: Sequence[str], key: str = "patient_id", name: str = "test_name", value: str = "value"
) -> DataFrame:
    """Wide table with the mean value of every measurement, in one aggregation."""
    means = [F.avg(F.when(F.col(name) == F.lit(n), F.col(value))).alias(n) for n in names]
    return df.groupBy(key).agg(*means)


def concat_texts(
    df: DataFrame,
    key: str = "patient_id",
    text: str = "note_text",
    order: Sequence[str] = ("note_date",),
    bucket: Column | None = None,
    label: str | None = None,
    max_chars: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Concatenate the texts of an entity in order, separated by a blank.

    The result has one row per entity and ``part``. Only when the caller sets ``max_chars`` does an entity
    with longer texts continue in further parts; no text is lost.
    ``bucket`` is monotone along ``order``; by default it is the day of the first order column. A bucket with more
    than ``bucket_rows`` rows of an entity is cut further.
    """
    require(df, [key, text, *order])
    some = df.filter(F.col(text).isNotNull())
    rows = F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order], F.col(text))))
    results = [F.array_join(F.transform(rows, lambda r: r[text]), " ").alias(text)]
    if label:
        results.append(F.min(label).alias(label))
    if max_chars is None:
        return some.groupBy(key).agg(*results).withColumn("part", F.lit(0))
    narrow = some.select(key, *order, text, *[c for c in [label] if c])
    day = date_bucket(order[0]) if bucket is None else bucket
    placed = adaptive_buckets(narrow, [key], [*order, text], day, bucket_rows).withColumnRenamed("_bucket", "_place")
    sized = running_totals(
        placed, [key], [*order, text], {"chars": F.length(text).cast("long") + 1}, "_place"
    ).withColumn("part", F.floor(F.col("chars_before") / F.lit(max_chars)).cast("int"))
    return sized.groupBy(key, "part").agg(*results)


def patient_chart(
    entity: DataFrame, details: dict[str, DataFrame], value: object, key: str = "patient_id"
) -> dict[str, DataFrame]:
    """All rows of every table for one entity; the filter reaches each scan."""
    wanted = F.col(key) == F.lit(value)
    return {"entity": entity.filter(wanted), **{name: df.filter(wanted) for name, df in details.items()}}


def select_cohort(
    labels: DataFrame,
    pattern: str,
    fallback_level: str = "high",
    label: str = "final_diagnosis",
    level: str = "risk_level",
    key: str = "patient_id",
    n: int = 1,
) -> DataFrame:
    """First ``n`` entities whose label matches; without any match, those of the fallback risk level."""
    match = F.coalesce(F.lower(F.col(label)).rlike(pattern), F.lit(False))
    fallback = F.coalesce(F.lower(F.col(level)) == F.lit(fallback_level), F.lit(False))
    graded = labels.withColumn("match_rank", F.when(match, F.lit(0)).when(fallback, F.lit(1)))
    best = graded.agg(F.min("match_rank").alias("b"))
    return (
        graded.filter(F.col("match_rank") == best.scalar()).orderBy(key).limit(n).select(*labels.columns, "match_rank")
    )


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def date_bucket(value: str | Column) -> Column:
    """Monotone bucket of a date or timestamp: its day number."""
    return F.date_diff(as_column(value).cast("date"), F.lit("1970-01-01").cast("date"))
