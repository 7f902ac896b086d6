"""Fusion of modality predictions, risk levels, explanations and recommended actions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskframe.functions.presets import (
    FACTOR_FLAGS,
    FACTOR_RANGES,
    FUSION_ACTIONS,
    FUSION_FACTOR_ACTIONS,
    FUSION_FACTOR_HEADER,
    MODALITY_WEIGHTS,
    RISK_FROM_PROBABILITY,
    SCORING_ACTIONS,
    SCORING_FACTOR_ACTIONS,
    SEVERE_CLASSES,
)
from riskframe.functions.rules import as_column

PROBABILITY_NAMES = ("prob", "probability", "risk_score", "prediction")


def probability_column(df: DataFrame, target: str, key: str = "patient_id") -> str:
    """Name of the probability column: the target, a usual name, or the last numeric column."""
    for name in (target, *PROBABILITY_NAMES):
        if name in df.columns:
            return name
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name != key]
    if not numeric:
        raise ValueError(f"no probability column for {target} in {df.columns}")
    return numeric[-1]


def collect_modalities(
    predictions: dict[str, DataFrame],
    key: str = "patient_id",
    modalities: Sequence[str] = tuple(MODALITY_WEIGHTS),
    neutral: float = 0.5,
) -> DataFrame:
    """Outer join of the modality predictions: tag, union and one aggregation. A missing prediction is neutral."""
    tagged = [
        df.select(
            key,
            F.lit(name).alias("modality"),
            F.col(probability_column(df, f"{name}_prob", key)).cast("double").alias("p"),
        )
        for name, df in predictions.items()
    ]
    return collect_long(reduce(DataFrame.unionByName, tagged), "p", key, modalities, neutral)


def collect_long(
    df: DataFrame,
    probability: str,
    key: str = "patient_id",
    modalities: Sequence[str] = tuple(MODALITY_WEIGHTS),
    neutral: float = 0.5,
) -> DataFrame:
    """The same from one long table ``(key, modality, probability)``: one scan, one aggregation."""
    picks = [F.max(F.when(F.col("modality") == m, F.col(probability).cast("double"))).alias(f"{m}_prob") for m in modalities]
    wide = df.groupBy(key).agg(*picks)
    return wide.withColumns({f"{m}_prob": F.coalesce(f"{m}_prob", F.lit(neutral)) for m in modalities})


def weighted_fusion(df: DataFrame, weights: dict[str, float] = MODALITY_WEIGHTS) -> DataFrame:
    """``fused_probability`` over the modality columns that exist, and ``risk_category``."""
    used = [(m, w) for m, w in weights.items() if f"{m}_prob" in df.columns]
    fused = sum((F.col(f"{m}_prob") * F.lit(w) for m, w in used), F.lit(0.0))
    return df.withColumn("fused_probability", fused).withColumn(
        "risk_category", RISK_FROM_PROBABILITY.on("fused_probability")
    )


def with_contributions(df: DataFrame, weights: dict[str, float] = MODALITY_WEIGHTS) -> DataFrame:
    """``<modality>_contribution``: weighted probability over the fused probability."""
    floor = F.greatest(F.col("fused_probability"), F.lit(1e-8))
    return df.withColumns(
        {f"{m}_contribution": F.col(f"{m}_prob") * F.lit(w) / floor for m, w in weights.items() if f"{m}_prob" in df.columns}
    )


def explain_weights(df: DataFrame, key: str = "patient_id", weights: dict[str, float] = MODALITY_WEIGHTS) -> DataFrame:
    """One row per entity and modality: weight, value (neutral when missing) and their product."""
    rows = [
        F.struct(
            F.lit(m).alias("modality"),
            F.lit(w).alias("weight"),
            F.coalesce(f"{m}_prob", F.lit(0.5)).alias("feature_value"),
            (F.coalesce(f"{m}_prob", F.lit(0.5)) * F.lit(w)).alias("weighted_contribution"),
        )
        for m, w in weights.items()
    ]
    return df.select(key, F.inline(F.array(*rows)))


def explain_linear(df: DataFrame, coefficients: dict[str, float], key: str = "patient_id") -> DataFrame:
    """Attribution of a linear model: coefficient times the distance from the column mean, long form."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in coefficients]).alias("m")).scalar()
    rows = []
    for name, weight in coefficients.items():
        value = (F.col(name) - means.getField(name)) * F.lit(weight)
        rows.append(F.struct(F.lit(name).alias("feature"), F.col(name).alias("feature_value"), value.alias("attribution")))
    sign = F.when(F.col("attribution") > 0, F.lit("positive")).otherwise(F.lit("negative"))
    return df.select(key, F.inline(F.array(*rows))).withColumn("contribution", sign)


def argmax(vector: str | Column) -> Column:
    """Index of the first largest element."""
    vector = as_column(vector)
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def scale_array(values: Column, factor: Column, apply) -> Column:
    """Combine every element with one value per row, which is evaluated once."""
    return F.zip_with(values, F.array_repeat(factor, F.size(values)), apply)


def softmax(logits: str | Column) -> Column:
    logits = as_column(logits).cast("array<double>")
    powers = scale_array(logits, F.array_max(logits), lambda x, top: F.exp(x - top))
    return scale_array(powers, F.aggregate(powers, F.lit(0.0), lambda a, b: a + b), lambda x, total: x / total)


def one_hot(index: str | Column, n_classes: int) -> Column:
    index = as_column(index).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda i: (i == index).cast("double"))


def anomaly_probability(score: str | Column) -> Column:
    """Decision value (low = anomalous) to the probability of an anomaly."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(as_column(score)))


def uniform(n_classes: int) -> Column:
    return F.array(*[F.lit(1.0 / n_classes) for _ in range(n_classes)])


def fuse_vectors(vectors: dict[str, str], weights: dict[str, float], n_classes: int) -> Column:
    """Weighted mean of the class vectors that are present, renormalised; uniform without any.

    A modality without a weight gets one over the number of modalities present.
    """
    present = {m: F.col(c).isNotNull() for m, c in vectors.items()}
    count = sum((p.cast("int") for p in present.values()), F.lit(0))
    weight = {
        m: F.when(p, F.lit(weights[m]) if m in weights else F.lit(1.0) / count).otherwise(F.lit(0.0))
        for m, p in present.items()
    }
    total = sum(weight.values(), F.lit(0.0))
    means = [
        sum((weight[m] * F.coalesce(F.col(c)[j], F.lit(0.0)) for m, c in vectors.items()), F.lit(0.0)) / total
        for j in range(n_classes)
    ]
    return F.when(total > 0, F.array(*means)).otherwise(uniform(n_classes))


def fuse_long(df: DataFrame, weights: dict[str, float], key: str = "patient_id") -> DataFrame:
    """The same weighted mean for a long table ``(key, modality, class, p)``, one row per key, modality and class.

    A modality without a weight gets one over the number of modalities present, as in ``fuse_vectors``.
    """
    entries = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    weight = F.try_element_at(entries, F.col("modality"))
    unlisted = F.when(weight.isNull(), F.lit(1.0))
    share = F.lit(1.0) / F.count(F.lit(1))
    top = F.coalesce(F.sum(weight * F.col("p")), F.lit(0.0)) + F.coalesce(F.sum(unlisted * F.col("p")), F.lit(0.0)) * share
    bottom = F.coalesce(F.sum(weight), F.lit(0.0)) + F.coalesce(F.sum(unlisted), F.lit(0.0)) * share
    return df.groupBy(key, "class").agg(F.try_divide(top, bottom).alias("p"))


def meta_features(vectors: dict[str, str], n_classes: int) -> Column:
    """All class vectors in one array; a missing modality is uniform."""
    return F.concat(*[F.coalesce(F.col(c), uniform(n_classes)) for c in vectors.values()])


def confidence_level(
    confidence: str | Column, predicted: str | Column, severe: Sequence[int] = SEVERE_CLASSES
) -> Column:
    """Risk level from confidence and class."""
    confidence, predicted = as_column(confidence), as_column(predicted)
    return (
        F.when((confidence >= 0.85) & predicted.isin(list(severe)), F.lit("Critical"))
        .when(confidence >= 0.7, F.lit("High"))
        .when(confidence >= 0.5, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def top_factors(
    columns: Sequence[str],
    vectors: dict[str, str],
    n: int = 5,
    ranges: dict[str, tuple] = FACTOR_RANGES,
    flags: Sequence[str] = FACTOR_FLAGS,
) -> Column:
    """Abnormal vitals, present symptoms and the strongest modality, in this order, the first ``n``."""
    phrases = []
    for name, (low, high, phrase) in ranges.items():
        if name in columns:
            value = F.col(name).cast("double")
            outside = (value < low) | (value > high)
            phrases.append(F.when(outside, F.concat(F.lit(f"{phrase}: "), value.cast("string"))))
    for flag in flags:
        if flag in columns:
            phrases.append(F.when(F.col(flag) == 1, F.lit(f"Symptom present: {flag.replace('_', ' ')}")))
    if vectors:
        peaks = {m: F.coalesce(F.array_max(F.col(c)), F.lit(-1.0)) for m, c in vectors.items()}
        highest = F.greatest(*peaks.values(), F.lit(-1.0))
        strongest = reduce(
            lambda rest, m: F.when(peaks[m] == highest, F.lit(m)).otherwise(rest), reversed(list(peaks)), F.lit(None)
        )
        phrases.append(
            F.when(highest >= 0, F.concat(F.lit("Strongest signal from "), strongest, F.lit(" modality")))
        )
    return F.slice(F.filter(F.array(*phrases), lambda x: x.isNotNull()), 1, n)


def _texts(lines: Sequence[str]) -> Column:
    return F.array(*[F.lit(line) for line in lines])


def level_actions(level: str | Column, table: dict[str, list[str]], default: str = "Low") -> Column:
    """The action list of a level; an unknown level gets the default's."""
    level = as_column(level)
    return reduce(
        lambda rest, item: F.when(level == item[0], _texts(item[1])).otherwise(rest), table.items(), _texts(table[default])
    )


def scoring_actions(
    level: str | Column,
    diagnosis: str | Column,
    factors: str | Column,
    table: dict[str, list[str]] = SCORING_ACTIONS,
    factor_actions: dict[str, str] = SCORING_FACTOR_ACTIONS,
) -> Column:
    """Actions for the level, the evaluation of the diagnosis, and those that a factor calls for."""
    factors = as_column(factors)
    parts = [
        level_actions(level, table),
        F.array(F.concat(F.lit("Evaluate for: "), as_column(diagnosis))),
    ]
    empty = F.array().cast("array<string>")
    for word, action in factor_actions.items():
        mentioned = F.exists(factors, lambda f: F.contains(F.lower(f), F.lit(word)))
        parts.append(F.when(mentioned, _texts([action])).otherwise(empty))
    return F.concat(*parts)


def fusion_actions(level: str | Column, factors: str | Column) -> Column:
    """Actions for the level, then one line per known factor of an array ``<name, score>``."""
    factors = as_column(factors)
    known = F.create_map(*[F.lit(x) for pair in FUSION_FACTOR_ACTIONS.items() for x in pair])

    def line(f: Column) -> Column:
        name = F.regexp_replace(f["name"], "_prob|_contribution", "")
        text = F.concat(F.format_string("  [%s (score: %.2f)]: ", F.upper(name), f["score"]), known[name])
        return F.when(known[name].isNotNull(), text)

    lines = F.filter(F.transform(factors, line), lambda x: x.isNotNull())
    empty = F.array().cast("array<string>")
    return F.concat(
        level_actions(level, FUSION_ACTIONS),
        F.when(F.size(factors) > 0, F.concat(_texts([FUSION_FACTOR_HEADER]), lines)).otherwise(empty),
    )


def min_max_inverted(df: DataFrame, score: str, name: str = "anomaly_score") -> DataFrame:
    """``1 - (score - min) / (max - min)`` over the whole table; 0 when the score is constant."""
    limits = df.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi")).alias("x")).scalar()
    span = limits.getField("hi") - limits.getField("lo")
    scaled = F.lit(1.0) - (F.col(score) - limits.getField("lo")) / span
    return df.withColumn(name, F.when(span > 0, scaled).otherwise(F.lit(0.0)))
