"""Batch scoring: one lazy plan from entity rows and modality vectors to prediction records."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.presets import CLASS_LABELS, MODALITY_WEIGHTS
from riskframe.operators import fusion
from riskframe.operators.clean import decode
from riskframe.operators.stacking import StackedModel


@dataclass
class ScoringPlan:
    """How modality vectors become a decision. ``vectors`` maps a modality to its array column."""

    vectors: dict[str, str]
    weights: dict[str, float] = field(default_factory=lambda: dict(MODALITY_WEIGHTS))
    labels: dict[int, str] = field(default_factory=lambda: dict(CLASS_LABELS))
    stacked: StackedModel | None = None
    n_factors: int = 5

    def ensemble(self, df: DataFrame) -> DataFrame:
        """Add ``ensemble_prob``: the meta-learner when there is one and any modality, else the weighted mean."""
        n = len(self.labels)
        mean = fusion.fuse_vectors(self.vectors, self.weights, n)
        if self.stacked is None:
            return df.withColumn("ensemble_prob", mean)
        meta = df.withColumn("_meta", fusion.meta_features(self.vectors, n))
        named = {f"_f{i}": F.col("_meta")[i] for i in range(n * len(self.vectors))}
        scored = self.stacked.predict(meta.withColumns(named), "_stacked")
        any_present = F.coalesce(*[F.col(c) for c in self.vectors.values()]).isNotNull()
        return scored.withColumn("ensemble_prob", F.when(any_present, F.col("_stacked")).otherwise(mean)).drop(
            "_meta", "_stacked", *named
        )

    def score(self, df: DataFrame) -> DataFrame:
        """All input columns plus class, confidence, risk level, diagnosis, scores, factors and actions."""
        decided = self.ensemble(df).withColumns(
            {
                "predicted_class": fusion.argmax("ensemble_prob"),
                "_confidence": F.array_max("ensemble_prob"),
                "top_factors": fusion.top_factors(df.columns, self.vectors, self.n_factors),
            }
        )
        levelled = decided.withColumns(
            {
                "risk_level": fusion.confidence_level("_confidence", "predicted_class"),
                "predicted_diagnosis": decode("predicted_class", self.labels),
                "confidence": F.round("_confidence", 4),
                "per_modality_scores": F.map_filter(
                    F.create_map(*[x for m, c in self.vectors.items() for x in (F.lit(m), F.col(c))]),
                    lambda _, vector: vector.isNotNull(),
                ),
            }
        )
        return levelled.withColumn(
            "recommended_actions", fusion.scoring_actions("risk_level", "predicted_diagnosis", "top_factors")
        ).drop("_confidence")

    def records(self, df: DataFrame, key: str = "patient_id") -> DataFrame:
        """Only the prediction record of each entity."""
        return self.score(df).select(
            F.coalesce(F.col(key).cast("string"), F.lit("unknown")).alias(key),
            "risk_level",
            "confidence",
            "predicted_diagnosis",
            "per_modality_scores",
            "top_factors",
            "recommended_actions",
        )


def score_one(plan: ScoringPlan, df: DataFrame, value: object, key: str = "patient_id") -> DataFrame:
    """The record of one entity: the same plan behind a filter that reaches the scan."""
    return plan.records(df.filter(F.col(key) == F.lit(value)), key)
