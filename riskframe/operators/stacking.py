"""Stacked meta-learner with sigmoid calibration by cross-validation."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.presets import MODALITY_WEIGHTS, RISK_FROM_PROBABILITY
from riskframe.operators.fusion import argmax, scale_array, weighted_fusion, with_contributions
from riskframe.operators.integrate import stack
from riskframe.operators.split import with_fold
from riskframe.session import materialize


def fit_sigmoids(
    df: DataFrame, keys: list[str], score: str, target: str, max_iter: int = 50, tolerance: float = 1e-9
) -> dict[tuple, tuple[float, float]]:
    """Sigmoid ``1 / (1 + exp(-(a s + b)))`` per key by maximum likelihood with smoothed targets.

    All keys are fitted at once: one iteration is one aggregation whose result has a row per key.
    """
    sizes = df.groupBy(*keys).agg(F.sum(target).alias("p"), F.sum(1 - F.col(target)).alias("q")).collect()
    fitted = {
        tuple(r[k] for k in keys): (0.0, float(np.log((r["p"] + 1.0) / (r["q"] + 1.0)))) for r in sizes
    }
    goals = {
        tuple(r[k] for k in keys): ((r["p"] + 1.0) / (r["p"] + 2.0), 1.0 / (r["q"] + 2.0)) for r in sizes
    }
    joined = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    places = F.create_map(*[x for i, k in enumerate(fitted) for x in (F.lit("|".join(map(str, k))), F.lit(i))])
    placed = df.select(*keys, score, target, places[joined].alias("_at"))  # a key's text is looked up once, not in every round

    def lookup(values: dict) -> Column:
        return F.get(F.array(*[F.lit(float(values[k])) for k in fitted]), F.col("_at"))

    s = F.col(score)
    goal = F.when(F.col(target) == 1, lookup({k: g[0] for k, g in goals.items()})).otherwise(
        lookup({k: g[1] for k, g in goals.items()})
    )
    ready = materialize(placed.select(*keys, score, "_at", goal.alias("_goal")))
    for _ in range(max_iter):
        a, b = lookup({k: v[0] for k, v in fitted.items()}), lookup({k: v[1] for k, v in fitted.items()})
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(a * s + b)))
        staged = ready.withColumn("_p", p)
        error, weight = F.col("_p") - F.col("_goal"), F.col("_p") * (1 - F.col("_p"))
        sums = staged.groupBy(*keys).agg(
            F.sum(error * s).alias("ga"),
            F.sum(error).alias("gb"),
            F.sum(weight * s * s).alias("haa"),
            F.sum(weight * s).alias("hab"),
            F.sum(weight).alias("hbb"),
        )
        largest = 0.0
        for r in sums.collect():
            k = tuple(r[x] for x in keys)
            h = np.array([[r["haa"] + 1e-12, r["hab"]], [r["hab"], r["hbb"] + 1e-12]])
            step = np.linalg.solve(h, np.array([r["ga"], r["gb"]]))
            step = np.clip(step, -5.0, 5.0)
            fitted[k] = (fitted[k][0] - float(step[0]), fitted[k][1] - float(step[1]))
            largest = max(largest, float(np.abs(step).max()))
        if largest < tolerance:
            break
    return fitted


@dataclass
class StackedModel:
    """Fold models of a meta-learner and their sigmoids; predicts the mean calibrated probability."""

    features: list[str]
    n_classes: int
    models: list[LogisticRegressionModel]
    sigmoids: dict[tuple[int, int], tuple[float, float]]
    weights: dict[str, float] = field(default_factory=lambda: dict(MODALITY_WEIGHTS))

    def _calibrated(self, raw: Column, fold: int) -> Column:
        squashed = []
        for k in range(self.n_classes):
            a, b = self.sigmoids.get((fold, k), (0.0, -30.0))
            squashed_k = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.get(raw, F.lit(k)) * F.lit(a) + F.lit(b))))
            squashed.append(F.coalesce(squashed_k, F.lit(0.0)))  # a class that the fold's rows lack
        array = F.array(*squashed)
        total = F.aggregate(array, F.lit(0.0), lambda x, y: x + y)
        return scale_array(array, total, lambda x, t: F.when(t > 0, x / t).otherwise(F.lit(1.0 / self.n_classes)))

    def predict(self, df: DataFrame, name: str = "prob") -> DataFrame:
        """Add the class probabilities ``name``."""
        current = df.withColumn("_x", array_to_vector(F.array(*[F.col(c).cast("double") for c in self.features])))
        means = []
        for fold, model in enumerate(self.models):
            scored = model.copy().setRawPredictionCol("_raw").setProbabilityCol("").setPredictionCol("").transform(current)
            current = scored.withColumn(f"_cal{fold}", self._calibrated(vector_to_array("_raw"), fold)).drop("_raw")
            means.append(F.col(f"_cal{fold}"))
        average = F.array(
            *[sum((m[k] for m in means), F.lit(0.0)) / F.lit(float(len(means))) for k in range(self.n_classes)]
        )
        return current.withColumn(name, average).drop("_x", *[f"_cal{i}" for i in range(len(means))])

    def save(self, spark: SparkSession, path: str) -> None:
        for fold, model in enumerate(self.models):
            model.write().overwrite().save(f"{path}/fold{fold}")
        settings = {"features": self.features, "n_classes": self.n_classes, "weights": self.weights, "folds": len(self.models)}
        rows = [(f, k, a, b) for (f, k), (a, b) in self.sigmoids.items()]
        spark.createDataFrame(rows, "fold int, class int, a double, b double").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/sigmoids"
        )
        spark.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/settings"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "StackedModel":
        settings = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        rows = spark.read.parquet(f"{path}/sigmoids").collect()
        models = [LogisticRegressionModel.load(f"{path}/fold{i}") for i in range(settings.pop("folds"))]
        return cls(models=models, sigmoids={(r["fold"], r["class"]): (r["a"], r["b"]) for r in rows}, **settings)


def fit_stack(
    df: DataFrame,
    features: list[str],
    label: str = "y_true",
    key: str = "patient_id",
    folds: int = 5,
    c: float = 1.0,
    seed: int = 42,
    max_iter: int = 1000,
) -> tuple[StackedModel, DataFrame]:
    """Fit the meta-learner per fold and calibrate it on the rows left out.

    Returns the model and the out-of-fold calibrated probabilities ``(key, label, prob)`` of every row, so
    the model can be evaluated on rows it has not seen.
    """
    vector = array_to_vector(F.array(*[F.col(f).cast("double") for f in features]))
    prepared = materialize(
        with_fold(df.select(key, F.col(label).cast("int").alias(label), vector.alias("_x")), key, folds, seed)
    )
    n_classes = int(prepared.agg(F.max(label)).first()[0]) + 1
    counts = {r["fold"]: r["n"] for r in prepared.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}

    def fitted(fold: int) -> LogisticRegressionModel:
        rows = sum(n for f, n in counts.items() if f != fold)
        return LogisticRegression(
            featuresCol="_x",
            labelCol=label,
            family="multinomial",
            standardization=False,
            regParam=1.0 / (c * max(rows, 1)),
            maxIter=max_iter,
        ).fit(prepared.filter(F.col("fold") != fold))

    # The rounds of a fit are short jobs, so those of two folds fill the cores better than those of one.
    with ThreadPoolExecutor(2) as pool:
        models = list(pool.map(inheritable_thread_target(df.sparkSession)(fitted), range(folds)))
    held_out = []
    for fold, model in enumerate(models):
        scored = model.transform(prepared.filter(F.col("fold") == fold))
        held_out.append(scored.select(key, label, "fold", vector_to_array("rawPrediction").alias("raw")))
    raw = materialize(stack(held_out))
    long = raw.select("fold", label, F.posexplode("raw").alias("class", "score")).withColumn(
        "hit", (F.col(label) == F.col("class")).cast("int")
    )
    stacked = StackedModel(list(features), n_classes, models, fit_sigmoids(long, ["fold", "class"], "score", "hit"))
    calibrated = F.lit(None).cast("array<double>")
    for fold in range(folds):
        calibrated = F.when(F.col("fold") == fold, stacked._calibrated(F.col("raw"), fold)).otherwise(calibrated)
    return stacked, raw.select(key, label, calibrated.alias("prob"))


def fold_scores(
    held_out: DataFrame, label: str = "y_true", key: str = "patient_id", folds: int = 5, seed: int = 42
) -> DataFrame:
    """``(fold, n, accuracy)`` of the meta-learner from its out-of-fold probabilities."""
    placed = with_fold(held_out, key, folds, seed)
    hit = (argmax("prob") == F.col(label)).cast("int")
    return placed.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def cross_validated_score(scores: DataFrame) -> tuple[float, float]:
    """Mean and population deviation of the accuracies of the folds."""
    found = scores.agg(F.avg("accuracy").alias("m"), F.stddev_pop("accuracy").alias("s")).first()
    return found["m"], found["s"]


def predict_final(
    df: DataFrame, model: StackedModel | None = None, weights: dict[str, float] = MODALITY_WEIGHTS
) -> DataFrame:
    """Class, confidence, risk category and contributions; without a model the weighted fusion decides."""
    if model is None:
        result = weighted_fusion(df, weights).withColumn("confidence", F.col("fused_probability"))
    else:
        result = model.predict(df, "_prob").withColumns(
            {
                "predicted_class": argmax("_prob"),
                "confidence": F.array_max("_prob"),
                "fused_probability": F.array_max("_prob"),
            }
        )
        result = result.drop("_prob").withColumn("risk_category", RISK_FROM_PROBABILITY.on("fused_probability"))
    return with_contributions(result, weights)
