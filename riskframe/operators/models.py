"""Supervised and unsupervised models on MLlib."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    PCA,
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.explore import standardize_columns
from riskframe.operators.profile import numeric_columns
from riskframe.operators.text import most_frequent


def assemble(
    df: DataFrame, columns: list[str] | None = None, output: str = "features", invalid: str = "keep"
) -> DataFrame:
    """Feature vector of the numeric columns. ``invalid="keep"`` fills missing numbers with 0, ``"skip"``
    drops the rows that have one."""
    columns = columns or numeric_columns(df)
    if invalid == "keep":
        df = df.na.fill(0, columns)
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="skip").transform(df)


def label_indexer(label: str, labels: Sequence[str] | None = None) -> StringIndexer | StringIndexerModel:
    """Alphabetical index of the labels of the rows, or the given one: then a class without rows keeps its place."""
    if labels is not None:
        return StringIndexerModel.from_labels(list(labels), label, "label_index", "skip")
    return StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc", handleInvalid="skip")


def forest_pipeline(
    columns: list[str],
    label: str,
    trees: int = 150,
    depth: int = 10,
    seed: int = 42,
    scale: bool = True,
    labels: Sequence[str] | None = None,
) -> Pipeline:
    """Label index (alphabetical), assembly, scaling to unit deviation, random forest.

    The forest keeps the node of each row and tree between the levels, so a level does not walk every tree from its root again.
    """
    stages = [label_indexer(label, labels), VectorAssembler(inputCols=columns, outputCol="raw_features", handleInvalid="skip")]
    features = "raw_features"
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="scaled_features", withMean=False, withStd=True))
        features = "scaled_features"
    stages.append(
        RandomForestClassifier(
            featuresCol=features, labelCol="label_index", numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True
        )
    )
    return Pipeline(stages=stages)


def grid_search(
    pipeline: Pipeline,
    df: DataFrame,
    key: str = "patient_id",
    depths: Sequence[int] = (5, 8, 10),
    trees: Sequence[int] = (50, 100, 200),
    folds: int = 5,
    parallelism: int = 2,
) -> CrossValidatorModel:
    """Cross-validated choice of depth and number of trees by weighted F1; folds are hashed by the key.

    Per fold one forest is fitted, and those of the other points are cut from it; the model of the best point is fitted on all rows.
    """
    from riskframe.operators.forest_search import fold_f1

    forest = pipeline.getStages()[-1]
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).addGrid(forest.numTrees, list(trees)).build()
    by_fold = fold_f1(pipeline, df, key, depths, trees, folds, parallelism)
    scores = [by_fold[point[forest.maxDepth], point[forest.numTrees]] for point in grid]
    means = [float(np.mean(x)) for x in scores]
    best = pipeline.copy(grid[int(np.argmax(means))]).fit(df)
    found = CrossValidatorModel(best, avgMetrics=means, stdMetrics=[float(np.std(x)) for x in scores])
    evaluator = MulticlassClassificationEvaluator(labelCol="label_index", metricName="f1")
    found._resetUid(CrossValidator().uid)
    return found._set(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol="fold")


def grid_scores(spark: SparkSession, found: CrossValidatorModel) -> DataFrame:
    """Mean cross-validated F1 of every point of the grid: ``(depth, trees, f1)``."""
    rows = []
    for point, score in zip(found.getEstimatorParamMaps(), found.avgMetrics, strict=True):
        values = {param.name: value for param, value in point.items()}
        rows.append((int(values["maxDepth"]), int(values["numTrees"]), float(score)))
    return spark.createDataFrame(rows, "depth int, trees int, f1 double")


def class_labels(model: PipelineModel) -> list[str]:
    """Labels in index order, taken from the fitted indexer."""
    return list(next(stage for stage in model.stages if hasattr(stage, "labels")).labels)


def prediction_frame(model: Model, df: DataFrame, keep: Sequence[str] = ("patient_id",)) -> DataFrame:
    """``keep`` columns with ``y_true`` (NULL without a label), ``y_pred`` and the class probabilities ``prob``."""
    scored = model.transform(df)
    truth = F.col("label_index").cast("int") if "label_index" in scored.columns else F.lit(None).cast("int")
    return scored.select(
        *keep,
        truth.alias("y_true"),
        F.col("prediction").cast("int").alias("y_pred"),
        vector_to_array("probability").alias("prob"),
    )


def feature_importances(spark: SparkSession, model: PipelineModel, columns: list[str]) -> DataFrame:
    """One row per feature column of a fitted forest."""
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(c, float(x)) for c, x in zip(columns, values)], "feature string, importance double")


def word_stages(text: str) -> list:
    statement = (
        f"SELECT *, regexp_extract_all(lower(coalesce({text}, '')), '([\\\\p{{L}}\\\\p{{N}}_]{{2,}})', 1) AS _words FROM __THIS__"
    )
    return [
        SQLTransformer(statement=statement),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _grams FROM __THIS__"),
    ]


def fit_text_vectorizer(
    df: DataFrame,
    text: str = "note_text",
    output: str = "text_features",
    max_features: int = 5000,
    min_df: int = 2,
    max_df: float = 0.95,
) -> PipelineModel:
    """Words and word pairs, the most frequent terms, smoothed idf plus one, unit length."""
    cut = Pipeline(stages=word_stages(text)).fit(df)
    grams = cut.transform(df).select("_grams")
    # Every occurrence counts for the total, the first one in a text for the texts; only distinct terms are moved.
    marked = lambda terms, first: F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(first).alias("first")))
    terms = F.concat(marked(F.col("_grams"), 0), marked(F.array_distinct("_grams"), 1))
    seen = grams.select(F.explode(terms).alias("t")).groupBy("t.term").agg(
        F.sum("t.first").alias("df"), F.sum(1 - F.col("t.first")).alias("total")
    )
    kept = most_frequent(seen, F.lit(df.count()), min_df, max_df, max_features)
    words = kept.orderBy(F.desc("total"), "term").collect()  # at most ``max_features`` rows
    if not words:
        raise ValueError(f"no term is in {min_df} texts or more and in at most a share of {max_df}")
    counter = CountVectorizerModel.from_vocabulary([r["term"] for r in words], inputCol="_grams", outputCol="_tf")
    weights = Vectors.dense([r["idf"] for r in words])
    return PipelineModel(
        [
            *cut.stages,
            counter,
            ElementwiseProduct(scalingVec=weights, inputCol="_tf", outputCol="_weighted"),
            Normalizer(p=2.0, inputCol="_weighted", outputCol=output),
            SQLTransformer(statement="SELECT * EXCEPT (_words, _pairs, _grams, _tf, _weighted) FROM __THIS__"),
        ]
    )


def fit_text_classifier(
    df: DataFrame,
    label: str,
    text: str = "note_text",
    c: float = 1.0,
    max_iter: int = 1000,
    labels: Sequence[str] | None = None,
    **vectorizer,
) -> PipelineModel:
    """Vectorizer and multinomial logistic regression with the penalty ``1 / (c n)``."""
    vectors = fit_text_vectorizer(df, text, "text_features", **vectorizer)
    indexed = label_indexer(label).fit(df) if labels is None else label_indexer(label, labels)
    prepared = indexed.transform(vectors.transform(df)).select("text_features", "label_index").persist()
    try:
        rows = prepared.count()
        model = LogisticRegression(
            featuresCol="text_features",
            labelCol="label_index",
            family="multinomial",
            standardization=False,
            regParam=1.0 / (c * max(rows, 1)),
            maxIter=max_iter,
        ).fit(prepared)
    finally:
        prepared.unpersist()
    return PipelineModel([*vectors.stages, indexed, model])


def fit_clusters(
    df: DataFrame, columns: list[str] | None = None, k: int = 4, max_iter: int = 50, seed: int = 42
) -> tuple[KMeansModel, DataFrame, float]:
    """K-means on the numeric columns: model, rows with ``cluster``, silhouette."""
    assembled = assemble(df, columns)
    model = KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed, maxIter=max_iter).fit(assembled)
    clustered = model.transform(assembled)
    silhouette = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(clustered)
    return model, clustered, silhouette


def principal_components(df: DataFrame, columns: list[str], k: int = 2) -> tuple[DataFrame, list[float]]:
    """Rows with the first ``k`` components ``pc1..`` of the standardised columns, and all variance shares."""
    filled = standardize_columns(df.na.fill(0, columns), columns)
    assembled = VectorAssembler(inputCols=[f"{c}_z" for c in columns], outputCol="_z").transform(filled)
    model = PCA(k=len(columns), inputCol="_z", outputCol="_pc").fit(assembled)
    values = vector_to_array("_pc")
    projected = model.transform(assembled).withColumns({f"pc{i + 1}": values[i] for i in range(k)})
    shares = [float(x) for x in model.explainedVariance.toArray()]
    return projected.drop("_z", "_pc", *[f"{c}_z" for c in columns]), shares


def components_for(shares: Sequence[float], wanted: float = 0.95) -> int:
    """Number of components that explain at least ``wanted`` of the variance."""
    return int(np.argmax(np.cumsum(shares) >= wanted - 1e-12) + 1)
