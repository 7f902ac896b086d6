"""Grid search over depth and number of trees that grows each forest once.

The trees of a forest are independent, so the first trees of the largest forest are a forest of fewer trees; and a tree grows from its
root, so what is above a depth is a tree of that depth. Per fold only the largest and deepest forest is fitted; the others are cut from it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.evaluate import overall_metrics
from riskframe.operators.integrate import stack
from riskframe.operators.split import with_fold
from riskframe.session import ensure_checkpoint_dir, materialize


def first_trees(
    spark: SparkSession, model: RandomForestClassificationModel, sizes: Sequence[int]
) -> dict[int, RandomForestClassificationModel]:
    """Forests of the first ``sizes`` trees of a fitted forest, read back from its files without the other trees."""
    depth = model.getMaxDepth()
    return {size: cut for (_, size), cut in cut_forests(spark, model, [depth], sizes).items()}


def _places(depth: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Which nodes of a tree stay when it is cut at ``depth``, and their new numbers (in preorder, as the files have them).

    As in a fit, two leaves of one node with the same prediction become that node's leaf.
    """

    def run(nodes: pd.DataFrame) -> pd.DataFrame:
        by_id = {r.id: r for r in nodes.itertuples(index=False)}
        found: list[list[int]] = []

        def cut(at: int, level: int) -> bool:
            """Place the node and what stays below it; whether it is a leaf now."""
            node, place = by_id[at], len(found)
            found.append([node.tree, at, place, -1, -1])
            if level == depth or node.left < 0:
                return True
            left = len(found)
            ends = cut(node.left, level + 1)
            right = len(found)
            ends = cut(node.right, level + 1) and ends
            if ends and by_id[node.left].prediction == by_id[node.right].prediction:
                del found[place + 1 :]
                return True
            found[place][3:] = left, right
            return False

        cut(0, 0)
        return pd.DataFrame(found, columns=["tree", "id", "place", "left", "right"])

    return run


def cut_forests(
    spark: SparkSession, model: RandomForestClassificationModel, depths: Sequence[int], sizes: Sequence[int]
) -> dict[tuple[int, int], RandomForestClassificationModel]:
    """The forest of every depth and size: the first trees of a fitted forest, cut at the depth. Read back from its files.

    A tree grows from its root, and how a node is split does not depend on the depth the tree may reach. So a tree cut at a depth
    is one grown to that depth.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    model.write().save(f"{base}/all")
    settings = json.loads(spark.read.text(f"{base}/all/metadata").first()[0])
    whole = {part: spark.read.parquet(f"{base}/all/{part}") for part in ("data", "treesMetadata")}
    tree, node = whole["data"].columns  # the first column of both parts is the number of the tree
    found = {}
    for depth in depths:
        if not 0 <= depth <= model.getMaxDepth():
            raise ValueError(f"a forest of depth {model.getMaxDepth()} has no depth {depth}")
        parts = dict(whole)
        if depth < model.getMaxDepth():
            names = {"id": "id", "prediction": "prediction", "left": "leftChild", "right": "rightChild"}
            nodes = whole["data"].select(F.col(tree).alias("tree"), *[F.col(f"{node}.{c}").alias(n) for n, c in names.items()])
            kept = nodes.groupBy("tree").applyInPandas(_places(depth), "tree int, id int, place int, left int, right int")
            data = whole["data"].join(kept, (F.col(tree) == F.col("tree")) & (F.col(f"{node}.id") == F.col("id")))
            moved = F.col(node).withField("id", F.col("place")).withField("leftChild", F.col("left")).withField("rightChild", F.col("right"))
            data.select(F.col(tree), moved.alias(node)).write.parquet(f"{base}/cut-{depth}")
            parts["data"] = spark.read.parquet(f"{base}/cut-{depth}")
        for size in sizes:
            if not 0 < size <= model.getNumTrees:
                raise ValueError(f"a forest of {model.getNumTrees} trees has no first {size}")
            if (depth, size) == (model.getMaxDepth(), model.getNumTrees):
                found[depth, size] = model
                continue
            own = f"{base}/{depth}-{size}"
            for part, rows in parts.items():
                rows.filter(F.col(rows.columns[0]) < size).write.parquet(f"{own}/{part}")
            own_params = {**settings["paramMap"], "numTrees": size, "maxDepth": depth}
            fewer = {**settings, "numTrees": size, "paramMap": own_params}
            spark.createDataFrame([(json.dumps(fewer),)], "value string").coalesce(1).write.text(f"{own}/metadata")
            found[depth, size] = RandomForestClassificationModel.load(own)
    return found


@dataclass
class ForestSearch:
    """Scores ``(depth, trees, f1)`` of the grid, the best point and the model fitted with it on all rows."""

    scores: list[tuple[int, int, float]]
    depth: int
    trees: int
    best: PipelineModel

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.scores, "depth int, trees int, f1 double")


def search_forest(
    pipeline: Pipeline,
    df: DataFrame,
    key: str = "patient_id",
    depths: Sequence[int] = (5, 8, 10),
    trees: Sequence[int] = (50, 100, 200),
    folds: int = 5,
    parallelism: int = 2,
) -> ForestSearch:
    """Cross-validated choice of depth and number of trees by weighted F1, with one fit per fold.

    ``pipeline`` ends in a forest; its other stages are fitted once per fold. Folds are hashed by the key. Of equal scores the first
    point of the grid wins.
    """
    *before, forest = pipeline.getStages()
    by_fold = fold_f1(pipeline, df, key, depths, trees, folds, parallelism)
    ordered = [(d, t, float(np.mean(by_fold[d, t]))) for d, t in product(depths, trees)]
    depth, size, _ = max(ordered, key=lambda point: point[2])
    best = Pipeline(stages=[*before, forest.copy({forest.maxDepth: depth, forest.numTrees: size})]).fit(df)
    return ForestSearch(ordered, depth, size, best)


def fold_f1(
    pipeline: Pipeline, df: DataFrame, key: str, depths: Sequence[int], trees: Sequence[int], folds: int, parallelism: int
) -> dict[tuple[int, int], list[float]]:
    """The weighted F1 of every depth and number of trees on each fold that has rows, from one fitted forest per fold."""
    spark, (*before, forest) = df.sparkSession, pipeline.getStages()
    rows = materialize(with_fold(df, key, folds))
    deepest = {forest.maxDepth: max(depths), forest.numTrees: max(trees), forest.cacheNodeIds: True}

    def judged(fold: int) -> list[tuple[int, int, float]]:
        fitting = rows.filter(F.col("fold") != fold)
        prepared = Pipeline(stages=before).fit(fitting)
        largest = forest.copy(deepest).fit(prepared.transform(fitting))
        held_out = materialize(prepared.transform(rows.filter(F.col("fold") == fold)))
        truth, guess = F.col("label_index").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred")
        frames = [
            cut.transform(held_out).select(F.lit(depth).alias("depth"), F.lit(size).alias("trees"), truth, guess)
            for (depth, size), cut in cut_forests(spark, largest, depths, trees).items()
        ]
        scores = overall_metrics(stack(frames), ("depth", "trees")).select("depth", "trees", "f1_weighted")
        return [tuple(r) for r in scores.collect()]

    found: dict[tuple[int, int], list[float]] = {point: [] for point in product(depths, trees)}
    with ThreadPoolExecutor(parallelism) as pool:
        for scores in pool.map(inheritable_thread_target(spark)(judged), range(folds)):
            for depth, size, f1 in scores:
                found[depth, size].append(f1)
    return found
