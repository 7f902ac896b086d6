"""Isolation forest: trees are grown on small hashed samples in parallel, scoring runs where the rows are."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.operators.fusion import min_max_inverted
from riskframe.operators.prefix import exact_quantiles
from riskframe.session import materialize

_NODE = "tree int, node int, feature int, cut double, left int, right int, path double"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


@dataclass
class IsolationForest:
    """Fitted forest: node table, scaling, and the score above which a row is an anomaly."""

    columns: list[str]
    means: list[float]
    scales: list[float]
    nodes: pd.DataFrame
    sample_size: int
    threshold: float | None = None

    def raw_scores(self, df: DataFrame, name: str = "raw_score") -> DataFrame:
        """Add the isolation score in (0, 1]; a higher score is more anomalous. NULL counts as 0."""
        spark = df.sparkSession
        forest = spark.sparkContext.broadcast(_as_arrays(self.nodes))
        scale = average_path(self.sample_size)
        means, scales = np.array(self.means), np.array(self.scales)

        @F.pandas_udf("double")
        def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            feature, cut, left, right, path, roots = forest.value
            for rows in parts:
                x = (np.vstack(rows.to_numpy()) - means) / scales if len(rows) else np.zeros((0, len(means)))
                depth = np.zeros(len(x))
                index = np.arange(len(x))
                for root in roots:
                    at = np.full(len(x), root)
                    while True:
                        inner = left[at] >= 0
                        if not inner.any():
                            break
                        go_left = x[index, np.maximum(feature[at], 0)] < cut[at]
                        at = np.where(inner, np.where(go_left, left[at], right[at]), at)
                    depth += path[at]
                yield pd.Series(np.power(2.0, -depth / len(roots) / scale))

        return df.withColumn(name, score(_vector(self.columns)))

    def detect(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` (0-1 over the table, 1 is the most anomalous) and ``is_anomaly``.

        The rows are scored once and saved; the limits of the score come from the saved scores.
        """
        if self.threshold is None:
            raise RuntimeError("the forest has no threshold; fit it first")
        return self._judged(materialize(self.raw_scores(df, "_raw")))

    def _judged(self, scored: DataFrame) -> DataFrame:
        flagged = scored.withColumn("_low_is_odd", -F.col("_raw"))
        flagged = flagged.withColumn("is_anomaly", (F.col("_raw") > F.lit(self.threshold)).cast("int"))
        return min_max_inverted(flagged, "_low_is_odd").drop("_raw", "_low_is_odd")

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, _NODE).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        settings = {k: v for k, v in asdict(self).items() if k != "nodes"}
        spark.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/settings"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IsolationForest":
        settings = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        return cls(nodes=spark.read.parquet(f"{path}/nodes").toPandas(), **settings)


def _vector(columns: list[str]) -> Column:
    values = []
    for c in columns:
        value = F.col(c).cast("double")
        values.append(F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value))
    return F.array(*values)


def _as_arrays(nodes: pd.DataFrame) -> tuple:
    """Flatten all trees into arrays with global node numbers."""
    ordered = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
    start = ordered.groupby("tree")["node"].transform("size")
    offsets = ordered.groupby("tree", sort=True).size().cumsum().shift(fill_value=0)
    base = ordered["tree"].map(offsets).to_numpy()
    left = np.where(ordered["left"] >= 0, ordered["left"] + base, -1)
    right = np.where(ordered["right"] >= 0, ordered["right"] + base, -1)
    assert (start > 0).all()
    return (
        ordered["feature"].to_numpy(),
        ordered["cut"].to_numpy(),
        left,
        right,
        ordered["path"].to_numpy(),
        offsets.to_numpy(),
    )


def fit_forest(df: DataFrame, columns: list[str], key: str = "patient_id", contamination: float = 0.1, **growing) -> IsolationForest:
    """Grow a forest (see ``grow_forest``) and set the threshold, which a share ``contamination`` of the rows exceeds."""
    forest = grow_forest(df, columns, key, **growing)
    forest.threshold = _threshold(forest.raw_scores(df.select(*columns), "_raw").select("_raw"), contamination)
    return forest


def fit_and_detect(
    df: DataFrame, columns: list[str], key: str = "patient_id", contamination: float = 0.1, **growing
) -> tuple[IsolationForest, DataFrame]:
    """``fit_forest`` and ``detect`` on the same rows, which are scored once: threshold, limits and result come from the saved scores."""
    forest = grow_forest(df, columns, key, **growing)
    scored = materialize(forest.raw_scores(df, "_raw"))
    forest.threshold = _threshold(scored.select("_raw"), contamination, saved=True)
    return forest, forest._judged(scored)


def _threshold(scores: DataFrame, contamination: float, saved: bool = False) -> float:
    rows = scores.select(F.lit(0).alias("all"), "_raw")
    rows = rows if saved else materialize(rows)
    cut = exact_quantiles(rows, ["all"], "_raw", {"cut": 1.0 - contamination}, bounded_groups=True)
    return float(cut.first()["cut"])


def grow_forest(
    df: DataFrame, columns: list[str], key: str = "patient_id", trees: int = 200, sample_size: int = 256, seed: int = 42
) -> IsolationForest:
    """Standardise, draw ``sample_size`` rows per tree by hash and grow the trees in parallel.

    Every row computes for which trees a hash of tree and key lies below a limit that about twice the sample
    reaches; only these (tree, row) pairs are made, and the smallest hashes of a tree are its sample. The draw is
    the same at every size and for every partitioning.
    """
    data = df.select(F.col(key).cast("string").alias("_key"), _vector(columns).alias("_x"))
    moments = data.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col("_x")[i]).alias(f"m{i}") for i in range(len(columns))],
        *[F.stddev_pop(F.col("_x")[i]).alias(f"s{i}") for i in range(len(columns))],
    ).first()
    n = moments["n"]
    if not n:
        raise ValueError("no rows to fit on")
    means = [float(moments[f"m{i}"]) for i in range(len(columns))]
    scales = [float(moments[f"s{i}"]) or 1.0 for i in range(len(columns))]

    limit = int(min(1.0, (2 * sample_size + 64) / n) * 2**31)
    every = F.sequence(F.lit(0), F.lit(trees - 1))
    drawn = F.filter(every, lambda t: F.pmod(F.xxhash64(F.lit(seed), t, F.col("_key")), F.lit(2**31)) < F.lit(limit))
    per_tree = data.withColumn("tree", F.explode(drawn))
    draw = F.pmod(F.xxhash64(F.lit(seed), "tree", "_key"), F.lit(2**31))
    order = Window.partitionBy("tree").orderBy(draw, "_key")
    sample = (
        per_tree.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= sample_size).drop("_rn", "_key")
    )
    center, spread = np.array(means), np.array(scales)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        x = (np.vstack(rows["_x"].to_numpy()) - center) / spread
        x = x[np.lexsort(x.T)]
        rng = np.random.default_rng([seed, tree])
        limit = int(np.ceil(np.log2(max(len(x), 2))))
        nodes: list[list] = []
        waiting = [(x, 0, -1, False)]
        while waiting:
            part, level, parent, is_left = waiting.pop()
            number = len(nodes)
            if parent >= 0:
                nodes[parent][4 if is_left else 5] = number
            low, high = part.min(axis=0), part.max(axis=0)
            open_features = np.flatnonzero(high > low)
            if level >= limit or len(part) <= 1 or len(open_features) == 0:
                size = len(part)
                rest = 0.0 if size <= 1 else 1.0 if size == 2 else (
                    2.0 * (np.log(size - 1.0) + np.euler_gamma) - 2.0 * (size - 1.0) / size
                )
                nodes.append([tree, number, -1, 0.0, -1, -1, level + rest])
                continue
            feature = int(rng.choice(open_features))
            cut = float(rng.uniform(low[feature], high[feature]))
            cut = cut if cut > low[feature] else float(high[feature])
            below = part[:, feature] < cut
            nodes.append([tree, number, feature, cut, -1, -1, 0.0])
            waiting.append((part[~below], level + 1, number, False))
            waiting.append((part[below], level + 1, number, True))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "path"])

    # At most trees x (2 x sample_size) nodes: a fixed size, whatever the table.
    nodes = sample.groupBy("tree").applyInPandas(grow, _NODE).toPandas()
    return IsolationForest(list(columns), means, scales, nodes, min(sample_size, n))
