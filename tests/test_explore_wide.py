"""Correlations of many columns and nearest-neighbour information against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import explore


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((500, 4))
    data = base[:, rng.integers(0, 4, 24)] + rng.standard_normal((500, 24))
    data[:, 0] = data[:, 0] * 1e-3 + 1e6  # far from zero
    data[:, 1] = 0.1  # constant
    holes = rng.random(data.shape) < 0.2
    holes[:, 2] = True  # never present
    holes[:, 3] = True
    holes[7, 3] = False  # present once
    rows = [tuple(None if h else float(x) for x, h in zip(a, b, strict=True)) for a, b in zip(data, holes, strict=True)]
    schema = ", ".join(f"c{i} double" for i in range(24))
    return np.where(holes, np.nan, data), spark.createDataFrame(rows, schema).repartition(7)


def test_wide_correlations_are_pairwise_complete(wide):
    data, df = wide
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in explore.correlations(df, df.columns).collect()}
    assert len(got) == 24 * 23 // 2
    for i in range(24):
        for j in range(i + 1, 24):
            both = ~np.isnan(data[:, i]) & ~np.isnan(data[:, j])
            r = got[f"c{i}", f"c{j}"]
            if both.sum() < 2:
                assert r is None
            elif 1 in (i, j):
                assert math.isnan(r)
            else:
                assert r == pytest.approx(np.corrcoef(data[both, i], data[both, j])[0, 1], abs=1e-8)


def test_wide_and_narrow_forms_agree(wide):
    _, df = wide
    some = [f"c{i}" for i in range(4, 12)]
    one = {(r["feature_a"], r["feature_b"]): r["r"] for r in explore.correlations(df, some).collect()}
    two = {(r["feature_a"], r["feature_b"]): r["r"] for r in explore.correlations(df, some, per_row=0).collect()}
    assert one.keys() == two.keys() and all(two[k] == pytest.approx(v, abs=1e-12) for k, v in one.items())


def test_wide_correlations_shuffle_matrices_only(spark, wide):
    _, df = wide
    many = df.unionAll(df).unionAll(df).coalesce(2)
    plan = explore.correlations(many, df.columns)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Join" not in plan
    assert explore.correlations(df.limit(0), df.columns).filter(F.col("r").isNotNull()).count() == 0


def digamma(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def test_digamma(spark):
    df = spark.range(1, 40).select("id", explore.digamma(F.col("id")).alias("x"))
    assert all(r["x"] == pytest.approx(digamma(r["id"]), abs=1e-11) for r in df.collect())


def brute_information(rows, k):
    sizes = {}
    for _, c in rows:
        sizes[c] = sizes.get(c, 0) + 1
    rows = [r for r in rows if sizes[r[1]] > 1]
    total = 0.0
    for i, (x, c) in enumerate(rows):
        kk = min(k, sizes[c] - 1)
        d = sorted(abs(x - y) for j, (y, e) in enumerate(rows) if e == c and j != i)[kk - 1]
        m = sum(abs(x - y) < d if d > 0 else x == y for y, _ in rows)
        total += digamma(kk) - digamma(sizes[c]) - digamma(m)
    return max(0.0, digamma(len(rows)) + total / len(rows))


@pytest.mark.parametrize("block", [4096, 5])
def test_information_of_nearest_neighbours(spark, block):
    rng = random.Random(6)
    rows = []
    for i in range(260):
        c = rng.choice("aab") if i else "alone"
        rows.append((rng.randrange(12) + 3 * (c == "b"), rng.randrange(1000) / 8 + 40 * (c == "b"), float(i % 2) if i % 9 else None, c))
    df = spark.createDataFrame(rows, "ties int, fine double, noise double, class string").repartition(5)
    found = explore.mutual_information_nearest(df, ["ties", "fine", "noise"], "class", block=block).collect()
    got = {r["feature"]: r["mi_score"] for r in found}
    for at, name in enumerate(("ties", "fine", "noise")):
        assert got[name] == pytest.approx(brute_information([(r[at] or 0.0, r[3]) for r in rows], 3), abs=1e-9)
    assert got["fine"] > 0.2 > got["noise"]
