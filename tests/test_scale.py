"""Skew-safe helpers against brute force, and the shape of the plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import evaluate, integrate, labs, prefix, scorecard, split, text
from riskframe.operators.sizing import lookup_join
from riskframe.plans.views import Views


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds most of the rows."""
    rng = random.Random(7)
    rows = [("hot" if i % 4 else f"k{i % 5}", i, rng.choice([-3.5, 0.0, 1e-9, 2.25, 1e6, rng.random()])) for i in range(2000)]
    return spark.createDataFrame(rows, "k string, i int, x double").repartition(5)


def by_key(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r["k"], []).append(r)
    return groups


def test_value_bucket_is_monotone(spark):
    xs = sorted([-1e300, -5.0, -1.0, -1e-300, 0.0, 1e-300, 1e-9, 0.3, 0.30001, 1.0, 1.5, 1e6, 1e300])
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", prefix.value_bucket("x").alias("b"))
    buckets = [r["b"] for r in df.orderBy("x").collect()]
    assert buckets == sorted(buckets) and len(set(buckets)) > 8


def test_running_totals(hot):
    out = prefix.running_totals(hot, ["k"], ["x", "i"], {"n": F.lit(1), "s": F.col("i")}, prefix.value_bucket("x"))
    for rows in by_key(out).values():
        seen, total = 0, sum(r["i"] for r in rows)
        for position, r in enumerate(sorted(rows, key=lambda r: (r["x"], r["i"]))):
            assert (r["n_before"], r["s_before"], r["n_total"], r["s_total"]) == (position, seen, len(rows), total)
            seen += r["i"]


@pytest.mark.parametrize("interpolate", [True, False])
def test_quantiles(hot, interpolate):
    out = prefix.group_quantiles(hot, ["k"], "x", {"a": 0.25, "b": 0.5, "c": 0.9}, interpolate)
    data = {k: [r["x"] for r in rows] for k, rows in by_key(hot).items()}
    for r in out.collect():
        method = "linear" if interpolate else "inverted_cdf"
        assert [r["a"], r["b"], r["c"]] == pytest.approx(list(np.quantile(data[r["k"]], [0.25, 0.5, 0.9], method=method)))


def test_lookup_join_both_ways(hot):
    sizes = hot.groupBy("k").agg(F.count("*").alias("size"))
    small = lookup_join(hot, sizes, ["k"])
    large = lookup_join(hot, sizes, ["k"], max_bytes=2)
    expected = sorted(map(tuple, small.select("k", "i", "size").collect()))
    assert expected == sorted(map(tuple, large.select("k", "i", "size").collect())) and len(expected) == 2000


def test_trend_slope_does_not_depend_on_the_buckets(hot):
    fits = [
        {r["k"]: r["x_trend"] for r in labs.trend_slopes(hot, ["k"], ["i"], ["x"], bucket).collect()}
        for bucket in (F.lit(0), F.floor(F.col("i") / 7))
    ]
    data = {k: [r["x"] for r in sorted(rows, key=lambda r: r["i"])] for k, rows in by_key(hot).items()}
    for k, xs in data.items():
        slope = np.polyfit(np.arange(1, len(xs) + 1), xs, 1)[0]
        assert fits[0][k] == pytest.approx(slope, rel=1e-6) and fits[1][k] == pytest.approx(slope, rel=1e-6)


def test_trend_of_single_or_missing_values(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 1, 1.0), ("b", 2, None), ("b", 3, 3.0), ("c", 1, None)], "k string, i int, x double")
    got = {r["k"]: r["x_trend"] for r in labs.trend_slopes(df, ["k"], ["i"], ["x"], F.lit(0)).collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 0.0}


def test_texts_continue_in_parts(spark):
    rows = [("a", f"2024-01-{d:02d}", f"note{d:02d}") for d in range(1, 21)] + [("b", "2024-01-01", "x")]
    df = spark.createDataFrame(rows, "patient_id string, note_date string, note_text string")
    parts = integrate.concat_texts(df, max_chars=40).orderBy("patient_id", "part").collect()
    whole = " ".join(r["note_text"] for r in parts if r["patient_id"] == "a")
    assert whole == " ".join(f"note{d:02d}" for d in range(1, 21))
    assert max(r["part"] for r in parts) >= 3 and [r["note_text"] for r in parts if r["patient_id"] == "b"] == ["x"]


def test_split_is_exact_and_stable(spark, hot):
    one = split.stratified_split(hot, "k", "i")
    two = split.stratified_split(hot.repartition(1), "k", "i")
    assert {r["i"]: r["is_train"] for r in one.collect()} == {r["i"]: r["is_train"] for r in two.collect()}
    for rows in by_key(one).values():
        assert sum(r["is_train"] for r in rows) == int(len(rows) * 0.8)
    sampled = by_key(split.sample_per_class(hot, "k", 30, "i"))
    assert all(len(rows) == 30 for rows in sampled.values())


def brute_auc(truth, score):
    pos = [s for t, s in zip(truth, score) if t]
    neg = [s for t, s in zip(truth, score) if not t]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_metrics_by_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        w = [rng.randint(1, 5) for _ in range(3)]
        p = [x / sum(w) for x in w]
        rows.append(("m", i, rng.choice([0, 1, 2]), p.index(max(p)), p))
    df = spark.createDataFrame(rows, "model string, i int, y_true int, y_pred int, prob array<double>")
    aucs = {r["class"]: r["auc"] for r in evaluate.auc_by_class(df).collect()}
    areas = {r["curve"]: r["auc"] for r in evaluate.roc_areas(df).collect()}
    for k in range(3):
        expected = brute_auc([r[2] == k for r in rows], [r[4][k] for r in rows])
        assert aucs[k] == pytest.approx(expected) and areas[f"class {k}"] == pytest.approx(expected)
    pooled = brute_auc([r[2] == k for r in rows for k in range(3)], [r[4][k] for r in rows for k in range(3)])
    assert areas["micro"] == pytest.approx(pooled)
    # Macro average by interpolation on the union grid.
    curves = {k: [] for k in range(3)}
    for r in evaluate.roc_points(df).collect():
        curves[r["class"]].append((r["fpr"], r["tpr"]))
    grid = sorted({x for points in curves.values() for x, _ in points})
    mean = np.mean([np.interp(grid, *zip(*sorted(points))) for points in curves.values()], axis=0)
    got = {r["fpr"]: r["tpr"] for r in evaluate.macro_roc_points(df).collect()}
    assert [got[x] for x in grid] == pytest.approx(list(mean))
    assert areas["macro"] == pytest.approx(np.trapezoid(mean, grid))
    hits = [(max(r[4]), r[3] == r[2]) for r in rows]
    bins = {r["bin"]: r for r in evaluate.calibration(df).collect()}
    assert sum(r["n"] for r in bins.values()) == 200
    assert sum(r["observed"] * r["n"] for r in bins.values()) == pytest.approx(sum(h for _, h in hits))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, small):
    v = Views(spark, small)
    latest = plan(integrate.latest_rows(v.labs, ["patient_id"], "test_date", ("order_no", "line_no")))
    assert latest.count("WindowGroupLimit") == 2  # also before the shuffle
    scored = plan(scorecard.with_symptom_clusters(v.symptoms))
    assert "Exchange" not in scored and "Python" not in scored
    noted = plan(text.with_severity(text.with_negations(text.with_entity_counts(v.notes))))
    assert "Exchange" not in noted and "Python" not in noted
    fences = plan(labs.drop_outliers(v.labs))
    assert "BroadcastHashJoin [test_name" in fences and "Window" not in fences
    filtered = plan(integrate.patient_chart(v.truth, {}, 5)["entity"])
    assert "PushedFilters: [IsNotNull(c_custkey), EqualTo(c_custkey,5)]" in filtered
    assert "CartesianProduct" not in fences + latest + scored + noted


@pytest.mark.parametrize("parts", [1, 3, 8])
@pytest.mark.parametrize("accuracy", [40, 10_000])
def test_exact_quantiles_at_any_size_and_partitioning(spark, parts, accuracy):
    from riskframe.operators.prefix import exact_quantiles

    rows = [(("a", "b")[i % 3 == 0], float((i * 7919) % 1009) - 300) for i in range(3000)] + [("c", None), ("d", 4.0), ("a", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(parts)
    probs = {"low": 0.1, "q1": 0.25, "half": 0.5, "q9": 0.9, "top": 1.0}
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "x", probs, accuracy=accuracy).collect()}
    assert set(got) == {"a", "b", "d"}
    for k, r in got.items():
        values = np.sort([x for g, x in rows if g == k and x is not None])
        assert all(r[n] == values[max(int(np.ceil(len(values) * p)), 1) - 1] for n, p in probs.items())


def test_split_plans_rank_only_what_they_must(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).cast("string").alias("y"))
    sampled = split.sample_per_class(df, "y", 30, "id")
    assert "WindowGroupLimit" in sampled._jdf.queryExecution().toString()
    parts = split.stratified_split(df, "y", "id").groupBy("y", "is_train").count().collect()
    counts = {(r["y"], r["is_train"]): r["count"] for r in parts}
    for y in "012":
        n = counts[y, True] + counts[y, False]
        assert counts[y, True] == int(n * 0.8)
    tiny = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, y string")
    assert sorted((r["y"], r["is_train"]) for r in split.stratified_split(tiny, "y", "id").collect()) == [("a", False), ("b", False), ("b", True)]


def test_correlations_of_many_columns_take_one_scan(spark):
    from riskframe.operators import explore

    columns = [f"c{i}" for i in range(16)]
    df = spark.range(200).select(*[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(97)) + F.col("id") * (i % 3)).alias(c) for i, c in enumerate(columns)])
    df = df.withColumn("c5", F.when(F.col("c4") > 20, F.col("c5")))
    few, many = (
        {(r["feature_a"], r["feature_b"]): r["r"] for r in explore.correlations(df, columns, limit).collect()} for limit in (1000, 5)
    )
    assert few.keys() == many.keys() and len(few) == 120
    assert all(few[k] == pytest.approx(many[k]) for k in few)
    plan = explore.correlations(df, columns, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
