"""Frequent keys and crowded days: same results, no task with far more rows than the others."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import integrate, labs, prefix
from riskframe.operators.sizing import hot_keys, lookup_join, skewed_join


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows have one key, a fifth have none."""
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else None if i % 5 == 0 else f"k{rng.randrange(900)}", i, rng.random()) for i in range(6000)]
    return spark.createDataFrame(rows, "k string, i int, x double").repartition(4)


@pytest.fixture(scope="module")
def sides(spark):
    rows = [(f"k{j}", j, "b") for j in range(0, 900, 2)] + [("hot", -1, "a"), ("hot", -2, "c"), (None, -3, "d")]
    return spark.createDataFrame(rows, "k string, j int, kind string")


def plain(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skewed_join_is_the_join(facts, sides, how):
    assert plain(skewed_join(facts, sides, ["k"], how, tasks=16)) == plain(facts.join(sides, "k", how).select(*skewed_join(facts, sides, ["k"], how).columns))


def test_hot_keys_come_from_one_pass(facts):
    found = hot_keys(facts, ["k"], tasks=16)
    assert len(found) == 2 and sum(copies for _, copies in found) in range(6, 12)
    assert hot_keys(facts.filter("k like 'k%'"), ["k"], tasks=16) == [] and hot_keys(facts.limit(0), ["k"]) == []


def test_only_hot_keys_are_copied(spark, facts, sides):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skewed_join(facts, sides, ["k"], "left", tasks=16)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "_salt" in plan
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == facts.join(sides, "k", "left").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_rows_are_spread(spark, facts):
    hot = hot_keys(facts, ["k"], tasks=32)
    parts = facts.withColumn("_s", F.when(F.col("k") == "hot", F.pmod(F.xxhash64("k", "i", "x"), F.lit(max(c for _, c in hot)))).otherwise(F.lit(0)))
    by_key = [r["n"] for r in parts.filter("k is not null").groupBy("k", "_s").agg(F.count("*").alias("n")).collect()]
    assert max(by_key) <= 2 * 6000 / 32


def test_large_summaries_are_not_copied_whole(facts):
    summary = facts.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.max("x").alias("top"))
    joined = lookup_join(facts, summary, ["k"], max_bytes=2)
    assert plain(joined) == plain(facts.join(summary, "k").select(*joined.columns))


def test_keys_of_other_types_meet(spark):
    big = spark.createDataFrame([(1, i) for i in range(300)] + [(2, 0)], "k int, i int")
    other = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert plain(skewed_join(big, other, ["k"], tasks=8)) == plain(big.join(other, "k"))


@pytest.fixture(scope="module")
def one_day(spark):
    rng = random.Random(9)
    rows = [("hot", "2024-03-01", i, rng.random() + i / 900, f"t{i:05d}") for i in range(4000)]
    rows += [(f"k{i % 6}", f"2024-03-0{1 + i % 4}", i, rng.random(), f"t{i:05d}") for i in range(600)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "patient_id string, day string, i int, x double, note_text string").repartition(4)


def test_crowded_day_is_cut(one_day):
    placed = prefix.adaptive_buckets(one_day, ["patient_id"], ["i"], integrate.date_bucket("day"), limit=500)
    rows = placed.collect()
    assert len(rows) == one_day.count()
    sizes, hot = {}, []
    for r in rows:
        key = (r["patient_id"], tuple(r["_bucket"]))
        sizes[key] = sizes.get(key, 0) + 1
        if r["patient_id"] == "hot":
            hot.append((tuple(r["_bucket"]), r["i"]))
    assert max(sizes.values()) <= 500 and len({b for b, _ in hot}) >= 8
    assert [i for _, i in sorted(hot)] == list(range(4000))  # the buckets follow the order
    cut = [n for (who, _), n in sizes.items() if who == "hot"]
    assert max(cut) <= 2 * sum(cut) / len(cut)
    whole = prefix.adaptive_buckets(one_day, ["patient_id"], ["i"], integrate.date_bucket("day"))
    assert {r["_bucket"]["part"] for r in whole.collect()} == {0}


def test_trends_of_a_crowded_day(one_day):
    def slopes(limit):
        found = labs.trend_slopes(one_day, ["patient_id"], ["day", "i"], ["x"], integrate.date_bucket("day"), limit)
        return {r["patient_id"]: r["x_trend"] for r in found.collect()}

    one, many = slopes(1_000_000), slopes(300)
    assert one.keys() == many.keys() and all(many[k] == pytest.approx(one[k], rel=1e-9) for k in one)


def test_texts_of_a_crowded_day(one_day):
    def parts(limit):
        found = integrate.concat_texts(one_day, order=("day", "i"), max_chars=2000, bucket_rows=limit)
        return {(r["patient_id"], r["part"]): r["note_text"] for r in found.collect()}

    one, many = parts(1_000_000), parts(300)
    assert one == many and max(p for _, p in one) >= 10
    hot = " ".join(one[k] for k in sorted(one) if k[0] == "hot")
    assert hot == " ".join(f"t{i:05d}" for i in range(4000)) and max(map(len, one.values())) < 2100


def test_pairs_of_neighbours(spark, one_day):
    for limit in (1_000_000, 300):
        found = prefix.adjacent_pairs(one_day, ["patient_id"], ["i"], "i", "note_text", F.lit(0), limit)
        hot = sorted((r["before"], r["after"]) for r in found.filter("patient_id = 'hot'").collect())
        assert hot == [(i, f"t{i + 1:05d}") for i in range(3999)]
