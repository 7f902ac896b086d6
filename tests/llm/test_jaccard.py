"""The near_dedup stage against brute-force Jaccard similarity."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa

import corpus_pipeline
from riskframe.llm import jaccard, simhash
from tests.llm.test_operators import odd

FOLDER = "/root/testdata/sf0.01"


def brute(texts: dict, size: int = 5) -> dict:
    """Smallest id of each document's component, from all pairs."""
    sets = {}
    for doc, text in texts.items():
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        sets[doc] = frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        one, other = sets[a], sets[b]
        if 5 * min(len(one), len(other)) < 4 * max(len(one), len(other)):
            continue
        if 5 * len(one & other) >= 4 * len(one | other):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: find(d) for d in sets}


def test_stage_removes_what_is_similar_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    expected = set(brute(texts).values())
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, FOLDER).collect()} == expected


def test_components_at_the_bound_and_in_groups_without_a_common_centre(spark):
    words = [f"w{i}" for i in range(200)]
    texts = {n: " ".join([f"x{n}" if i in (n * 7 % 190, n * 31 % 190) else w for i, w in enumerate(words)]) for n in range(40)}
    texts[50] = " ".join(words)
    texts |= {60: "one two three", 61: "One  two three", 62: "one two four", 63: None, 64: "", 65: "a b c d e f g h", 66: "a b c d e f g h i"}
    texts |= {70: "p q r s t u v w x", 71: "q r s t u v w x"}  # 4 of 5 shingles
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component for r in jaccard.near_duplicates(df).collect()}
    assert got == brute(texts) and got[71] == 70 and got[66] == 65


def test_order_of_shingles_changes_no_result(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    first = {tuple(r) for r in jaccard.near_duplicates(df).collect()}
    monkeypatch.setattr(jaccard, "OFTEN", 1 << 30)
    assert {tuple(r) for r in jaccard.near_duplicates(df).collect()} == first


def test_odd_and_empty_tables(spark):
    assert jaccard.keep_first(odd(spark).limit(0)).count() == 0
    kept = jaccard.keep_first(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 7, 8]


def test_fingerprints_in_trees_link_and_the_sets_decide(spark, monkeypatch):
    """Without the search by prefixes the BK-trees still link near copies, and only those whose sets are similar enough."""
    words = [f"w{i}" for i in range(400)]
    base = " ".join(words)
    near = next(t for i in range(3, 390) if (simhash.fingerprint(base, 5) ^ simhash.fingerprint(t := " ".join([*words[:i], "x", *words[i + 1 :]]), 5)).bit_count() <= 4)
    other = " ".join(f"v{i}" for i in range(300))
    repeated = " ".join([*words] * 3 + ["end"])  # other repeats, nearly the same set
    df = spark.createDataFrame([(1, base), (2, near), (3, other), (4, base), (5, None), (6, ""), (7, repeated)], "doc_id long, text string")
    monkeypatch.setattr(jaccard, "_possible", lambda pairs, *_: pairs.limit(0))
    got = {r.doc_id: r.component for r in jaccard.near_duplicates(df).collect()}
    assert {k: got[k] for k in (1, 2, 3, 4, 5, 6)} == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 5}
    monkeypatch.setattr(jaccard, "near_links", lambda distinct: distinct.crossJoin(distinct.toDF("b")).toDF("a", "b"))
    got = {r.doc_id: r.component for r in jaccard.near_duplicates(df).collect()}
    assert got == brute({r.doc_id: r.text for r in df.collect()})


def test_common_passage_proposes_few_pairs(spark, monkeypatch):
    """Documents with a long passage in common but too little for a link: each proposes a pair or two, not one with each other."""
    common = [f"c{i}" for i in range(180)]
    texts = {n: " ".join([*common, *[f"w{n}x{i}" for i in range(120)]]) for n in range(40)}
    texts |= {100 + n: f"{texts[n]} end" for n in range(0, 40, 10)}
    proposed, possible = [], jaccard._possible
    monkeypatch.setattr(jaccard, "OFTEN", 1 << 30)  # the order does not put the passage last
    monkeypatch.setattr(jaccard, "_possible", lambda pairs, *rest: proposed.append(pairs.count()) or possible(pairs, *rest))
    got = {r.doc_id: r.component for r in jaccard.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == brute(texts) and got[130] == 30
    assert sum(proposed) <= 2 * len(texts)


def test_parities_never_overstate_a_difference(spark):
    rng = np.random.default_rng(1)
    sets = []
    for n in (0, 1, 2, 60, 129, 130, 500, 1100):
        one = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        sets += [(one, one), (one, one[: len(one) * 4 // 5]), (one, np.unique(np.concatenate([one[n // 9 :], rng.integers(0, 1 << 62, n // 3)])))]
    rows = [(jaccard._parities(a).tolist(), jaccard._parities(b).tolist(), len(np.setxor1d(a, b))) for a, b in sets]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, apart int").select(jaccard._unlike("a", "b").alias("least"), "apart")
    found = df.collect()
    assert all(r["least"] <= r["apart"] for r in found) and any(r["least"] > 0.7 * r["apart"] > 50 for r in found)


def near_copies(count: int) -> dict:
    """Copies of a text with two other words each: most pairs are just too different for a link, some are not."""
    rng, words = np.random.default_rng(3), [f"w{i}" for i in range(146)]
    texts = {}
    for n in range(count):
        at = set(rng.integers(0, 146, 2).tolist())
        texts[n] = " ".join(f"x{n}" if i in at else w for i, w in enumerate(words))
    return texts


def test_near_copies_below_the_bound_propose_few_pairs(spark, monkeypatch):
    """A group of n near copies proposes a few pairs a copy, not n pairs a copy."""
    texts, proposed, possible = near_copies(160), [], jaccard._possible
    monkeypatch.setattr(jaccard, "_possible", lambda pairs, *rest: proposed.append(pairs.count()) or possible(pairs, *rest))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component for r in jaccard.near_duplicates(df).collect()} == brute(texts)
    assert sum(proposed) <= 8 * len(texts)


def test_slices_of_a_shingle_lose_no_pair(spark, monkeypatch):
    """A shingle cut into slices proposes what lies between components and may be similar; at first each node's nearest only."""
    sets = sorted([jaccard.shingles(t) for t in near_copies(40).values()], key=len)
    rows = [(token, node, len(s), node // 3, jaccard._parities(s).tolist(), slices) for token, slices in ((1, 3), (2, None)) for node, s in enumerate(sets)]
    placed = spark.createDataFrame(rows, "token long, node long, n int, root long, bits array<long>, slices long")
    pairs, again = jaccard._proposals(placed, 8, True)
    found = {tuple(r) for r in pairs.collect()}
    similar = {(a, b) for a, b in combinations(range(40), 2) if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    assert {(a, b) for a, b in similar if a // 3 != b // 3} <= found and similar and again.count() == 0
    assert all(a // 3 != b // 3 for a, b in found)
    monkeypatch.setattr(jaccard, "MANY", 0)
    pairs, again = jaccard._proposals(placed, 8, False)
    nearest = {tuple(r) for r in pairs.collect()}
    assert nearest <= found and 0 < len(nearest) <= 40 and {r.token for r in again.collect()} == {1, 2}
    assert {n for pair in nearest for n in pair} == {n for pair in found for n in pair}


def test_compared_nodes_of_all_sizes_lose_no_similar_pair():
    rng = np.random.default_rng(2)
    sets = []
    for n in (1, 3, 60, 64, 65, 70, 120, 129, 500, 520, 17000, 20000):
        one = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        sets += [one, one[: max(1, len(one) * 9 // 10)], np.unique(np.concatenate([one[n // 12 :], rng.integers(0, 1 << 62, n // 12)]))]
    sets.sort(key=len)
    names, values = ["node", "n", "root", "side", "bits"], list(range(len(sets)))
    bits = pa.array([jaccard._parities(s) for s in sets], pa.list_(pa.int64()))
    group = pa.RecordBatch.from_arrays([pa.array(values), pa.array([len(s) for s in sets], pa.int32()), pa.array(values), pa.array([0] * len(sets), pa.int32()), bits], names=names)
    one, other, _ = jaccard._compared(group, 8)
    found = set(zip(one.tolist(), other.tolist(), strict=True))
    similar = {(a, b) for a, b in combinations(values, 2) if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    assert len(similar) > 20 and similar <= found and len(found) < 3 * len(similar)
