"""Token counts, whitening and centroid clustering against the plain library, dense algebra and brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskframe.llm import centroids, token_counts, whitening
from riskframe.llm.queries import ORACLES, QUERIES, TOKENIZERS
from tests.llm.test_operators import odd
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.01"
WORD = f"{TOKENIZERS}/word_bpe_49k.json"
VECTORS = "vec_id long, embedding array<float>, n string, cluster int"
ODD_VECTORS = [
    (1, [0.5, 0.25, -1.0], "x", 1),
    (1, [0.5, 0.25, -1.0], "x", 1),
    (2, None, None, None),
    (3, [0.1, None, 0.2], "y", 2),
    (4, [0.1, float("nan"), 0.2], "y", 2),
    (5, [0.1, float("inf"), 0.2], "y", 2),
    (6, [], "y", 2),
    (None, [0.0, 2.5, 0.125], None, None),
    (8, [0.3, -0.7, 0.9], "z", 3),
    (9, [0.3, -0.7, 0.8], "z", 3),
]


# --- token counts


def test_counts_are_those_of_the_plain_library(spark):
    rng = random.Random(5)
    parts = ["a", "B", " ", " ", "\n", "\t", "\x0b", "\x1c", "'s", "9", "#!", "é", "é", "́", " ", " ", "İ", "Σ", "ς", "中", "가", "<|endoftext|>", "<|startoftext|>", "word"]
    texts = [None, "", " ", "\n\n", *["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(3000)]]
    plain = Tokenizer.from_file(WORD)
    want = [(len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False).ids)) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for piece in (token_counts.PIECE_BYTES, 7):  # the second cuts nearly every text
        got = {r.doc_id: r for r in token_counts.count_tokens(df, WORD, limit=20, piece_bytes=piece, batch_bytes=500).collect()}
        assert len(got) == len(texts)
        for i, (size, count) in enumerate(want):
            assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (size, count, count > 20), ascii(texts[i])


def test_counts_of_the_query(spark):
    plain = Tokenizer.from_file(WORD)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op11_token_counts"](spark, FOLDER).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {d: len(plain.encode(t or "", add_special_tokens=False).ids) for d, t in texts.items()}
    assert len(rows) == len(texts) and all(r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_counts_of_odd_rows(spark):
    df = odd(spark)
    for piece in (token_counts.PIECE_BYTES, 1000):
        rows = token_counts.count_tokens(df, WORD, carry=["doc_id", "kept", "fp"], piece_bytes=piece).collect()
        assert sorted((str(r.doc_id), r.n_bytes) for r in rows) == sorted((str(r.doc_id), len((r.text or "").encode())) for r in df.collect())
        assert [r.n_tokens for r in rows if r.doc_id == 1] == [0] and len({r.n_tokens for r in rows if r.doc_id == 7}) == 1
    assert token_counts.count_tokens(df.limit(0), WORD).collect() == []
    with pytest.raises(ValueError, match="names of results"):
        token_counts.count_tokens(df.withColumnRenamed("kept", "N_Tokens"), WORD, carry=["N_Tokens"])
    with pytest.raises(Exception, match="keeps white space"):
        token_counts.Counter(f"{TOKENIZERS}/byte_bpe_50k.json")


def test_batches_are_balanced_by_bytes_and_pieces_give_back_the_text():
    sizes = np.array([5, 5, 5, 100, 1, 1, 0, 9])
    assert list(token_counts.balanced(sizes, 10)) == [(0, 2), (2, 3), (3, 4), (4, 7), (7, 8)]
    text = ("wörter und mehr " * 50 + "x" * 300).encode()
    pieces = list(token_counts.split(text, 40))
    assert b"".join(pieces) == text and len(pieces) > 10 and all(p.decode() for p in pieces)


# --- whitening


@pytest.mark.parametrize(
    "values",
    [
        [5, 5, 5, 3, 3, 1, 1, 1, 0, 0, 0, 0.5],
        [1, 1 - 1e-10, 1 - 2e-10, 0.5, 0.5, 0.1, 0, 0, 0],
        [2] * 10,
        [9, 1],
        [4],
        [0] * 5,
        list(np.geomspace(1e6, 1e-6, 40)),
    ],
)
def test_leading_vectors_of_clustered_and_degenerate_matrices(values):
    rng = np.random.default_rng(2)
    basis = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    for matrix in (basis @ np.diag(np.array(values, float)) @ basis.T, np.diag(np.array(values, float))):
        matrix, k, size = (matrix + matrix.T) / 2, min(8, len(values)), max(values) or 1
        found, vectors = whitening.leading_eigen(matrix, k)
        assert np.abs(found - sorted(values, reverse=True)[:k]).max() <= 1e-13 * size
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() <= 1e-12
        assert np.abs(matrix @ vectors - vectors * found).max() <= 1e-13 * size


def test_sturm_counts_hit_eigenvalues():
    assert whitening.leading_values(np.array([2.0, 2.0]), np.array([1.0]), 2) == pytest.approx([3, 1], abs=1e-14)
    assert whitening.sturm_counts(np.array([2.0, 2.0]), np.array([1.0]), np.array([0.5, 2.0, 3.5])).tolist() == [0, 1, 2]


def test_whitening_query_against_dense_algebra(spark):
    source = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas()
    whole = np.floor(1024 * np.stack(list(source.embedding)).astype(float)).astype(np.int64) + 100_000
    n, sums = len(whole), whole.sum(axis=0)
    centred = (n * whole - sums) / n
    matrix = centred.T @ centred / n
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    rows = QUERIES["op12_embedding_whitening"](spark, FOLDER).collect()
    assert len(rows) == 8 * n and {r.n for r in rows} == {n}
    place = {v: i for i, v in enumerate(source.vec_id.tolist())}
    got = np.zeros((n, 8))
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(matrix), rel=1e-9)
        assert r.deviation == int(((n * whole[place[r.vec_id]] - sums) ** 2).sum())
    want = centred @ vectors[:, :8] / np.sqrt(values[:8])
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-9
    assert 0 <= rows[0].identity_error < 1e-9 and np.abs(got.T @ got / n - np.eye(8)).max() < 1e-9


def test_whitening_of_odd_vectors(spark):
    df = spark.createDataFrame(ODD_VECTORS, VECTORS)
    rows = whitening.whiten(df).collect()
    assert sorted(str(r.vec_id) for r in rows) == ["1", "1", "8", "9", "None"] and {r.n for r in rows} == {5}
    assert all(len(r.whitened) == 3 for r in rows) and rows[0].identity_error < 1e-6
    flat = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(flat).collect()
    assert all(r.whitened[1] is None and r.whitened[0] is not None and r.explained == [1.0, 0.0] for r in rows)
    same = whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r.whitened, r.identity_error, r.deviation) for r in same] == [([None], None, 0)] * 2
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.filter("vec_id = 2")).collect() == []
    wide = spark.createDataFrame([(1, [2.0e6]), (2, [-2.0e6]), (3, [0.0])], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.deviation for r in whitening.whiten(wide, scale=1000).collect()} == {1: None, 2: None, 3: 0}


def test_centred_products_survive_a_large_offset(spark):
    rng = np.random.default_rng(0)
    points = rng.standard_normal((300, 5)) + 3e5
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    whole = np.floor(1024 * points).astype(np.int64)
    values = np.linalg.eigvalsh(np.cov((whole - whole[0]).T, bias=True))[::-1]
    got = whitening.whiten(df).first()
    assert got.explained == pytest.approx((values / values.sum()).tolist(), rel=1e-9)


# --- centroid clustering


def brute(vectors, k, rounds, seed=3):
    """(key -> cluster, distance) by plain loops over whole numbers."""
    order = sorted((hashlib.sha256(f"{seed}:{key}".encode()).hexdigest(), v) for key, v in vectors if key is not None)
    centres = [list(v) for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in vectors:
            groups.setdefault(near(v)[1], []).append(v)
        for i, group in groups.items():
            centres[i] = [sum(x) // len(group) for x in zip(*group, strict=True)]
    return [(key, near(v)[1], near(v)[0]) for key, v in vectors], centres


def test_clusters_match_sql(spark):
    assert differences(QUERIES["op13_centroid_clusters"](spark, FOLDER), connect(FOLDER), ORACLES["op13_centroid_clusters"]) == []


def test_clusters_of_odd_vectors_match_brute_force(spark):
    rng = random.Random(1)
    rows = [*ODD_VECTORS, *[(100 + i, [rng.choice([-1, 0, 3]) + rng.random() / 9, rng.random(), 5.0], "t", 0) for i in range(300)]]
    rows += [(900, [3.0, 0.5, 5.0], None, None)] * 200  # many copies of one vector
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    kept = [(r.vec_id, [int(np.floor(float(x) * 1024)) for x in r.embedding]) for r in df.collect()
            if r.embedding and len(r.embedding) == 3 and all(x is not None and np.isfinite(x) for x in r.embedding)]
    want, centres = brute(kept, 4, 6)
    for bits, sample in ((6, 4096), (2, 16)):
        got = centroids.cluster(df, dims=3, k=4, rounds=6, bits=bits, sample=sample).collect()
        assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got) == sorted((str(k), c, d) for k, c, d in want)
        assert {r.inertia for r in got} == {sum(d for *_, d in want)}
        for r in got:
            assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
            assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()
    assert centroids.cluster(df.limit(0), dims=3).collect() == [] and centroids.cluster(df, dims=4).collect() == []
    assert {r.cluster for r in centroids.cluster(df.filter("vec_id in (8, 9)"), dims=3).collect()} == {0, 1}


def test_intervals_hold_every_distance_and_cells_pack():
    rng = np.random.default_rng(4)
    whole = rng.integers(-500, 900, (400, 7)).astype(np.int32)
    cells = centroids.Cells(whole[:50], whole.min(axis=0), whole.max(axis=0), 4)
    packed = cells.pack(whole)
    assert packed.shape == (400, 4)
    low, high = cells.intervals(cells.unpack(packed, 7), centres := rng.integers(-500, 900, (5, 7)))
    middle = np.round(centres.mean(axis=0)).astype(np.int64)
    exact = np.stack([((whole - c) ** 2).sum(axis=1) for c in centres], axis=1) - ((whole - middle) ** 2).sum(axis=1)[:, None]
    assert (low <= exact).all() and (exact <= high).all()


def test_few_vectors_are_fetched_where_clusters_are_apart(spark):
    rng = np.random.default_rng(6)
    points = rng.integers(0, 8, 4000)[:, None] * np.array([3.0, -2.0, 1.0]) + rng.random((4000, 3)) / 4
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    report = []
    centroids.cluster(df, dims=3, k=8, rounds=6, report=report).count()
    assert report[0] == (4000, 4000) and all(seen == 4000 for seen, _ in report) and report[-1][1] < 4000 / 3


