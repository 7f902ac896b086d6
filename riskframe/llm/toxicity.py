"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are the distinct lower-case words of a text and their beginnings of ``PREFIXES`` letters, as 64-bit
hashes; those whose presence goes with the toxic label beyond chance (a likelihood ratio of at least
``EVIDENCE``) are learned from. Labelled toxic documents are graded 1 to ``GRADES`` by how much
marks them (quantiles of the sum of their features' log odds); documents labelled clean are grade 0. One weight
vector is shared by all ordered thresholds: P(grade >= k) = sigmoid(w.x - t_k), t_1 < t_2 < .... Weights
and thresholds are learned by gradient descent on a bounded sample: at most ``PER_LABEL`` documents of each
label outside the held-out fold. The output is P(grade >= 1), the expected severity (the sum of
P(grade >= k) over k) and the likeliest grade.

Defined results: a null or empty text has no feature and gets the thresholds' own probabilities; null labels
are not learned from; without both labels all scores are 0; labels that repeat a document count once;
repeated documents keep their rows; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import fold, rows_of, sample_keys

PREFIXES, GRADES, PER_LABEL, LEAST_DOCUMENTS, EVIDENCE = range(3, 8), 3, 2500, 5, 25.0
STEPS, RATE, RIDGE = 300, 0.05, 1e-3
FOLDS, HELD, CUT = 5, 0, 0.45
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
SEEN, TRAIN_SEEN = 400_000, 50_000


def forms(word: str) -> list[int]:
    """Hashes of a word's features: the bare word and its beginnings."""
    bare = _EDGES.sub("", word).lower()
    parts = [f"w {bare}", *[f"p {bare[:n]}" for n in PREFIXES if n < len(bare)]] if bare else []
    return [xxhash.xxh64_intdigest(p) for p in parts]


def places(
    text: str | None, memory: dict[str, list[int]], kept: dict[int, float] | None = None, seen: int = SEEN
) -> set[int]:
    """The distinct features of a whole text, those in ``kept`` only if it is given; ``memory`` is per task."""
    if len(memory) > seen:
        memory.clear()
    out: set[int] = set()
    for word in set((text or "").split()):
        found = memory.get(word)
        if found is None:
            found = memory[word] = [f for f in forms(word) if kept is None or f in kept]
        if found:
            out.update(found)
    return out


@dataclass
class Ordinal:
    weights: dict[int, float]
    cuts: np.ndarray

    def at_least(self, texts: list[str | None], memory: dict[str, list[int]]) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... of each text."""
        linear = np.array([sum(self.weights[p] for p in places(t, memory, self.weights)) for t in texts])
        return _sigmoid(linear[:, None] - self.cuts[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def signs_of(found: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that mark toxic documents beyond chance, in ascending order, and their log odds."""
    every = np.concatenate(found)
    order = np.argsort(every, kind="stable")
    every = every[order]
    labels = np.repeat(toxic.astype(np.int32), [len(f) for f in found])[order]
    del order
    starts = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    both = np.diff(np.append(starts, len(every))).astype(float)
    b = np.add.reduceat(labels, starts).astype(float)
    g, bad, good = both - b, float(toxic.sum()), float((1 - toxic).sum())
    share = both / (bad + good)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (b * np.log(b / (share * bad)) + np.where(g > 0, g * np.log(g / (share * good)), 0.0))
        chosen = (b >= LEAST_DOCUMENTS) & (b * good > g * bad) & (ratio >= EVIDENCE)
    odds = np.log((b + 0.5) / bad) - np.log((g + 0.5) / good)
    return every[starts][chosen], odds[chosen]


def fit(texts: list[str | None], labels: list[int]) -> Ordinal | None:
    toxic = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return None
    memory: dict[str, list[int]] = {}
    found = [np.sort(np.array(list(places(t, memory, seen=TRAIN_SEEN)), dtype=np.uint64)) for t in texts]
    del memory
    signs, odds = signs_of(found, toxic)
    rows = []
    for f in found:
        near = np.searchsorted(signs, f).clip(max=max(0, len(signs) - 1))
        rows.append(near[signs[near] == f] if len(signs) else near[:0])
    evidence = np.array([odds[r].sum() for r in rows])
    edges = np.quantile(evidence[toxic == 1], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic == 1, 1 + np.searchsorted(edges, evidence, "right"), 0)
    column = {int(p): i for i, p in enumerate(signs)}
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    places_at = np.concatenate(rows)
    share = np.array([(grade >= k).mean() for k in range(1, GRADES + 1)]).clip(1e-3, 1 - 1e-3)
    cuts, w = np.log((1 - share) / share), np.zeros(len(column))
    weight = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean())) / len(toxic)
    m, v, mc, vc = np.zeros_like(w), np.zeros_like(w), np.zeros(GRADES), np.zeros(GRADES)
    for step in range(1, STEPS + 1):
        linear = np.bincount(at, w[places_at], len(rows))
        p = _sigmoid(linear[:, None] - cuts[None, :])
        gw, gc = _link_gradient(p, grade, weight)
        g = np.bincount(places_at, gw[at], len(w)) + RIDGE * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2
        mc, vc = 0.9 * mc + 0.1 * gc, 0.99 * vc + 0.01 * gc**2
        rate = RATE * min(1.0, 3 * (1 - step / (STEPS + 1)))
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        cuts = cuts - rate * (mc / (1 - 0.9**step)) / (np.sqrt(vc / (1 - 0.99**step)) + 1e-6)
        cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(GRADES)) - 1e-3 * np.arange(GRADES)
    return Ordinal({p: float(w[i]) for p, i in column.items() if w[i]}, cuts)


def _link_gradient(p: np.ndarray, grade: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the weighted negative log likelihood of P(grade = g) = P(>= g) - P(>= g + 1), per row and per cut."""
    padded = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1)
    row = np.arange(len(p))
    upper, lower = padded[row, grade], padded[row, grade + 1]
    inverse = weight / np.maximum(upper - lower, 1e-6)
    du, dl = -inverse * upper * (1 - upper), inverse * lower * (1 - lower)
    gc = np.zeros(p.shape[1] + 2)
    np.add.at(gc, grade, -du)
    np.add.at(gc, grade + 1, -dl)
    return du + dl, gc[1:-1]


def train(df: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_label: int = PER_LABEL, seed: int = 0) -> Ordinal | None:
    known = labels.filter(F.col(label).isNotNull() & (fold(key, FOLDS) != HELD)).groupBy(key).agg(F.max(label).alias(label))
    keys = sample_keys(known, key, label, per_label, seed)
    drawn = df.select(F.col(key), F.col(text).cast("string").alias("_text")).join(F.broadcast(keys), key)  # per_label rows a label
    rows = drawn.groupBy(key, label).agg(F.min("_text").alias("t")).collect()
    rows.sort(key=lambda r: r[0])
    return fit([r["t"] for r in rows], [int(r[label]) for r in rows])


def grade(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(key, held_out, score, severity, grade, predicted) of every row of ``df``; predicted is 1 from a score of ``CUT``."""
    sent = df.sparkSession.sparkContext.broadcast(train(df, labels, key, text, label))  # one weight per marking feature of the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memory = sent.value, {}
        for batch in batches:
            texts = [t for (t,) in rows_of(batch, "_text")]
            p = model.at_least(texts, memory) if model and texts else np.zeros((len(texts), GRADES))
            single = np.concatenate([np.ones((len(p), 1)), p], axis=1) - np.concatenate([p, np.zeros((len(p), 1))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p[:, 0]), pa.array(p.sum(axis=1)), pa.array(single.argmax(axis=1), pa.int32())],
                names=[key, "held_out", "score", "severity", "grade"],
            )

    held = F.coalesce(fold(key, FOLDS) == HELD, F.lit(False)).alias("held_out")
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key), held, F.col(text).cast("string").alias("_text"))
    scored = rows.mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double, severity double, grade int")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
