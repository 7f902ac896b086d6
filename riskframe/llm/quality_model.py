"""Quality classifier by attention-based multiple-instance learning, in numpy.

A document is a bag of passages of ``PASSAGE`` words. Every passage of the whole text is described by shares of
neighbouring byte classes and by word repetition, and encoded by a tanh layer. Gated attention
(tanh times sigmoid) weighs the passages; the weighted sum of their encodings is scored by a logistic unit. All
weights are learned together from document labels, by gradient descent on a bounded sample: at most
``PER_LABEL`` labelled documents of each label (first by a seeded hash of the key). Nothing but text and label is
read, and labels only of rows outside the held-out fold.

Defined results: a null or empty text is one empty passage and gets that passage's score; null labels are not
learned from; with fewer than two labels every score is the share of label 1 (one half without labels); labels
that repeat a document count once; repeated documents keep their rows; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import fold, rows_of, sample_keys, words_of

PASSAGE, PER_LABEL, WIDTH, GATE = 64, 1500, 16, 8
STEPS, BATCH, RATE, DECAY = 400, 128, 0.02, 1e-4
FOLDS, HELD, CUT = 5, 0, 0.3
PIECE = 256
CLASSES = 9


def _byte_classes() -> np.ndarray:
    """Class of each byte: other, lower, upper, digit, blank, sentence sign, symbol, quote or bracket, above ASCII."""
    table = np.zeros(256, np.int64)
    for number, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b".,;:!?-", b"#*$%&|<>", b"\"'()[]{}/\\_=+@~^`"), 1):
        table[list(members)] = number
    table[128:] = CLASSES - 1
    return table


BYTE_CLASS = _byte_classes()
FEATURES = CLASSES * CLASSES + 5


def passages(text: str | None) -> list[list[bytes]]:
    words = words_of(text or "")
    return [words[i : i + PASSAGE] for i in range(0, len(words), PASSAGE)] or [[]]


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of all texts, and the number of passages of each text."""
    bags = [passages(t) for t in texts]
    every = [p for bag in bags for p in bag]
    lines = [b" ".join(p) for p in every]
    raw = np.frombuffer(b"\x00".join(lines) + b"\x00", np.uint8)
    owner = np.repeat(np.arange(len(lines)), [len(x) + 1 for x in lines])
    kinds = BYTE_CLASS[raw]
    pairs = owner[:-1] * (CLASSES * CLASSES) + kinds[:-1] * CLASSES + kinds[1:]
    inside = (raw[:-1] != 0) & (raw[1:] != 0)
    counts = np.bincount(pairs[inside], minlength=len(lines) * CLASSES * CLASSES).reshape(len(lines), -1)
    out = np.zeros((len(lines), FEATURES), np.float32)
    sizes = np.array([len(p) for p in every])
    out[:, : CLASSES * CLASSES] = np.sqrt(counts / np.maximum(1, np.array([len(x) for x in lines]))[:, None])
    out[:, -5] = [len(set(p)) for p in every] / np.maximum(1, sizes)
    out[:, -4] = [sum(a == b for a, b in zip(p, p[1:], strict=False)) for p in every] / np.maximum(1, sizes)
    out[:, -3] = np.array([len(x) for x in lines]) / np.maximum(1, sizes) / 10
    out[:, -2] = np.minimum(sizes, PASSAGE) / PASSAGE
    out[:, -1] = sizes == 0
    return out, np.array([len(bag) for bag in bags])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionPool:
    """Encoder, gated attention and logistic unit over bags of passages."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.mean, self.scale = mean, scale
        self.weights = {
            "e": draw(len(mean), WIDTH), "eb": np.zeros(WIDTH, np.float32), "v": draw(WIDTH, GATE), "u": draw(WIDTH, GATE),
            "a": draw(GATE, 1)[:, 0], "o": draw(WIDTH, 1)[:, 0], "ob": np.zeros(1, np.float32),
        }

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of the bags and everything the gradient needs; passages of a bag are adjacent rows."""
        w, starts = self.weights, np.cumsum(counts) - counts
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ w["e"] + w["eb"])
        t, g = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
        raw = (t * g) @ w["a"]
        weight = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), counts))
        weight /= np.repeat(np.add.reduceat(weight, starts), counts)
        z = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "weight": weight, "z": z, "score": _sigmoid(z @ w["o"] + w["ob"])}

    def gradient(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss of the bags."""
        w, f = self.weights, self.forward(x, counts)
        starts = np.cumsum(counts) - counts
        d = (f["score"] - y) / len(y)
        grad = {"o": f["z"].T @ d, "ob": d.sum(keepdims=True)}
        dz = np.repeat(d[:, None] * w["o"], counts, axis=0)
        dh = f["weight"][:, None] * dz
        dweight = (dz * f["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(f["weight"] * dweight, starts), counts)
        draw = f["weight"] * (dweight - mean)
        dtg = draw[:, None] * w["a"]
        grad["a"] = (f["t"] * f["g"]).T @ draw
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        grad |= {"v": f["h"].T @ dt, "u": f["h"].T @ dg}
        dh = (dh + dt @ w["v"].T + dg @ w["u"].T) * (1 - f["h"] ** 2)
        return grad | {"e": f["x"].T @ dh, "eb": dh.sum(axis=0)}


def fit(texts: list[str | None], labels: list[int], seed: int = 0) -> AttentionPool | float:
    """The trained model, or the share of label 1 when there is but one label."""
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return float(y.mean()) if labels else 0.5
    parts = [features(texts[at : at + PIECE]) for at in range(0, len(texts), PIECE)]
    x, counts = (np.concatenate(values) for values in zip(*parts, strict=True))
    ends = np.cumsum(counts)
    model, rng = AttentionPool(x.mean(axis=0), x.std(axis=0) + 0.05, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(w) for k, w in model.weights.items()}
    v = {k: np.zeros_like(w) for k, w in model.weights.items()}
    for step in range(1, STEPS + 1):
        chosen = rng.choice(len(y), min(BATCH, len(y)), replace=False)
        rows = np.concatenate([np.arange(ends[i] - counts[i], ends[i]) for i in chosen])
        rate = RATE * min(1.0, 3 * (1 - step / (STEPS + 1)))
        for k, g in model.gradient(x[rows], counts[chosen], y[chosen]).items():
            g = g + DECAY * model.weights[k]
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g**2 - v[k])
            model.weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)
    return model


def train(df: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_label: int = PER_LABEL, seed: int = 0) -> AttentionPool | float:
    """Fit on at most ``per_label`` documents of each label outside the held-out fold."""
    known = labels.filter(F.col(label).isNotNull() & (fold(key, FOLDS) != HELD)).groupBy(key).agg(F.max(label).alias(label))
    keys = sample_keys(known, key, label, per_label, seed)
    drawn = df.select(F.col(key), F.col(text).cast("string").alias("_text")).join(F.broadcast(keys), key)  # per_label rows a label
    rows = drawn.groupBy(key, label).agg(F.min("_text").alias("t")).collect()
    rows.sort(key=lambda r: r[0])
    return fit([r["t"] for r in rows], [int(r[label]) for r in rows], seed)


def score(model: AttentionPool | float, texts: list[str | None]) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(texts), model)
    out = [np.zeros(0)]
    for at in range(0, len(texts), PIECE):
        out.append(model.forward(*features(texts[at : at + PIECE]))["score"])
    return np.concatenate(out).astype(float).clip(0, 1)


def classify(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, held_out, score, predicted) of every row of ``df``."""
    sent = df.sparkSession.sparkContext.broadcast(train(df, labels, key, text, label))  # some thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = score(sent.value, [t for (t,) in rows_of(batch, "_text")])
            columns = [batch.column(0), batch.column(1), pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "held_out", "score"])

    held = F.coalesce(fold(key, FOLDS) == HELD, F.lit(False)).alias("held_out")
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key), held, F.col(text).cast("string").alias("_text"))
    scored = rows.mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
