"""Language identification with a bidirectional gated recurrent network over bytes, written in numpy.

The UTF-8 bytes of a text are cut into blocks of ``SPAN`` bytes; every byte is in exactly one block. A
gated recurrent unit reads each block forwards, another backwards, and a linear layer on both states
gives a language distribution at every position. A document's probabilities are the mean over all its
positions. Training is backpropagation through time on blocks of a bounded sample: at most ``PER_LANG``
labelled documents per language (first by a seeded hash of the key) and ``BLOCKS`` evenly placed blocks
of each; nothing but text and language is read. Gates use x / (1 + |x|) in place of exponentials.

Defined results: a null text, or one without a letter, is ``und`` with score 0; a null language is never
learned from; with no labelled text at all every document is ``und``; repeated rows each keep a row; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskframe.llm.common import fold, fresh, has_letter, rows_of, sample_keys

SPAN, HIDDEN, PAD = 96, 8, 256
PER_LANG, BLOCKS, STEPS, BATCH, RATE = 300, 4, 160, 192, 0.02
FOLDS, HELD = 4, 2
UNKNOWN = "und"
CHUNK = 2048


def _blocks(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks (n, SPAN) of byte values padded with ``PAD``, their lengths and the text each belongs to."""
    counts = np.array([-(-len(r) // SPAN) for r in raw], dtype=np.int64)
    out = np.full((int(counts.sum()), SPAN), PAD, dtype=np.int16)
    lengths = np.zeros(len(out), np.int64)
    at = 0
    for r, n in zip(raw, counts.tolist(), strict=True):
        if n:
            out[at : at + n].reshape(-1)[: len(r)] = np.frombuffer(r, np.uint8)
            lengths[at : at + n] = SPAN
            lengths[at + n - 1] = len(r) - SPAN * (n - 1)
            at += n
    return out, lengths, np.repeat(np.arange(len(raw)), counts)


class Network:
    """Weights of both directions and of the output layer; forward pass, loss gradient, update."""

    def __init__(self, labels: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.labels = labels
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.weights = {}
        for side in "fb":
            self.weights |= {f"x{side}": draw(257, 3 * HIDDEN), f"u{side}": draw(HIDDEN, 3 * HIDDEN)}
        self.weights |= {"o": draw(2 * HIDDEN, len(labels)), "c": np.zeros(len(labels), np.float32)}

    def _run(self, x: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        """States (span, hidden, n) of one direction; a padded position leaves the state as it is."""
        table, u = np.ascontiguousarray(self.weights[f"x{side}"].T), self.weights[f"u{side}"].T
        columns = np.ascontiguousarray(x.T)
        out = np.empty((len(columns), HIDDEN, len(x)), table.dtype)
        real = None if (x != PAD).all() else (columns != PAD).astype(table.dtype)
        h = np.zeros((HIDDEN, len(x)), table.dtype)
        for t in range(len(columns)) if side == "f" else range(len(columns) - 1, -1, -1):
            given, from_h = table.take(columns[t], axis=1), u @ h
            gates = given[: 2 * HIDDEN] + from_h[: 2 * HIDDEN]
            size = np.abs(gates)
            size += 1
            gates /= size
            gates *= 0.5
            gates += 0.5
            z, r = gates[:HIDDEN], gates[HIDDEN:]
            new = r * from_h[2 * HIDDEN :]
            new += given[2 * HIDDEN :]
            size = np.abs(new)
            size += 1
            new /= size
            step = new - h
            step *= z
            if real is not None:
                step *= real[t]
            if keep is not None:
                keep.append((t, h, from_h, z, r, new))
            h = np.add(h, step, out=out[t])
        return out

    def _positions(self, states: dict[str, np.ndarray]) -> np.ndarray:
        """Language distribution at every position: (span, languages, n)."""
        o = self.weights["o"].T
        logits = o[:, :HIDDEN] @ states["f"] + o[:, HIDDEN:] @ states["b"] + self.weights["c"][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """For each block the sum of the language distributions at its positions: (n, languages)."""
        p = self._positions({side: self._run(x, side, None) for side in "fb"})
        if not (x != PAD).all():
            p *= (x != PAD).T[:, None, :]
        return p.sum(axis=0).T

    def gradient(self, x: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of all real positions and its gradient, by backpropagation through time."""
        kept: dict[str, list] = {"f": [], "b": []}
        states = {side: self._run(x, side, kept[side]) for side in "fb"}
        p = self._positions(states)
        real = (x != PAD).T
        total, rows = max(1, int(real.sum())), np.arange(len(x))
        loss = float(-(np.log(p[:, target, rows] + 1e-9) * real).sum() / total)
        p[:, target, rows] -= 1
        p *= real[:, None, :] / total
        grad = {"c": p.sum(axis=(0, 2)), "o": np.concatenate([np.einsum("thn,tln->hl", states[s], p) for s in "fb"])}
        for side, at in (("f", 0), ("b", HIDDEN)):
            grad |= self._through_time(x, side, kept[side], self.weights["o"][at : at + HIDDEN] @ p)
        return loss, grad

    def _through_time(self, x: np.ndarray, side: str, kept: list, outer: np.ndarray) -> dict[str, np.ndarray]:
        u = self.weights[f"u{side}"]
        gx, gu, dh = np.zeros_like(self.weights[f"x{side}"]), np.zeros_like(u), np.zeros_like(kept[0][1])
        for t, h, from_h, z, r, new in reversed(kept):
            dh = dh + outer[t]
            dstep = dh * (x[:, t] != PAD)
            dz, dn = dstep * (new - h), dstep * z * (1 - np.abs(new)) ** 2
            dr = dn * from_h[2 * HIDDEN :]
            dg = np.concatenate([dz * (1 - np.abs(2 * z - 1)) ** 2, dr * (1 - np.abs(2 * r - 1)) ** 2]) * 0.5
            np.add.at(gx, x[:, t], np.concatenate([dg, dn]).T)
            dfrom = np.concatenate([dg, dn * r])
            gu += h @ dfrom.T
            dh = dh - dstep * z + u @ dfrom
        return {f"x{side}": gx, f"u{side}": gu}


def fit(texts: list[str], langs: list[str], seed: int = 0) -> Network | None:
    """Train on blocks of the given texts; languages are drawn evenly."""
    labels = sorted(set(langs))
    if not labels:
        return None
    number = {lang: i for i, lang in enumerate(labels)}
    blocks, target = [], []
    for text, lang in zip(texts, langs, strict=True):
        x, lengths, _ = _blocks([text.encode("utf-8", "surrogatepass")])
        x = x[lengths >= min(16, SPAN)]
        chosen = x[np.unique(np.linspace(0, len(x) - 1, BLOCKS).astype(int))] if len(x) else x
        blocks.append(chosen)
        target += [number[lang]] * len(chosen)
    x, y = np.concatenate(blocks), np.array(target, np.int64)
    network, rng = Network(labels, seed), np.random.default_rng(seed)
    if not len(x):
        return None
    weight = 1.0 / np.bincount(y, minlength=len(labels)).clip(1)[y]
    m = {k: np.zeros_like(v) for k, v in network.weights.items()}
    v = {k: np.zeros_like(w) for k, w in network.weights.items()}
    for step in range(1, STEPS + 1):
        rows = rng.choice(len(x), BATCH, p=weight / weight.sum())
        _, grad = network.gradient(x[rows], y[rows])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
        rate = RATE * min(1.0, 4 * (1 - step / (STEPS + 1))) * min(1.0, 1.0 / max(norm, 1e-9))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g**2 - v[k])
            scale = np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6
            network.weights[k] -= (rate * m[k] / (1 - 0.9**step) / scale).astype(np.float32)
    return network


def train(df: DataFrame, key: str, text: str, lang: str, per_lang: int = PER_LANG, seed: int = 0) -> Network | None:
    """Fit on at most ``per_lang`` documents of each language of ``df``; the caller leaves out held-out rows."""
    known = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    keys = sample_keys(known, key, lang, per_lang, seed)
    drawn = known.join(F.broadcast(keys.distinct()), [key, lang], "left_semi")
    # Repeated rows of a key count once, so that at most per_lang texts a language come to the driver.
    drawn = drawn.groupBy(F.col(key).alias("k"), F.col(lang).alias("l")).agg(F.min(text).alias("t"))
    rows = drawn.collect()
    rows = sorted((r for r in rows if has_letter(r.t)), key=lambda r: (r.l, r.k, r.t))
    return fit([r.t for r in rows], [r.l for r in rows], seed)


def classify(network: Network | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and its pooled probability for each text."""
    raw = [t.encode("utf-8", "surrogatepass") if network and has_letter(t) else b"" for t in texts]
    if network is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    pooled = np.zeros((len(texts), len(network.labels)))
    at = 0
    while at < len(raw):
        until, size = at, 0
        while until < len(raw) and (until == at or size < 4 * CHUNK * SPAN):
            size += len(raw[until])
            until += 1
        x, lengths, owner = _blocks(raw[at:until])
        full = lengths == SPAN
        for part in (np.flatnonzero(full), np.flatnonzero(~full)):
            for piece in range(0, len(part), CHUNK):
                chosen = part[piece : piece + CHUNK]
                np.add.at(pooled, at + owner[chosen], network.pooled(x[chosen]))
        at = until
    best = pooled.argmax(axis=1)
    total = pooled.sum(axis=1)
    score = pooled[np.arange(len(best)), best] / np.maximum(total, 1e-9)
    return [network.labels[b] if t else UNKNOWN for b, t in zip(best, total, strict=True)], score.clip(0, 1).tolist()


def predict(df: DataFrame, network: Network | None, text: str, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``df`` with the predicted language and its score, from the whole text of every row."""
    sent = df.sparkSession.sparkContext.broadcast(network)  # some thousand weights
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = classify(sent.value, [t for (t,) in rows_of(batch, batch.schema.names[place])])
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    added = [StructField(names[0], StringType()), StructField(names[1], DoubleType())]
    return df.mapInArrow(run, StructType([*df.schema.fields, *added]))


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score) of every row, learned from the rows outside the held-out fold."""
    held = F.coalesce(fold(key, FOLDS) == HELD, F.lit(False))
    network = train(df.filter(~held), key, text, lang)
    scored = predict(df.select(F.col(key), held.alias("held_out"), F.col(text).alias("_text")), network, "_text")
    return scored.select(key, "held_out", "lang_pred", "score")


def keep_known(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.3) -> DataFrame:
    """The documents with a recognised language: not ``und``, pooled probability of at least ``least``."""
    network = train(df.filter(F.coalesce(fold(key, FOLDS) != HELD, F.lit(False))), key, text, lang)
    names = (fresh(df, "lang_pred"), fresh(df, "lang_score"))
    scored = predict(df, network, text, names)
    good = (F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)
    return scored.filter(good).select(*df.columns)
