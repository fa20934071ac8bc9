"""A byte-level convolutional network that tells good texts from bad ones, in numpy.

Bytes become short vectors: a learned one for each byte value, and one number that says whether the four bytes from
here on stood within the last few dozen bytes already. Learned filters run over them, are averaged over overlapping
chunks that cover the whole text, pass one more layer, and are pooled by maximum and mean into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.shared import held_out, labelled_sample
from docloom.llm.words import small_batches

# Rows of each class that are learned from, at most, and the longest text among them, in characters.
PER_CLASS, LONGEST = 1000, 12_000
# Channels of a byte (the last one is the repeat), bytes of a step and half a filter, bytes of half a chunk, filters,
# units of the chunk layer, and how far back a repeat is looked for.
CHANNELS, STEP, HALF, FILTERS, UNITS, BACK = 8, 4, 64, 16, 16, 32
EPOCHS, BATCH, RATE, DECAY = 7, 32, 0.006, 1e-4
# Bytes that go through the network at once.
BYTES = 1 << 18


class Batch:
    """Texts side by side, each in whole half-chunks with at least ``BACK`` empty bytes before the next one."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        room = (sizes + BACK + HALF - 1) // HALF * HALF
        starts = np.cumsum(room) - room + HALF
        total = int(room.sum()) + HALF
        raw = np.zeros(total + 3, dtype=np.uint8)
        filled = np.zeros(total, dtype=bool)
        for text, start, size in zip(texts, starts.tolist(), sizes.tolist()):
            raw[start : start + size] = np.frombuffer(text, dtype=np.uint8)
            filled[start : start + size] = True
        four = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, 4)).view("<u4").ravel()
        again = np.zeros(total, dtype=bool)
        for back in range(3, BACK):
            again[back:] |= four[back:] == four[:-back]
        again &= filled
        self.bytes = np.where(filled, raw[:total], 256).astype(np.int64)
        self.again = again
        self.live = filled[::STEP]
        counts = self.live.reshape(-1, HALF // STEP).sum(axis=1)
        per_text = np.maximum(1, (sizes + HALF - 1) // HALF)
        # The half-chunks of each text, the first of each text, and the two that make each chunk.
        self.halves = np.repeat(starts // HALF - (np.cumsum(per_text) - per_text), per_text) + np.arange(per_text.sum())
        self.first = np.cumsum(per_text) - per_text
        self.per_text = per_text
        self.text = np.repeat(np.arange(len(texts)), per_text)
        here = np.arange(len(self.halves))
        last = np.zeros(len(here), dtype=bool)
        last[self.first + per_text - 1] = True
        alone = np.repeat(per_text == 1, per_text)
        self.left = here - (last & ~alone)
        self.right = here + ~last
        held = counts[self.halves]
        self.weight = 1.0 / np.maximum(1, held[self.left] + held[self.right]).astype(np.float32)
        # Steps whose second half would reach into the next text see nothing there: that text begins after empty bytes.


class Network:
    """The parameters, scores and gradients."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        table = normal(257, CHANNELS - 1, by=0.5)
        table[256] = 0
        wide = STEP * CHANNELS
        self.p = {
            "table": table, "near": normal(wide, FILTERS, by=(2 / wide) ** 0.5), "far": normal(wide, FILTERS, by=(2 / wide) ** 0.5),
            "bias": np.zeros(FILTERS, np.float32), "chunk": normal(FILTERS, UNITS, by=(2 / FILTERS) ** 0.5),
            "chunk_bias": np.zeros(UNITS, np.float32), "out": normal(2 * UNITS, by=0.2), "out_bias": np.zeros(1, np.float32),
        }

    def forward(self, batch: Batch) -> dict:
        p = self.p
        x = np.empty((len(batch.bytes), CHANNELS), dtype=np.float32)
        x[:, :-1] = p["table"][batch.bytes]
        x[:, -1] = batch.again
        x = x.reshape(-1, STEP * CHANNELS)
        z = x @ p["near"] + p["bias"]
        z[:-1] += x[1:] @ p["far"]
        r = np.maximum(z, 0)
        r *= batch.live[:, None]
        h = r.reshape(-1, HALF // STEP, FILTERS).sum(axis=1)[batch.halves]
        c = (h[batch.left] + h[batch.right]) * batch.weight[:, None]
        d = np.maximum(c @ p["chunk"] + p["chunk_bias"], 0)
        top = np.maximum.reduceat(d, batch.first)
        mean = np.add.reduceat(d, batch.first) / batch.per_text[:, None].astype(np.float32)
        pooled = np.concatenate([top, mean], axis=1)
        logit = np.clip(pooled @ p["out"] + p["out_bias"], -30, 30)
        return {"x": x, "r": r, "c": c, "d": d, "top": top, "pooled": pooled, "score": 1 / (1 + np.exp(-logit))}

    def gradients(self, batch: Batch, wanted: np.ndarray) -> dict:
        p, f = self.p, self.forward(batch)
        slope = ((f["score"] - wanted) / len(wanted)).astype(np.float32)
        g = {"out": f["pooled"].T @ slope, "out_bias": slope.sum(keepdims=True)}
        pooled = slope[:, None] * p["out"]
        best = f["d"] == f["top"][batch.text]
        ties = np.add.reduceat(best.astype(np.float32), batch.first)
        d = best * (pooled[:, :UNITS] / ties)[batch.text]
        d += (pooled[:, UNITS:] / batch.per_text[:, None].astype(np.float32))[batch.text]
        d *= f["d"] > 0
        g["chunk"], g["chunk_bias"] = f["c"].T @ d, d.sum(axis=0)
        c = (d @ p["chunk"].T) * batch.weight[:, None]
        h = np.zeros((len(batch.bytes) // HALF, FILTERS), dtype=np.float32)
        np.add.at(h, batch.halves[batch.left], c)
        np.add.at(h, batch.halves[batch.right], c)
        z = np.repeat(h, HALF // STEP, axis=0) * (f["r"] > 0)
        g["near"], g["far"], g["bias"] = f["x"].T @ z, f["x"][1:].T @ z[:-1], z.sum(axis=0)
        x = z @ p["near"].T
        x[1:] += z[:-1] @ p["far"].T
        x = x.reshape(-1, CHANNELS)
        g["table"] = np.stack([np.bincount(batch.bytes, x[:, i], 257) for i in range(CHANNELS - 1)], axis=1).astype(np.float32)
        g["table"][256] = 0
        return g

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of label 1. Texts go through together up to a bounded number of bytes; a longer one alone."""
        found, group, size = [], [], 0
        for text in texts:
            if group and size + len(text) > BYTES:
                found.append(self.forward(Batch(group))["score"])
                group, size = [], 0
            group.append(text)
            size += len(text)
        if group:
            found.append(self.forward(Batch(group))["score"])
        return np.concatenate(found).astype(np.float64) if found else np.zeros(0)


def train(texts: list[str], labels: list[int], seed: int = 5) -> Network | float:
    """A network, or one score for all texts where only one class is known (1 where none is)."""
    if len(set(labels)) < 2:
        return float(labels[0]) if labels else 1.0
    data, wanted = [t.encode() for t in texts], np.array(labels, dtype=np.float32)
    # The rarer class is repeated until both weigh the same.
    groups = [np.flatnonzero(wanted == value) for value in (0, 1)]
    most = max(map(len, groups))
    rng, net = np.random.default_rng(seed), Network(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step, steps = 0, EPOCHS * max(1, 2 * most // BATCH)
    while step < steps:
        order = rng.permutation(np.concatenate([np.resize(rng.permutation(g), most) for g in groups]))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            grads = net.gradients(Batch([data[i] for i in some]), wanted[some])
            step += 1
            rate = RATE * (1 - 0.9 * min(1.0, step / steps))
            for k, grad in grads.items():
                grad = grad + DECAY * net.p[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                net.p[k] = net.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
            net.p["table"][256] = 0
    return net


def train_quality(documents: DataFrame, labels: DataFrame, label: str = "quality") -> Network | float:
    """Learned from at most ``PER_CLASS`` labelled rows of each class that are not held out."""
    return train(*labelled_sample(documents, labels, label, {0: PER_CLASS, 1: PER_CLASS}, LONGEST))


def score_quality(documents: DataFrame, model: Network | float, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns and ``score_col``, the probability that a text is good. The whole text is read, however long.

    Null counts as the empty text, which gets a score like any other. Rows are scored one by one: repeated rows get
    the same score, other columns are never looked at. There is no shuffle.
    """
    names = documents.columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for batch in small_batches(batches):
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            scores = np.full(len(texts), model) if isinstance(model, float) else np.round(model.score(texts), 6)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(scored, f"{fields}, `{score_col}` double")


def scored_rows(scored: DataFrame, threshold: float, id_col: str = "doc_id") -> DataFrame:
    return scored.select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
    )
