"""Language identification by a byte convolutional network.

Bytes are embedded; filters of several widths slide over fixed-length windows, each filter
keeps its strongest response in the window (max pooling), and a softmax layer turns these
into language probabilities. Training runs in numpy on a bounded sample of labelled rows;
prediction covers every window of every text, in batches inside Spark's tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txspark.llm.common import bounded_sample

UNDETERMINED = "und"
_ASCII_LETTER = re.compile("[A-Za-z]")


@dataclass(frozen=True)
class Shape:
    """Size of the network and of its training.

    max_rows bounds the labelled rows used for training (chosen by id hash),
    windows_per_row the text windows taken from each.
    """

    window: int = 256
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    max_rows: int = 4000
    windows_per_row: int = 3
    epochs: int = 4
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    """Weights; `languages` names the outputs."""

    languages: list[str]
    shape: Shape
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def features(self, windows: np.ndarray) -> tuple[np.ndarray, dict]:
        """Pooled responses of all filters for rows of window bytes."""
        x = self.weights["embed"][windows]
        pooled, kept = [], {}
        rows, _, depth = x.shape
        for w in self.shape.widths:
            n = x.shape[1] - w + 1
            patches = np.concatenate([x[:, k : k + n] for k in range(w)], axis=2)
            out = (patches.reshape(-1, w * depth) @ self.weights[f"conv{w}"]).reshape(rows, n, -1)
            kept[w] = out
            pooled.append(out.max(axis=1))
        hidden = np.concatenate(pooled, axis=1) + self.weights["bias"]
        return np.maximum(hidden, 0), kept

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return self.features(windows)[0] @ self.weights["dense"] + self.weights["out"]


def cut_windows(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as zero-padded windows, with each window's text and filled length."""
    counts = np.array([-(-len(t) // window) for t in texts], dtype=np.int64)
    grid = np.zeros((int(counts.sum()), window), dtype=np.uint8)
    flat, at = grid.reshape(-1), 0
    filled = np.full(len(grid), window, dtype=np.int64)
    first = np.cumsum(counts) - counts
    for text, start, count in zip(texts, first, counts, strict=True):
        if count:
            at = start * window
            flat[at : at + len(text)] = np.frombuffer(text, dtype=np.uint8)
            filled[start + count - 1] = len(text) - (count - 1) * window
    return grid, np.repeat(np.arange(len(texts)), counts), filled


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], shape: Shape) -> Network:
    """Train by Adam on window bytes (rows x window) and language numbers."""
    rng = np.random.default_rng(shape.seed)
    wide = shape.filters * len(shape.widths)
    params = {"embed": rng.normal(0, 0.5, (256, shape.embedding))}
    for w in shape.widths:
        size = w * shape.embedding
        params[f"conv{w}"] = rng.normal(0, size**-0.5, (size, shape.filters))
    params |= {
        "bias": np.zeros(wide),
        "dense": rng.normal(0, wide**-0.5, (wide, len(languages))),
        "out": np.zeros(len(languages)),
    }
    net = Network(languages, shape, {k: v.astype(np.float32) for k, v in params.items()})
    counts = np.bincount(labels, minlength=len(languages))
    balance = len(labels) / np.maximum(counts, 1) / len(languages)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    step = 0
    for _ in range(shape.epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), shape.batch):
            pick = order[at : at + shape.batch]
            grads = _gradients(net, windows[pick], labels[pick], balance[labels[pick]])
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                mean, spread = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                net.weights[k] -= shape.rate * mean / (np.sqrt(spread) + 1e-8)
    return net


def _gradients(net: Network, windows, labels, weight) -> dict[str, np.ndarray]:
    """Gradients of the weighted cross entropy; pooling passes them to the strongest place."""
    shape, w8 = net.shape, net.weights
    hidden, kept = net.features(windows)
    delta = softmax(hidden @ w8["dense"] + w8["out"])
    delta[np.arange(len(labels)), labels] -= 1
    delta *= (weight / len(labels))[:, None]
    delta = delta.astype(np.float32)
    back = (delta @ w8["dense"].T) * (hidden > 0)
    grads = {"dense": hidden.T @ delta, "out": delta.sum(0), "bias": back.sum(0)}
    grads["embed"] = np.zeros_like(w8["embed"])
    rows = np.arange(len(windows))[:, None]
    for i, w in enumerate(shape.widths):
        part = back[:, i * shape.filters : (i + 1) * shape.filters]
        best = kept[w].argmax(axis=1)
        # the bytes under each filter's strongest place: rows x filters x width
        under = windows[rows[:, :, None], best[:, :, None] + np.arange(w)]
        patch = w8["embed"][under].reshape(len(windows), shape.filters, -1)
        grads[f"conv{w}"] = np.einsum("bf,bfd->df", part, patch)
        to_patch = np.einsum("bf,df->bfd", part, w8[f"conv{w}"])
        np.add.at(
            grads["embed"], under.reshape(-1), to_patch.reshape(-1, shape.embedding)
        )
    return grads


def train(docs: DataFrame, text: str, label: str, key: str, shape: Shape = Shape()) -> Network | None:
    """Fit on at most shape.max_rows rows with text and label; None where there are none.

    Each row gives windows_per_row windows, evenly spread over the whole text.
    """
    body, length = F.col(text), F.length(F.col(text))
    spots = [
        F.substring(
            body,
            (F.greatest(length - shape.window, F.lit(0)) * (i / max(shape.windows_per_row - 1, 1))).cast("int") + 1,
            F.lit(shape.window),
        )
        for i in range(shape.windows_per_row)
    ]
    rows = docs.where(body.rlike(r"\p{L}") & F.col(label).isNotNull()).select(
        F.xxhash64(F.col(key).cast("string")).alias("h"),
        F.col(label).alias("label"),
        F.array_distinct(F.array(*spots)).alias("spots"),
    )
    sample = bounded_sample(rows, "h", shape.max_rows).collect()
    if not sample:
        return None
    languages = sorted({r["label"] for r in sample})
    number = {x: i for i, x in enumerate(languages)}
    raw, labels = [], []
    for row in sample:
        for spot in row["spots"]:
            raw.append(spot.encode()[: shape.window])
            labels.append(number[row["label"]])
    kept = [i for i, r in enumerate(raw) if r]
    grid, _, _ = cut_windows([raw[i] for i in kept], shape.window)
    return fit(grid, np.array(labels)[kept], languages, shape)


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def predict_texts(net: Network, texts: list[str | None], chunk: int = 128) -> tuple[list[str], np.ndarray]:
    """Language and its probability for each text: window probabilities averaged by length."""
    known = [t is not None and has_letter(t) for t in texts]
    grid, owner, filled = cut_windows(
        [t.encode("utf-8", "replace") if k else b"" for t, k in zip(texts, known, strict=True)],
        net.shape.window,
    )
    total = np.zeros((len(texts), len(net.languages)))
    for at in range(0, len(grid), chunk):
        part = softmax(net.logits(grid[at : at + chunk]))
        np.add.at(total, owner[at : at + chunk], part * filled[at : at + chunk, None])
    mass = total.sum(axis=1)
    share = total / np.where(mass > 0, mass, 1)[:, None]
    best = share.argmax(axis=1)
    names = [net.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
    return names, np.where(known, share.max(axis=1), 0.0).clip(0, 1)


def predict(net: Network | None, text: Column, rows_at_once: int = 64) -> Column:
    """A column of struct(lang, score) for every whole text.

    Null texts and texts without a letter are `und` with score 0; so is every text when
    there was nothing to learn from. Memory: rows_at_once texts and their windows.
    """
    kind = "struct<lang: string, score: double>"
    if net is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score")).cast(kind)
    shared = net

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.astype(object).where(batch.notna(), None).tolist()
            names, scores = [], []
            for at in range(0, len(texts), rows_at_once):
                n, s = predict_texts(shared, texts[at : at + rows_at_once])
                names += n
                scores.append(s)
            yield pd.DataFrame({"lang": names, "score": np.concatenate(scores) if scores else []})

    return run(text)
