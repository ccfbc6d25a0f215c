"""Text quality by a factorisation machine.

Inputs are hashed words, structure statistics of the text and its stored length; the machine
adds to a linear model all pairwise interactions through low-rank factors, scored in linear
time by the sum-of-squares identity. Training runs in numpy on a bounded sample of labelled
rows, whose inputs are made inside Spark's tasks; scoring covers every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txspark.llm.common import bounded_sample

CACHE_ENTRIES = 400_000
CALIBRATION = 5
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COUNTED = [_UPPER, b"0123456789", b"#*$%&|<>", b".,;:", b"!?", b"|", b"@=/\\_", bytes(range(128, 256))]
STATISTICS = len(_COUNTED) + 8


@dataclass(frozen=True)
class Shape:
    """buckets for hashed words, factors per input, and the bound on training rows."""

    buckets: int = 8192
    factors: int = 8
    max_rows: int = 4000
    epochs: int = 8
    batch: int = 64
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 11


@dataclass
class Machine:
    shape: Shape
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    # a logistic curve over the machine's log odds, fitted on rows it was not trained on
    slope: float = 1.0
    offset: float = 0.0

    def log_odds(self, index: np.ndarray, value: np.ndarray) -> float:
        projected = value @ self.factors[index]
        squares = (value**2) @ (self.factors[index] ** 2)
        return float(self.bias + value @ self.linear[index] + 0.5 * float((projected**2 - squares).sum()))

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        """Probability of label 1 for one sparse row."""
        z = self.slope * self.log_odds(index, value) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class _Buckets(dict):
    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: bytes) -> int:
        b = xxhash.xxh3_64_intdigest(word) % self.size
        if len(self) < CACHE_ENTRIES:
            self[word] = b
        return b


_buckets: dict[int, _Buckets] = {}


def inputs(text: str | None, stored_length: float | None, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Sparse inputs of a whole text: word buckets first, statistics behind them.

    A null text is empty; an unknown stored length counts as none.
    """
    data = (text or "").encode("utf-8", "replace")
    words = data.lower().split()
    bucket = _buckets.setdefault(shape.buckets, _Buckets(shape.buckets))
    found = np.fromiter(map(bucket.__getitem__, words), np.int64, len(words))
    index, count = np.unique(found, return_counts=True)
    value = np.log1p(count)
    value /= max(np.linalg.norm(value), 1e-9)
    size = max(len(data), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    known = stored_length is not None and stored_length == stored_length
    stats = [(len(data) - len(data.translate(None, c))) / size for c in _COUNTED]
    stats += [
        np.log1p(len(words)) / 10,
        len(set(words)) / max(len(words), 1),
        sum(map(len, words)) / max(len(words), 1) / 10,
        1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(len(lines)) / 10,
        float(not words),
        np.log1p(max(float(stored_length), 0.0)) / 12 if known else 0.0,
        float(not known),
    ]
    return (
        np.concatenate([index, shape.buckets + np.arange(STATISTICS)]),
        np.concatenate([value, np.array(stats)]),
    )


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, shape: Shape) -> Machine:
    """Minimise the logistic loss by Adagrad over small batches."""
    rng = np.random.default_rng(shape.seed)
    size = shape.buckets + STATISTICS
    share = float(np.clip(labels.mean(), 0.02, 0.98))
    machine = Machine(shape, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.05, (size, shape.factors)))
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, shape.factors), 1e-6), 1e-6
    for _ in range(shape.epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), shape.batch):
            grad_w, grad_v, grad_b = np.zeros(size), np.zeros((size, shape.factors)), 0.0
            picked = order[at : at + shape.batch]
            for r in picked:
                index, value = rows[r]
                error = (machine.score(index, value) - labels[r]) / len(picked)
                v = machine.factors[index]
                grad_b += error
                grad_w[index] += error * value
                grad_v[index] += error * (value[:, None] * (value @ v) - v * (value**2)[:, None])
            used = np.flatnonzero(grad_w)
            gw = grad_w[used] + shape.decay * machine.linear[used]
            gv = grad_v[used] + shape.decay * machine.factors[used]
            seen_w[used] += gw**2
            seen_v[used] += gv**2
            seen_b += grad_b**2
            machine.linear[used] -= shape.rate * gw / np.sqrt(seen_w[used])
            machine.factors[used] -= shape.rate * gv / np.sqrt(seen_v[used])
            machine.bias -= shape.rate * grad_b / np.sqrt(seen_b)
    return machine


def calibrate(machine: Machine, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
    """Fit slope and offset to rows that the machine has not seen, by Newton steps. Targets are
    drawn in a little, so that separable rows have a finite slope; rows of one label change
    nothing."""
    positive, negative = labels.sum(), (1 - labels).sum()
    if not positive or not negative:
        return
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.column_stack([[machine.log_odds(*r) for r in rows], np.ones(len(rows))])
    scale = max(float(np.abs(x[:, 0]).max()), 1e-9)
    x[:, 0] /= scale
    ridge = np.diag([1e-3, 1e-6])
    b = np.array([scale, 0.0])

    def loss(at: np.ndarray) -> float:
        z = np.clip(x @ at, -500, 500)
        return float((np.logaddexp(0, z) - target * z).sum() + at @ ridge @ at / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - target) + ridge @ b)
        size = 1.0
        while size > 1e-6 and loss(b - size * step) > loss(b):
            size /= 2
        if size <= 1e-6:
            break
        b = b - size * step
    if b[0] > 0:  # a machine whose order is no better than chance is left as it is
        machine.slope, machine.offset = float(b[0] / scale), float(b[1])


def train(docs: DataFrame, labels: DataFrame, text: str, length: str, key: str, label: str, shape: Shape = Shape()) -> Machine:
    """Fit on at most shape.max_rows of the labelled rows; the sample, not the table, is sent
    to the documents. Every fifth of them only calibrates the scores. Without any labelled rows
    every score is one half."""
    wanted = labels.where(F.col(label).isin(0, 1)).select(
        F.xxhash64(F.col(key)).alias("h"), F.col(key).alias("id"), F.col(label).cast("double").alias("y")
    )
    # bounded by max_rows
    sample = docs.select(F.col(key).alias("id"), F.col(text).alias("t"), F.col(length).cast("double").alias("n")).join(
        F.broadcast(bounded_sample(wanted, "h", shape.max_rows)), "id"
    )

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [inputs(t, n, shape) for t, n in zip(batch["t"], batch["n"], strict=True)]
            yield pd.DataFrame({"h": batch["h"], "y": batch["y"], "i": [r[0] for r in rows], "v": [r[1] for r in rows]})

    found = (
        sample.mapInPandas(made, "h long, y double, i array<int>, v array<float>")
        .orderBy("h", "y", "i")
        .limit(shape.max_rows)
        .collect()
    )
    if not found:
        size = shape.buckets + STATISTICS
        return Machine(shape, 0.0, np.zeros(size), np.zeros((size, shape.factors)))
    rows = [(np.array(r["i"], np.int64), np.array(r["v"], np.float64)) for r in found]
    y = np.array([r["y"] for r in found])
    apart = np.arange(len(rows)) % CALIBRATION == CALIBRATION - 1
    if not (~apart).any():
        return fit(rows, y, shape)
    machine = fit([r for r, a in zip(rows, apart, strict=True) if not a], y[~apart], shape)
    calibrate(machine, [r for r, a in zip(rows, apart, strict=True) if a], y[apart])
    return machine


def score(machine: Machine, text: Column, length: Column) -> Column:
    """Probability of label 1 for every whole text; null and empty texts have one too."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lengths in batches:
            yield pd.Series([machine.score(*inputs(t, n, machine.shape)) for t, n in zip(texts, lengths, strict=True)], dtype=float)

    return run(text, length.cast("double"))
