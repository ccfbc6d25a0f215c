"""Small decision trees, grown in numpy on bounded samples and scored as Spark SQL."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """Rows with the feature at or below the threshold go left."""

    feature: int
    threshold: float
    left: Split | Leaf
    right: Split | Leaf


Tree = Split | Leaf


def grow(
    x: np.ndarray,
    gradient: np.ndarray,
    weight: np.ndarray,
    depth: int,
    least: float,
    tried: int | None = None,
    rng: np.random.Generator | None = None,
) -> Tree:
    """A tree whose leaves hold sum(gradient) / sum(weight), split where this gains most.

    tried: features looked at per node, drawn by rng (None: all).
    """
    total, mass = gradient.sum(), weight.sum()
    leaf = Leaf(float(total / (mass + 1e-9)))
    if depth == 0 or len(x) < 2:
        return leaf
    features = np.arange(x.shape[1])
    if tried is not None and rng is not None:
        features = np.sort(rng.choice(features, min(tried, len(features)), replace=False))
    best = (1e-7, -1, 0.0)
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        value = x[order, f]
        g, w = np.cumsum(gradient[order])[:-1], np.cumsum(weight[order])[:-1]
        fine = (value[1:] > value[:-1]) & (w >= least) & (mass - w >= least)
        if not fine.any():
            continue
        gain = g**2 / (w + 1e-9) + (total - g) ** 2 / (mass - w + 1e-9) - total**2 / (mass + 1e-9)
        at = int(np.argmax(np.where(fine, gain, -np.inf)))
        if gain[at] > best[0]:
            best = (float(gain[at]), int(f), float((value[at] + value[at + 1]) / 2))
    if best[1] < 0:
        return leaf
    _, f, threshold = best
    low = x[:, f] <= threshold
    part = lambda m: grow(x[m], gradient[m], weight[m], depth - 1, least, tried, rng)
    return Split(f, threshold, part(low), part(~low))


def predict(tree: Tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, Leaf):
        return np.full(len(x), tree.value)
    low = x[:, tree.feature] <= tree.threshold
    out = np.empty(len(x))
    out[low], out[~low] = predict(tree.left, x[low]), predict(tree.right, x[~low])
    return out


def to_sql(tree: Tree, names: list[str]) -> str:
    """The tree as a CASE expression over SQL operands for the features."""
    if isinstance(tree, Leaf):
        return f"{tree.value!r}D"
    low, high = to_sql(tree.left, names), to_sql(tree.right, names)
    if low == high:
        return low
    return f"CASE WHEN {names[tree.feature]} <= {tree.threshold!r}D THEN {low} ELSE {high} END"


def boost(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, rate: float) -> tuple[float, list[Tree]]:
    """Gradient boosting of the logistic loss: a base score and trees to add, in log odds."""
    share = float(np.clip(y.mean(), 0.01, 0.99))
    base = float(np.log(share / (1 - share)))
    score, trees = np.full(len(y), base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _scaled(grow(x, y - p, np.maximum(p * (1 - p), 1e-6), depth, 0.5), rate)
        trees.append(tree)
        score += predict(tree, x)
    return base, trees


def _scaled(tree: Tree, rate: float) -> Tree:
    if isinstance(tree, Leaf):
        return Leaf(float(np.clip(tree.value, -4, 4)) * rate)
    return Split(tree.feature, tree.threshold, _scaled(tree.left, rate), _scaled(tree.right, rate))


def forest(x: np.ndarray, y: np.ndarray, count: int, depth: int, seed: int) -> list[Tree]:
    """Random forest: each tree on a bootstrap sample with as many rows of either label, some
    features tried at each node. Both labels, 0 and 1, must occur."""
    rng = np.random.default_rng(seed)
    tried = max(1, round(x.shape[1] ** 0.5))
    out = []
    for _ in range(count):
        half = max(1, len(y) // 2)
        rows = np.concatenate([rng.choice(np.flatnonzero(y == v), half) for v in (0, 1)])
        out.append(grow(x[rows], y[rows], np.ones(len(rows)), depth, 2.0, tried, rng))
    return out
