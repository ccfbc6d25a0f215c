"""Vectors linked by cosine: cover trees and their dual traversal, exact for any threshold.

Vectors go to cells around pivots, cells are cut into blocks of bounded size, and each block
grows a cover tree: nested levels whose radii halve, every node inside its parent's ball. A
tree is traversed against itself, and a pair of nodes is dropped as soon as the distance of
their centres exceeds the threshold distance and both covering radii. Between blocks the
same bound first drops pairs of cells, then pairs of leaves, and only the vectors of the
leaf pairs that are left meet.

Equal vectors are one node with a weight, so copies cost nothing. Distances are Euclidean
between unit vectors, in double precision. Vectors far from all others cannot be pruned in
many dimensions: leaf centres of all cells within reach are then compared, block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.llm.common import stored
from txspark.llm.components import components

SLACK = 1e-6  # of a distance, for rounding; found pairs are tested by their cosine
RADII = (1.0, 0.5, 0.25, 0.125)
LEAVES_PER_BLOCK = 4096
ROWS_PER_BIN = 20_000


@dataclass(frozen=True)
class Shape:
    """cell: vectors per pivot; pivots: their bound; block: most vectors of a tree."""

    cell: int = 4096
    pivots: int = 4096
    block: int = 6000


@dataclass
class Tree:
    """Nodes by number, parents first: centre (a row of x), covering radius, children,
    and the rows of x below it where it is a leaf."""

    centre: list[int]
    radius: list[float]
    children: list[list[int]]
    rows: list[np.ndarray | None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def build(x: np.ndarray) -> Tree:
    """A cover tree over unit vectors."""
    tree = Tree([0], [float(distances(x, x[:1]).max())], [[]], [None])
    level = [(0, np.arange(len(x)))]
    for radius in RADII:
        below = []
        for node, rows in level:
            for centre, members, reach in _cover(x, tree.centre[node], rows, radius):
                child = len(tree.centre)
                tree.centre.append(centre)
                tree.radius.append(reach)
                tree.children.append([])
                tree.rows.append(members if radius == RADII[-1] else None)
                tree.children[node].append(child)
                below.append((child, members))
        level = below
    return tree


def _cover(x: np.ndarray, first: int, rows: np.ndarray, radius: float):
    """Balls of the radius over the rows, the first around the parent's centre, each further
    one around the row farthest from all centres so far."""
    if len(rows) == 1:
        yield first, rows, 0.0
        return
    centres, own = [first], x[rows]
    near = distances(own, x[[first]])[:, 0]
    owner = np.zeros(len(rows), np.int64)
    while near.max() > radius:
        far = int(near.argmax())
        d = distances(own, own[[far]])[:, 0]
        closer = d < near
        owner[closer], near[closer] = len(centres), d[closer]
        owner[far], near[far] = len(centres), 0.0
        centres.append(int(rows[far]))
    order = np.argsort(owner, kind="stable")
    ends = np.searchsorted(owner[order], np.arange(len(centres) + 1))
    for i, c in enumerate(centres):
        mine = order[ends[i] : ends[i + 1]]
        if len(mine):
            yield c, rows[mine], float(near[mine].max())


def leaf_pairs(tree: Tree, x: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Pairs of leaves (a node with itself too) that may hold a pair within reach."""
    centre, radius = x[tree.centre], np.array(tree.radius)
    first = np.array([c[0] if c else 0 for c in tree.children])
    count = np.array([len(c) for c in tree.children])
    level = {0: np.array([0])}  # each node's partners, itself and later ones
    while any(tree.rows[p] is None for p in level):  # all leaves lie on one level
        below: dict[int, np.ndarray] = {}
        for p, partners in level.items():
            left = np.array(tree.children[p])
            n = count[partners]  # children are numbered in a row
            right = np.repeat(first[partners] - np.cumsum(n) + n, n) + np.arange(n.sum())
            for i, j in near_pairs(centre[left], radius[left], centre[right], radius[right], reach):
                one, other = left[i], right[j]
                one, other = one[one <= other], other[one <= other]
                if len(one):
                    ends = np.flatnonzero(np.diff(one, append=-1)) + 1
                    below.update(zip(one[ends - 1].tolist(), np.split(other, ends[:-1]), strict=True))
        level = below
    return [(p, q) for p, partners in level.items() for q in partners.tolist()]


def near_pairs(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray, reach: float, chunk: int = 512):
    """Numbers of the balls of either side that may hold a pair within reach, a chunk of the
    left side at a time."""
    for at in range(0, len(a), chunk):
        d = distances(a[at : at + chunk], b)
        i, j = np.nonzero(d <= ra[at : at + chunk, None] + rb[None, :] + (reach + SLACK))
        yield i + at, j


class Links:
    """Link weights and components of rows, gathered from pairs of row sets."""

    def __init__(self, x: np.ndarray, weight: np.ndarray, threshold: float):
        self.x, self.weight, self.threshold = x, weight, threshold
        self.count = np.zeros(len(x), np.int64)
        self.parent = list(range(len(x)))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)

    def add(self, rows: np.ndarray, others: np.ndarray, chunk: int = 1024) -> None:
        """Link every row to every other one that is near; the sets are equal or disjoint."""
        same = rows is others
        if same and len(rows) == 1:
            return
        for at in range(0, len(rows), chunk):
            part = rows[at : at + chunk]
            near = self.x[part] @ self.x[others].T >= self.threshold
            if same:
                near[np.arange(len(part)), at + np.arange(len(part))] = False
            self.count[part] += near @ self.weight[others]
            if not same:
                self.count[others] += near.T @ self.weight[part]
            # rows and others that hang together, by spreading the smallest number
            mark = np.arange(len(part)) + len(others)
            far = np.arange(len(others))
            while True:
                low = np.minimum(mark, np.where(near, far[None, :], len(self.x) * 2).min(axis=1, initial=len(self.x) * 2))
                back = np.minimum(far, np.where(near, low[:, None], len(self.x) * 2).min(axis=0, initial=len(self.x) * 2))
                if (low == mark).all() and (back == far).all():
                    break
                mark, far = low, back
            for i in np.flatnonzero(mark < len(others)).tolist():
                self.join(int(part[i]), int(others[mark[i]]))
            for j in np.flatnonzero(far < np.arange(len(others))).tolist():
                self.join(int(others[j]), int(others[far[j]]))


def unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares must neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _tree_of_block(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    group = group.sort_values("node")
    x = unit(group["v"])
    tree = build(x)
    links = Links(x, group["weight"].to_numpy(), threshold)
    for p, q in leaf_pairs(tree, x, math.sqrt(2 - 2 * threshold)):
        links.add(tree.rows[p], tree.rows[p] if p == q else tree.rows[q])
    leaf, radius = np.zeros(len(x), np.int64), np.zeros(len(x))
    centre = np.zeros(len(x), bool)
    node = group["node"].to_numpy()
    for rows, c, r in zip(tree.rows, tree.centre, tree.radius, strict=True):
        if rows is not None:
            leaf[rows], radius[rows], centre[c] = node[c], r, True
    return pd.DataFrame({
        "node": node, "weight": group["weight"], "v": list(x), "cell": group["cell"], "block": group["block"],
        "links": links.count, "root": node[[links.root(i) for i in range(len(x))]],
        "leaf": leaf, "radius": radius, "is_centre": centre,
    })


_LEAF = "node long, weight long, v array<double>, cell int, block long, links long, root long, leaf long, radius double, is_centre boolean"


def _pairs_of_leaves(group: pd.DataFrame, reach: float) -> pd.DataFrame:
    """Leaves of two sides that may hold a linked pair and lie in different blocks."""
    left, right = group[group["side"] == 0], group[group["side"] == 1]
    empty = pd.DataFrame({"p": np.zeros(0, np.int64), "q": np.zeros(0, np.int64)})
    if left.empty or right.empty:
        return empty
    balls = [(np.stack(s["v"]), s["radius"].to_numpy()) for s in (left, right)]
    i, j = (np.concatenate(n) for n in zip(*near_pairs(*balls[0], *balls[1], reach), strict=True))
    cell, block = ((left[c].to_numpy()[i] != right[c].to_numpy()[j]) for c in ("cell", "block"))
    p, q = left["leaf"].to_numpy()[i][cell | block], right["leaf"].to_numpy()[j][cell | block]
    return pd.DataFrame({"p": np.minimum(p, q), "q": np.maximum(p, q)})


def _links_of_pairs(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between the leaves p and q of each pair in the bin."""
    out = []
    for _, pair in group.groupby(["p", "q"], sort=False):
        pair = pair.drop_duplicates("node").sort_values("node")
        links = Links(np.stack(pair["v"]), pair["weight"].to_numpy(), threshold)
        mine = (pair["leaf"] == pair["p"]).to_numpy()
        links.add(np.flatnonzero(mine), np.flatnonzero(~mine))
        node = pair["node"].to_numpy()
        out.append(pd.DataFrame({"node": node, "links": links.count, "root": node[[links.root(i) for i in range(len(node))]]}))
    return pd.concat(out).query("links > 0")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, key: str = "vec_id", column: str = "embedding", shape: Shape = Shape()) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Vectors that are null, empty or zero, or that hold null or non-finite components, link with
    nothing; vectors of different lengths have no cosine, so each length is compared by itself.
    Rows that repeat an id are vectors of their own. Other columns are left out.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(column).cast("array<double>").alias("v"))
    sound = (
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    fine = rows.where("sound")
    nodes = stored(
        fine.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight")).withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    # one row for each length that occurs
    lengths = [r[0] for r in nodes.select(F.size("v")).distinct().orderBy(F.size("v")).collect()] or [0]
    found = reduce(DataFrame.union, [_linked(nodes.where(F.size("v") == n), threshold, shape) for n in lengths])
    labelled = nodes.join(found, "node")
    least = labelled.groupBy("root").agg(F.min("id").alias("component_id"))
    answers = labelled.join(least, "root").select("v", F.col("n_links"), "component_id")
    linked = fine.join(answers, "v").select("id", "n_links", "component_id")
    alone = rows.where(~F.col("sound")).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.union(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )


def _linked(nodes: DataFrame, threshold: float, shape: Shape) -> DataFrame:
    """(node, root, n_links) for distinct vectors."""
    reach = math.sqrt(2 - 2 * threshold)
    total = nodes.count()
    wanted = min(shape.pivots, max(1, math.ceil(total / shape.cell)))
    sample = nodes.select("v").orderBy(F.xxhash64("v"), "v").limit(wanted).collect()
    pivots = unit([r["v"] for r in sample]) if sample else np.zeros((1, 1))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = distances(unit(batch["v"]), pivots)
                cell = d.argmin(axis=1)
                yield batch.assign(cell=cell.astype(np.int32), far=d[np.arange(len(d)), cell])

    dealt = stored(
        nodes.select("node", "v", "weight").mapInPandas(assign, "node long, v array<double>, weight long, cell int, far double"), "cells"
    )
    # at most one short row for each pivot
    cells = {r["cell"]: r for r in dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    parts = [math.ceil(cells[c]["n"] / shape.block) if c in cells else 1 for c in range(len(pivots))]
    # no more rows than pivots
    table = nodes.sparkSession.createDataFrame(list(enumerate(parts)), "cell int, parts int")
    dealt = dealt.join(F.broadcast(table), "cell")
    blocked = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts").cast("long")))
    leaves = stored(
        blocked.select("node", "weight", "v", "cell", "block").groupBy("cell", "block").applyInPandas(lambda g: _tree_of_block(g, threshold), _LEAF),
        "leaves",
    )
    cross = _across(leaves, pivots, cells, parts, threshold, reach)
    counted = leaves.select("node", "links").union(cross.select("node", "links"))
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    edges = leaves.select("node", "root").union(cross.select("node", "root")).select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(edges)
    return (
        nodes.select("node", "weight")
        .join(links, "node")
        .join(roots, "node", "left")
        .select("node", F.coalesce("root", "node").alias("root"), (F.col("links") + F.col("weight") - 1).alias("n_links"))
    )


def _across(leaves: DataFrame, pivots, cells, parts, threshold: float, reach: float) -> DataFrame:
    """(node, links, root) from pairs of leaves in different blocks."""
    spark = leaves.sparkSession
    far = np.array([cells[c]["far"] if c in cells else -9.0 for c in range(len(pivots))])
    close = distances(pivots, pivots) <= far[:, None] + far[None, :] + reach + SLACK
    i, j = np.nonzero(np.triu(close))
    pairs = [(int(c), int(d)) for c, d in zip(i, j, strict=True) if c in cells and d in cells and (c != d or parts[c] > 1)]
    met = spark.createDataFrame(pairs, "c int, d int")
    centres = leaves.where("is_centre").select("leaf", "v", "radius", "cell", "block")
    salts = centres.groupBy("cell").agg(F.ceil(F.count("*") / LEAVES_PER_BLOCK).cast("long").alias("salts"))
    salted = stored(
        centres.join(salts, "cell").withColumn("salt", F.pmod(F.xxhash64("leaf"), "salts")), "centres"
    )
    others = lambda side: F.explode(F.sequence(F.lit(0).cast("long"), F.col(side) - 1))
    counts = salted.groupBy("cell").agg(F.max("salts").alias("n"))
    met = met.join(counts.select(F.col("cell").alias("c"), F.col("n").alias("cs")), "c").join(
        counts.select(F.col("cell").alias("d"), F.col("n").alias("ds")), "d"
    )
    met = met.select("c", "d", "ds", others("cs").alias("s")).select("c", "d", "s", others("ds").alias("t"))
    tasks = met.where("c < d OR s <= t")
    left = salted.join(tasks, (F.col("cell") == F.col("c")) & (F.col("salt") == F.col("s"))).withColumn("side", F.lit(0))
    right = salted.join(tasks, (F.col("cell") == F.col("d")) & (F.col("salt") == F.col("t"))).withColumn("side", F.lit(1))
    near = stored(
        left.union(right)
        .select("c", "s", "d", "t", "side", "leaf", "v", "radius", "cell", "block")
        .groupBy("c", "s", "d", "t")
        .applyInPandas(lambda g: _pairs_of_leaves(g, reach), "p long, q long")
        .distinct(),
        "near",
    )
    members = leaves.select("node", "weight", "v", "leaf")
    both = near.select("p", "q", F.explode(F.array("p", "q")).alias("leaf")).join(members, "leaf")
    both = stored(both, "members")
    bins = max(1, math.ceil(both.count() / ROWS_PER_BIN))
    return stored(
        both.groupBy(F.pmod(F.xxhash64("p", "q"), F.lit(bins)).alias("bin")).applyInPandas(
            lambda g: _links_of_pairs(g, threshold), "node long, links long, root long"
        ),
        "across",
    )
