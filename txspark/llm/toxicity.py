"""Toxicity by the nearest labelled examples, through a block-max inverted index.

A text is a TF-IDF vector over terms that the labels speak for: words, and stems of words
(their first letters), that stand in more texts of label 1 than chance allows. All other
words of the text count together as one further term, so that a long text with one such word
lies near harmless ones. Document frequencies are counted over all documents.

The labelled examples' vectors form an inverted index whose lists are cut into blocks with the
largest weight of each; a search visits blocks by falling upper bound and ends when no block
left can hold a nearer example, so the cosines found are the exact largest. Neighbours vote by
distance, and a logistic curve fitted to the votes of examples that leave themselves out
turns votes into probabilities.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txspark.llm.common import bounded_sample, ship, spread, stored

_WORD = re.compile(r"\w+")
CACHE_ENTRIES = 100_000


@dataclass(frozen=True)
class Settings:
    """max_examples: labelled rows of each label, the bound of the sample that is learned from.
    stems: lengths of word beginnings that count as terms of their own. false_terms: the share
    of chosen terms that may be there by chance; lift: how many times more often than in label 0
    a term stands in texts of label 1, at least, so that a language or a subject which has a few
    more of these is no sign. cover: terms that an example needs before further
    ones count as no help to it. near: distance at which a vote halves."""

    max_examples: int = 4000
    max_terms: int = 1000
    least_texts: int = 3
    stems: tuple[int, ...] = (4, 5, 6, 7)
    false_terms: float = 0.05
    lift: float = 3.0
    cover: int = 5
    neighbours: int = 15
    block: int = 32
    near: float = 0.05


def terms_of(word: str, stems: Sequence[int]) -> list[str]:
    """The word, and its stems with a star behind them."""
    return [word, *(word[:k] + "*" for k in stems if len(word) > k)]


@dataclass
class Vocabulary:
    """Chosen terms with their inverse document frequencies; the last number, one more than
    there are terms, stands for all other words."""

    terms: list[str]
    stems: tuple[int, ...]
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __post_init__(self) -> None:
        self.number = {t: i for i, t in enumerate(self.terms)}
        self.gate = min(self.stems, default=4)
        # a word can only hold a term if its beginning is that of a term
        self.gates = {t.rstrip("*")[: self.gate] for t in self.terms}
        self.of_word: dict[str, tuple[int, ...]] = {}

    def _numbers(self, word: str) -> tuple[int, ...]:
        known = self.of_word.get(word)
        if known is None:
            known = tuple(self.number[t] for t in terms_of(word, self.stems) if t in self.number)
            if len(self.of_word) < CACHE_ENTRIES:
                self.of_word[word] = known
        return known

    def counts(self, text: str | None) -> dict[int, int]:
        """How often each term stands in the whole text; null is empty."""
        words = _WORD.findall(text.lower()) if text else []
        gates, gate = self.gates, self.gate
        found: Counter[int] = Counter()
        other = len(words)
        for w in [w for w in words if w[:gate] in gates]:
            numbers = self._numbers(w)
            found.update(numbers)
            other -= bool(numbers)
        if other:
            found[len(self.terms)] = other
        return found

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers, rising, and their weights, of length 1."""
        ids = np.array(sorted(counts), np.int64)
        weights = (1 + np.log(np.array([counts[i] for i in ids.tolist()], float))) * self.idf[ids]
        return ids, weights / (np.linalg.norm(weights) if len(ids) else 1)


class BlockMaxIndex:
    """Inverted lists over unit vectors, cut into blocks of neighbouring vectors.

    Vectors with the same heaviest terms stand together, so that few blocks have large bounds.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int) -> None:
        heaviest = [tuple(i[np.argsort(-w, kind="stable")][:4].tolist()) for i, w in vectors]
        self.order = sorted(range(len(vectors)), key=lambda v: (heaviest[v], v))
        self.block, self.blocks = block, -(-len(vectors) // block)
        sizes = [len(vectors[v][0]) for v in self.order]
        place = np.repeat(np.arange(len(vectors)), sizes)
        term = np.concatenate([vectors[v][0] for v in self.order] + [np.zeros(0, np.int64)])
        weight = np.concatenate([vectors[v][1] for v in self.order] + [np.zeros(0)])
        by_term = np.lexsort((place, term))
        self.place, self.weight = place[by_term], weight[by_term]
        cell = term[by_term] * self.blocks + self.place // block
        self.edges = np.searchsorted(cell, np.arange(terms * self.blocks + 1))
        self.highest = np.zeros(terms * self.blocks)
        np.maximum.at(self.highest, cell, self.weight)
        self.highest = self.highest.reshape(terms, self.blocks)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, cosines) of the k vectors with the largest positive cosines, exactly; of
        equal ones those that stand first in the index. Fewer where fewer are positive."""
        places, cosines = np.zeros(0, np.int64), np.zeros(0)
        if len(ids) and self.blocks:
            bound = weights @ self.highest[ids]
            order = np.argsort(-bound, kind="stable")
            at, step = 0, 2
            while at < len(order) and bound[order[at]] > 0:
                if len(places) == k and bound[order[at]] < cosines[-1] - 1e-9:
                    break
                p, c = self._scored(order[at : at + step], ids, weights)
                places, cosines = np.concatenate([places, p]), np.concatenate([cosines, c])
                best = np.lexsort((places, -np.round(cosines, 12)))[:k]
                places, cosines = places[best], cosines[best]
                at, step = at + step, step * 2
        return np.array([self.order[p] for p in places.tolist()], np.int64), cosines

    def _scored(self, blocks: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of all vectors in some blocks that share a term."""
        cells = (ids[:, None] * self.blocks + blocks[None, :]).ravel()
        start, size = self.edges[cells], self.edges[cells + 1] - self.edges[cells]
        spot = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        local = np.repeat(np.tile(np.arange(len(blocks)), len(ids)), size) * self.block + self.place[spot] % self.block
        gain = self.weight[spot] * np.repeat(np.repeat(weights, len(blocks)), size)
        total = np.bincount(local, weights=gain, minlength=len(blocks) * self.block)
        hit = np.flatnonzero(total > 0)
        return blocks[hit // self.block] * self.block + hit % self.block, total[hit]


@dataclass
class Model:
    """Examples with equal vectors are one entry: `toxic` and `clean` count them, `named` has the
    smallest id. prior: the share of label 1, for texts without words."""

    settings: Settings
    vocabulary: Vocabulary | None = None
    index: BlockMaxIndex | None = None
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    clean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    named: list[int] = field(default_factory=list)
    slope: float = 0.0
    offset: float = 0.0
    prior: float = 0.5

    def __post_init__(self) -> None:
        self.known: dict[bytes, tuple[float, list[tuple[int, float, float]]]] = {}

    def vote(self, near: np.ndarray, cosines: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
        """Share of label 1 among the neighbours, nearer ones weighing more."""
        pull = 1 / (self.settings.near + np.maximum(1 - cosines, 0))
        return float((pull * toxic[near] / (toxic + clean)[near]).sum() / pull.sum())

    def probability(self, vote: float) -> float:
        return float(1 / (1 + math.exp(-min(max(self.slope * vote + self.offset, -30), 30))))

    def score(self, text: str | None) -> tuple[float, list[tuple[int, float, float]], list[str]]:
        """(probability, nearest examples as id, cosine and share of label 1, terms in the text)."""
        if self.vocabulary is None:
            return self.prior, [], []
        ids, weights = self.vocabulary.vector(self.vocabulary.counts(text))
        if not len(ids):
            return self.prior, [], []
        key = ids.tobytes() + weights.tobytes()
        seen = self.known.get(key)
        if seen is None:
            near, cosines = self.index.nearest(ids, weights, self.settings.neighbours)
            shares = (self.toxic / (self.toxic + self.clean))[near]
            listed = [(self.named[j], float(c), float(s)) for j, c, s in zip(near.tolist(), cosines, shares, strict=True)]
            odds = self.probability(self.vote(near, cosines, self.toxic, self.clean)) if len(near) else self.prior
            seen = odds, listed
            if len(self.known) < CACHE_ENTRIES:
                self.known[key] = seen
        return *seen, [self.vocabulary.terms[i] for i in ids.tolist() if i < len(self.vocabulary.terms)]


def _tail(g: float) -> float:
    """Chance of a larger chi-square with one degree of freedom."""
    return math.erfc(math.sqrt(max(g, 0.0) / 2))


def _chosen_terms(sample: DataFrame, settings: Settings, sizes: dict[int, int]) -> list[str]:
    """Terms that stand in more texts of label 1 than chance allows, the surest ones first.

    Log-likelihood ratios of all terms, and the Benjamini-Hochberg rule on their tails.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = (Counter(), Counter())
            for text, label in zip(batch["t"], batch["y"], strict=True):
                words = set(_WORD.findall(text.lower()))
                own[label].update({t for w in words for t in terms_of(w, settings.stems)})
            terms = list(own[0] | own[1])
            yield pd.DataFrame({"term": terms, "a": [own[1][t] for t in terms], "b": [own[0][t] for t in terms]})

    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return []

    def part(seen: Column, of: int) -> Column:
        expected = (F.col("a") + F.col("b")) * (of / (n1 + n0))
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    found = (
        sample.mapInPandas(counted, "term string, a long, b long")
        .groupBy("term")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .where(F.col("a") + F.col("b") >= settings.least_texts)
        .select("term", (F.col("a") * n0 >= settings.lift * F.col("b") * n1).alias("more"), (2 * (part(F.col("a"), n1) + part(F.col("b"), n0))).alias("g"))
    )
    found = stored(found, "terms")
    tested = found.count()
    best = found.where("more").orderBy(F.desc("g"), "term").limit(settings.max_terms).collect()
    kept = [k for k, r in enumerate(best, 1) if _tail(r["g"]) <= settings.false_terms * k / max(tested, 1)]
    return [r["term"] for r in best[: max(kept, default=0)]]


def _document_frequencies(docs: DataFrame, text: str, vocabulary: Vocabulary) -> np.ndarray:
    """Inverse document frequencies over all documents, one for all other words."""
    size = len(vocabulary.terms)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = np.zeros(size + 1, np.int64), 0
        for batch in batches:
            for x in batch.iloc[:, 0]:
                held[list(vocabulary.counts(x))] += 1
            rows += len(batch)
        some = np.flatnonzero(held[:size])
        yield pd.DataFrame({"i": [-1, *some.tolist()], "n": [rows, *held[some].tolist()]})

    found = docs.select(text).mapInPandas(counted, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    seen = {r["i"]: r["n"] for r in found}
    total = seen.get(-1, 0)
    return np.array([1 + math.log((1 + total) / (1 + seen.get(i, 0))) for i in range(size)] + [1.0])


def _calibrate(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the votes, by Newton steps; the targets are
    drawn in a little, so that separable votes have a finite slope too."""
    positive, negative = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.column_stack([votes, np.ones(len(votes))])
    b = np.array([1.0, float(np.log(max(weights[labels == 1].sum(), 1e-9) / max(weights[labels == 0].sum(), 1e-9)))])
    ridge = np.diag([1e-3, 1e-6])
    loss = np.inf
    for _ in range(60):
        z = np.clip(x @ b, -30, 30)
        p = 1 / (1 + np.exp(-z))
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weights * (p - target)) + ridge @ b)
        size = 1.0
        while size > 1e-6:
            z = np.clip(x @ (b - size * step), -30, 30)
            now = float((weights * (np.logaddexp(0, z) - target * z)).sum() + (b - size * step) @ ridge @ (b - size * step) / 2)
            if now < loss:
                break
            size /= 2
        else:
            break
        b, loss = b - size * step, now
    return float(b[0]), float(b[1])


def train(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, settings: Settings = Settings()) -> Model:
    """Examples from at most max_examples labelled rows of each label.

    The sample is drawn by id hash for each label by itself, so that a rare label is not lost in
    a large table; calibration weighs either label back to its share. Copies of one text with
    one label are one example. Labels that are neither 0 nor 1 do not count. With one label alone
    every score is that label's; without any every score is one half.
    """
    ship(docs.sparkSession)
    wanted = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.xxhash64(F.col(key)).alias("h"), F.col(key).alias("id"), F.col(label).cast("int").alias("y")
    )
    all_of = {r["y"]: r["n"] for r in wanted.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not all_of:
        return Model(settings)
    drawn = [bounded_sample(wanted.where(F.col("y") == y), "h", settings.max_examples) for y in sorted(all_of)]
    few = drawn[0] if len(drawn) == 1 else drawn[0].union(drawn[1])
    few = F.broadcast(few)  # at most max_examples of each label
    texts = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(few, "id")
    # ids that repeat among the documents bring more texts than the sample has ids; the share that
    # is kept is drawn where the rows are, so that no task gathers them
    share = 2 * settings.max_examples / max(docs.select(F.col(key).alias("id")).join(few, "id").count(), 1)
    if share < 1:
        texts = texts.withColumn("drawn", F.xxhash64("id", "t")).where(spread("drawn") < int(share * (1 << 30)))
    sample = stored(texts.groupBy("y", "t").agg(F.min("id").alias("id")), "examples")
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model(settings)
    likely = Vocabulary(_chosen_terms(sample, settings, sizes), settings.stems)
    vocabulary = Vocabulary(_helpful(likely.terms, _counted(sample, likely), settings), settings.stems)
    vocabulary.idf = _document_frequencies(docs, text, vocabulary)
    share = all_of.get(1, 0) / sum(all_of.values())
    return _assembled(settings, vocabulary, _counted(sample, vocabulary), share)


def _counted(sample: DataFrame, vocabulary: Vocabulary) -> list[tuple[str, int, dict[int, int]]]:
    """(id, label, how often each term stands in it) of the sample's texts, which bound it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [sorted(vocabulary.counts(t).items()) for t in batch["t"]]
            yield pd.DataFrame(
                {"id": batch["id"].astype(str), "y": batch["y"], "i": [[k for k, _ in r] for r in rows], "n": [[n for _, n in r] for r in rows]}
            )

    found = sample.mapInPandas(run, "id string, y int, i array<int>, n array<int>").orderBy("id", "y", "i", "n").collect()
    return [(r["id"], r["y"], dict(zip(r["i"], r["n"], strict=True))) for r in found]


def _helpful(terms: list[str], examples: list[tuple[str, int, dict[int, int]]], settings: Settings) -> list[str]:
    """Of terms that stand in the same texts the longest; then, the surest first, those that
    stand in enough texts of label 1 that few terms have been found for. The words that a
    group of near copies shares go, as long as its texts hold surer ones."""
    texts: list[list[int]] = [[] for _ in terms]
    for e, (_, _, seen) in enumerate(examples):
        for t in seen:
            if t < len(terms):
                texts[t].append(e)
    longest: dict[tuple[int, ...], int] = {}
    for t, own in enumerate(texts):
        other = longest.setdefault(tuple(own), t)
        if len(terms[t]) > len(terms[other]):
            longest[tuple(own)] = t
    held = Counter()
    kept = []
    for t in sorted(longest.values()):
        toxic = [e for e in texts[t] if examples[e][1] == 1]
        if sum(held[e] < settings.cover for e in toxic) >= settings.least_texts:
            held.update(toxic)
            kept.append(terms[t])
    return kept


def _assembled(settings: Settings, vocabulary: Vocabulary, examples: list[tuple[str, int, dict[int, int]]], share: float) -> Model:
    entry: dict[bytes, int] = {}
    vectors, counts, named, owner = [], [], [], []
    for name, label, seen in examples:
        ids, weights = vocabulary.vector(seen)
        spot = entry.setdefault(ids.tobytes() + weights.tobytes(), len(vectors)) if len(ids) else -1
        if spot == len(vectors):
            vectors.append((ids, weights))
            counts.append([0, 0])
            named.append(name)
        if spot >= 0:
            counts[spot][label] += 1
        owner.append((spot, label))
    both = np.array(counts, float).reshape(-1, 2)
    index = BlockMaxIndex(vectors, len(vocabulary.terms) + 1, settings.block)
    model = Model(settings, vocabulary, index, both[:, 1], both[:, 0], named, prior=share)
    # votes of examples that leave themselves out
    votes, labels = [], []
    searched: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for spot, label in owner:
        if spot < 0:
            continue
        if spot not in searched:
            searched[spot] = index.nearest(*vectors[spot], settings.neighbours + 1)
        near, cosines = searched[spot]
        alone = sum(counts[spot]) == 1
        keep = (near != spot) if alone else np.ones(len(near), bool)
        near, cosines = near[keep][: settings.neighbours], cosines[keep][: settings.neighbours]
        if not len(near):
            continue
        toxic, clean = model.toxic.copy(), model.clean.copy()
        (toxic if label else clean)[spot] -= 1
        if alone:
            clean[spot] = 1  # out of the vote; keeps its share defined
        votes.append(model.vote(near, cosines, toxic, clean))
        labels.append(label)
    labels_ = np.array(labels, float)
    if 0 < labels_.sum() < len(labels_):
        weights = np.where(labels_ == 1, share / labels_.mean(), (1 - share) / (1 - labels_.mean()))
        model.slope, model.offset = _calibrate(np.array(votes), labels_, weights)
    else:
        model.slope, model.offset = 0.0, (30.0 if share >= 1 else -30.0 if share <= 0 else math.log(share / (1 - share)))
    return model


KIND = (
    "struct<score: double, neighbours: array<struct<example: string, cosine: double, share: double>>, terms: array<string>>"
)


def score(model: Model, text: Column) -> Column:
    """A struct of score, neighbours (nearest first) and terms for every whole text.

    score: probability of label 1, from 0 to 1. Null texts and texts without words have the share
    of label 1 and no neighbours. Equal texts get equal rows; examples of equal distance count in
    the index's order, which follows from their vectors and ids. As a column it leaves all columns
    of its frame as they are, whatever their names, and an empty frame empty.
    """

    @F.pandas_udf(KIND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [model.score(x if isinstance(x, str) else None) for x in batch]
            yield pd.DataFrame(
                {
                    "score": [r[0] for r in rows],
                    "neighbours": [[{"example": e, "cosine": c, "share": s} for e, c, s in r[1]] for r in rows],
                    "terms": [r[2] for r in rows],
                }
            )

    return run(text)
