"""Periodic runs of words, found in a grammar of each text.

A run is a stretch of words with smallest period q that no neighbouring word extends. The
word ids of a text are compressed by Re-Pair: pairs that occur twice become nonterminals,
the more frequent pairs first, until no pair is left. Every run of the text lies whole in the
smallest derivation node that holds it, and crosses the border between that node's two
halves. So runs across a nonterminal's border are looked for once, however often it is
derived, and then translated to all its positions; what is left of the text is a short
sequence of symbols, whose borders are joined in a balanced tree and treated alike. Found
intervals that reach the edge of their node may go on outside it: of all intervals of one
period only the maximal ones stay.

All steps are numpy operations over many texts at once. Words are numbered for each text
anew, so no pair, and no rule, spans two texts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are compressed together, unless a single text has more.
WORDS_AT_ONCE = 400_000
CANDIDATES_AT_ONCE = 1 << 21
# Every run holds two equal stretches of this many words at one side of any border it crosses.
_ANCHOR = 4


@dataclass(frozen=True)
class Limits:
    """A run has at least `least_words` words and `least_periods` periods."""

    least_words: int = 24
    least_periods: int = 3

    def __post_init__(self) -> None:
        # on the longer side of a border lie half the words; what is left of them behind one
        # period must still hold an anchor
        if self.least_periods < 3 or self.least_words < 6 * _ANCHOR:
            raise ValueError(f"runs need three periods and {6 * _ANCHOR} words at least")


@dataclass
class Grammar:
    """Rules, where each of them is derived, and the symbols that are left.

    left, size: of each rule, words in its first half and in all of it. rule, at: one entry for
    each derivation, sorted by rule, `at` being its first word. top: first words of the symbols
    that no rule replaced.
    """

    left: np.ndarray
    size: np.ndarray
    rule: np.ndarray
    at: np.ndarray
    top: np.ndarray


def grammar(words: np.ndarray, seed: int = 5) -> Grammar:
    """Re-Pair over a sequence of ids.

    A round replaces all pairs that occur twice or more and are more frequent than the pairs
    they overlap with; a random order decides between equally frequent ones, so that a long
    repeated stretch halves in each round. Of overlapping occurrences of a pair of equal
    symbols every other one counts.
    """
    n = len(words)
    rng = np.random.default_rng(seed)
    symbol = np.append(words, -1).astype(np.int64)
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    before[0] = n  # the place behind the end stands for "none" on either side
    after[n] = before[n] = n
    free = int(words.max(initial=-1)) + 1  # the next symbol
    first_rule, base = free, free + n + 1
    size = np.ones(n + 1, np.int64)  # words of the symbol that starts here
    starts = np.ones(n + 1, bool)
    starts[n] = False
    left, whole, rules, places = [], [], [], []
    known = np.zeros(0, np.int64)  # pairs that have a rule, and the symbol of each
    known_symbol = np.zeros(0, np.int64)
    rank = np.zeros(n + 1, np.int64)
    alive = np.arange(n - 1)
    while len(alive) > 1:
        nxt = after[alive]
        a, b = symbol[alive], symbol[nxt]
        counted = np.ones(len(alive), bool)
        same = np.flatnonzero(a == b)
        if len(same):
            at = alive[same]
            head = np.ones(len(at), bool)
            head[1:] = after[at[:-1]] != at[1:]
            heads = np.flatnonzero(head)
            counted[same] = (np.arange(len(at)) - heads[np.cumsum(head) - 1]) % 2 == 0
        pairs, which = np.unique(a * base + b, return_inverse=True)
        often = np.bincount(which, weights=counted, minlength=len(pairs)).astype(np.int64)
        able = counted & (often[which] >= 2)
        rank[alive] = np.where(able, often[which] * len(pairs) + rng.permutation(len(pairs))[which], 0)
        mine = rank[alive]
        won = able & (mine > rank[before[alive]]) & (mine > rank[nxt])
        rank[alive] = 0
        won &= np.bincount(which[won], minlength=len(pairs))[which] >= 2
        if not won.any():
            break
        at, pair = alive[won], which[won]
        used = np.unique(pair)
        spot = np.searchsorted(known, pairs[used])
        old = spot < len(known)
        old[old] = known[spot[old]] == pairs[used][old]
        to = np.empty(len(pairs), np.int64)
        to[used[old]] = known_symbol[spot[old]]
        new = used[~old]
        to[new] = free + np.arange(len(new))
        one = np.empty(len(pairs), np.int64)
        one[pair] = at  # any occurrence tells the sizes
        left.append(size[one[new]])
        whole.append(size[one[new]] + size[after[one[new]]])
        free += len(new)
        order = np.argsort(np.concatenate([known, pairs[new]]), kind="stable")
        known, known_symbol = np.concatenate([known, pairs[new]])[order], np.concatenate([known_symbol, to[new]])[order]
        gone = after[at]
        behind = after[gone]
        rules.append(to[pair] - first_rule)
        places.append(at)
        symbol[at] = to[pair]
        size[at] += size[gone]
        starts[gone] = False
        after[at] = behind
        before[behind] = at
        mark = np.zeros(n + 1, bool)
        mark[alive[often[which] >= 2]] = True
        mark[at] = mark[before[at]] = True
        mark[gone] = mark[n] = False
        alive = np.flatnonzero(mark)
        alive = alive[after[alive] < n]
    rule = np.concatenate(rules) if rules else np.zeros(0, np.int64)
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    order = np.argsort(rule, kind="stable")
    none = np.zeros(0, np.int64)
    return Grammar(
        np.concatenate(left) if left else none,
        np.concatenate(whole) if whole else none,
        rule[order],
        place[order],
        np.flatnonzero(starts),
    )


class Repeats:
    """Names of the stretches of 1, 2, 4, ... words that occur more than once, and how far two
    places agree. A stretch that occurs once has the name -1; names are exact, not hashes."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        self.levels = [_names(words.astype(np.int64), np.arange(self.n), self.n)]
        while True:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            able = np.flatnonzero(last[: max(self.n - step, 0)] >= 0)
            able = able[last[able + step] >= 0]
            if not len(able) and len(self.levels) > 2:
                return
            pairs = last[able].astype(np.int64) * (self.n + 1) + last[able + step]
            self.levels.append(_names(pairs, able, self.n))

    @property
    def anchors(self) -> np.ndarray:
        return self.levels[2]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j on; i and j differ."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = i + out, j + out
            inside = (x < self.n) & (y < self.n)
            a = self.levels[k][np.where(inside, x, 0)]
            same = inside & (a >= 0) & (a == self.levels[k][np.where(inside, y, 0)])
            out += same.astype(np.int64) << k
        return out

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree before i and before j."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = i - out - (1 << k), j - out - (1 << k)
            inside = (x >= 0) & (y >= 0)
            a = self.levels[k][np.where(inside, x, 0)]
            same = inside & (a >= 0) & (a == self.levels[k][np.where(inside, y, 0)])
            out += same.astype(np.int64) << k
        return out


def _names(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    names = np.full(n, -1, np.int32 if n < 1 << 31 else np.int64)
    if len(keys):
        _, which, often = np.unique(keys, return_inverse=True, return_counts=True)
        names[at] = np.where(often[which] > 1, which, -1)
    return names


def _nodes(g: Grammar, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rule or -1, first word, border, end) of all nodes long enough for a run."""
    first = np.searchsorted(g.rule, np.arange(len(g.size)))
    wide = np.flatnonzero(g.size >= least)
    at = g.at[first[wide]]
    # the symbols of each text, joined in a balanced tree: the border before symbol k belongs
    # to the node of 2^t symbols on either side, 2^t being the largest power that divides k
    head = np.searchsorted(g.top, offsets)
    doc = np.searchsorted(offsets[1:], g.top, side="right")
    k = np.arange(len(g.top)) - head[doc]
    reach = k & -k
    inner = k > 0
    ends = np.append(g.top, offsets[-1])
    low = g.top[(np.arange(len(g.top)) - reach)[inner]]
    high = ends[np.minimum(np.arange(len(g.top)) + reach, head[doc + 1])[inner]]
    border = g.top[inner]
    keep = high - low >= least
    return (
        np.concatenate([wide, np.full(int(keep.sum()), -1)]),
        np.concatenate([at, low[keep]]),
        np.concatenate([at + g.left[wide], border[keep]]),
        np.concatenate([at + g.size[wide], high[keep]]),
    )


def _across(repeats: Repeats, low, border, high, limits: Limits) -> Iterator[tuple[np.ndarray, ...]]:
    """(node, start, end, period) of stretches with a period across the nodes' borders.

    On one side of the border lie half the run's words, so there an anchor recurs after one
    period: the periods tried are the distances between equal anchors.
    """
    names = repeats.anchors
    held = np.flatnonzero(names >= 0)
    key = names[held].astype(np.int64) * (repeats.n + 1) + held
    order = np.argsort(key, kind="stable")
    key, held = key[order], held[order]
    widest = (high - low) // limits.least_periods
    for side in ("ahead", "back"):
        anchor = border if side == "ahead" else border - _ANCHOR
        node = np.flatnonzero((anchor >= low) & (anchor + _ANCHOR <= high))
        node = node[names[anchor[node]] >= 0]
        a = anchor[node]
        base = names[a].astype(np.int64) * (repeats.n + 1)
        if side == "ahead":
            begin = np.searchsorted(key, base + a, side="right")
            stop = np.searchsorted(key, base + np.minimum(a + widest[node], high[node] - _ANCHOR), side="right")
        else:
            begin = np.searchsorted(key, base + np.maximum(a - widest[node], low[node]))
            stop = np.searchsorted(key, base + a)
        much = np.maximum(stop - begin, 0)
        total = np.cumsum(much)
        done = 0
        while done < len(node):
            upto = max(int(np.searchsorted(total, (total[done - 1] if done else 0) + CANDIDATES_AT_ONCE, side="right")), done + 1)
            some, m = slice(done, upto), much[done:upto]
            done = upto
            owner = np.repeat(node[some], m)
            if not len(owner):
                continue
            other = held[np.repeat(begin[some] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))]
            q = np.abs(other - np.repeat(a[some], m))
            i = border[owner] if side == "ahead" else border[owner] - q
            ahead = np.minimum(repeats.ahead(i, i + q), high[owner] - i - q)
            back = np.minimum(repeats.back(i, i + q), i - low[owner])
            start, end = i - back, i + q + ahead
            keep = end - start >= np.maximum(limits.least_words, limits.least_periods * q)
            yield owner[keep], start[keep], end[keep], q[keep]


def find(words: np.ndarray, offsets: np.ndarray, limits: Limits = Limits()) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, by text, start and period.

    words: ids, different in each text; text t has words offsets[t] to offsets[t + 1].
    """
    none = (np.zeros(0, np.int64),) * 4
    if not len(words):
        return none
    g = grammar(words)
    rule, low, border, high = _nodes(g, offsets, limits.least_words)
    repeats = Repeats(words)
    found = list(_across(repeats, low, border, high, limits))
    if not found:
        return none
    node, start, end, q = map(np.concatenate, zip(*found, strict=True))
    # one interval can be found with several multiples of its period
    order = np.lexsort((q, end, start, node))
    node, start, end, q = node[order], start[order], end[order], q[order]
    new = np.ones(len(node), bool)
    new[1:] = (np.diff(node) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0)
    node, start, end, q = node[new], start[new], end[new], q[new]
    # from the one place where a rule was looked at to all places where it is derived
    r = rule[node]
    inner = r >= 0
    first = np.searchsorted(g.rule, r[inner])
    many = np.searchsorted(g.rule, r[inner], side="right") - first
    places = g.at[np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
    moved = places - np.repeat(low[node[inner]], many)
    start = np.concatenate([start[~inner], np.repeat(start[inner], many) + moved])
    end = np.concatenate([end[~inner], np.repeat(end[inner], many) + moved])
    q = np.concatenate([q[~inner], np.repeat(q[inner], many)])
    return _maximal(start, end, q, offsets)


def _maximal(start, end, q, offsets) -> tuple[np.ndarray, ...]:
    """Intervals that no other one of the same period contains, each with its smallest period."""
    order = np.lexsort((-end, start, q))
    start, end, q = start[order], end[order], q[order]
    # ends rise from one period to the next, so that a running maximum stays within a period
    lift = q * (offsets[-1] + 1)
    top = np.maximum.accumulate(end + lift)
    keep = np.ones(len(end), bool)
    keep[1:] = (end + lift)[1:] > top[:-1]
    start, end, q = start[keep], end[keep], q[keep]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    keep = np.ones(len(end), bool)
    keep[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
    start, end, q = start[keep], end[keep], q[keep]
    order = np.lexsort((q, start))
    start, end, q = start[order], end[order], q[order]
    text = np.searchsorted(offsets[1:], start, side="right")
    return text, start - offsets[text], end - start, q


def _strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """The run with the greatest length by period, compared exactly; the earliest of equal ones."""
    best = None
    for k, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = k
    return best


def _described(texts: Sequence[Sequence[bytes]], limits: Limits) -> list[tuple]:
    """(words, runs, strongest run, kept words joined) of lists of words."""
    numbers = count()
    ids = []
    for words in texts:
        seen: defaultdict[bytes, int] = defaultdict(numbers.__next__)
        ids.append(np.fromiter(map(seen.__getitem__, words), np.int64, len(words)))
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
    owner, start, length, period = find(np.concatenate([*ids, np.zeros(0, np.int64)]), offsets, limits)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    rows = []
    for t, words in enumerate(texts):
        mine = slice(cut[t], cut[t + 1])
        runs = list(zip(start[mine].tolist(), length[mine].tolist(), period[mine].tolist(), strict=True))
        kept = words
        if runs:
            drop = np.zeros(len(words) + 1, np.int64)
            np.add.at(drop, start[mine] + period[mine], 1)
            np.add.at(drop, start[mine] + length[mine], -1)
            kept = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]
        rows.append((len(words), runs, _strongest(runs), b" ".join(kept)))
    return rows


KIND = (
    "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, "
    "strongest: struct<start: long, length: long, period: long>, collapsed: binary>"
)


def detect(text: Column, limits: Limits = Limits()) -> Column:
    """A struct of n_words, runs (by start, then period), strongest (null without a run) and
    collapsed for every whole text.

    Words are what stands between ASCII white space, numbered from 0. `collapsed` (UTF-8) has the
    words that no run contains behind its first period, joined by one space. Null and empty texts
    have no words and no runs. Equal texts give equal rows. Of runs with equal length by period
    the earliest is strongest, of several at one start the one with the smallest period. As a
    column it leaves all columns of its frame as they are, and an empty frame empty. Memory
    follows the longest text, or WORDS_AT_ONCE words where texts are shorter.
    """

    @F.pandas_udf(KIND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            held: list[list[bytes]] = []
            size = 0
            for x in batch:
                words = x.split() if x else []
                if held and size + len(words) > WORDS_AT_ONCE:
                    rows += _described(held, limits)
                    held, size = [], 0
                held.append(words)
                size += len(words)
            rows += _described(held, limits)
            named = [
                [{"start": s, "length": n, "period": q} for s, n, q in runs] for _, runs, _, _ in rows
            ]
            yield pd.DataFrame(
                {
                    "n_words": [r[0] for r in rows],
                    "runs": named,
                    "strongest": [None if r[2] is None else own[r[2]] for r, own in zip(rows, named, strict=True)],
                    "collapsed": [r[3] for r in rows],
                }
            )

    return run(text.cast("binary"))
