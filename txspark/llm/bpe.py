"""Byte-level BPE encoding and decoding with given ranks.

Each match of the split pattern is merged on its own: a segment tree over byte positions
holds the lowest pair rank (leftmost among equals) of every range, so a merge is a look at
the root and three logarithmic updates, of the pair before, the pair itself and the pair
that it swallowed. The trees of many short matches stand in one array and take their merges
together, one each a round. Token ids travel as binary columns of little-endian unsigned
32-bit integers. Memory: some texts of CHARS_AT_ONCE together, or a longer one, with their ids.
Nothing is kept from one to the next, as Spark hands a worker to encoding and decoding by turns.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from txspark.llm.chunks import cuts_at_spaces

CHARS_AT_ONCE = 2_000_000
# Matches of up to so many bytes are merged together, up to TREES_AT_ONCE of them; few are
# faster one by one.
TREE_LEAVES = (8, 16, 32, 64)
FEW_TREES, TREES_AT_ONCE = 64, 4096
# Unicode's White_Space, which the split pattern means by \s.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Token ids of one match."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    none = 1 << 62  # above every rank * n + position
    size = 1 << max(0, (n - 2).bit_length())
    tree = [none] * (2 * size)
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank * n + i
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            least = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == least:
                break
            tree[k] = least
            k >>= 1

    def pair(start: int, end: int) -> int:
        if end - start > longest:
            return none
        rank = ranks.get(piece[start:end])
        return none if rank is None else rank * n + start

    ends = list(range(1, n + 1))  # where the live token at a position ends
    before = list(range(-1, n))  # the live token before it
    while tree[1] < none:
        i = tree[1] % n
        j = ends[i]
        end = ends[i] = ends[j]
        put(j, none) if j < n - 1 else None
        if end < n:
            before[end] = i
            put(i, pair(i, ends[end]))
        else:
            put(i, none)
        if before[i] >= 0:
            put(before[i], pair(before[i], end))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return ids


class _Trees:
    """Merges many short matches together.

    Tokens are numbered by rank, then come the single bytes that are no tokens. A pair of live
    tokens is looked up among all pairs that make a token.
    """

    def __init__(self, tokens: list[bytes]):
        known, single = set(tokens), [bytes([b]) for b in range(256)]
        number = {t: k for k, t in enumerate([*tokens, *(b for b in single if b not in known)])}
        self.singles = np.array([number[b] for b in single], np.int64)
        self.tokens, self.many = len(tokens), len(number)
        keys, made = array("q"), array("q")
        for token, k in number.items():
            for cut in range(1, len(token)):
                left, right = number.get(token[:cut]), number.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.many + right)
                    made.append(k)
        keys, made = np.array(keys, np.int64), np.array(made, np.int64)
        order = np.argsort(keys)
        # one key more, which no pair has, so that every place found is one
        self.keys, self.made = np.append(keys[order], self.many**2), np.append(made[order], -1)
        both = np.repeat(self.singles, 256), np.tile(self.singles, 256)
        self.first = self._pairs(*both)  # of two bytes

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The numbers of the tokens that pairs make, -1 for none."""
        key = left * self.many + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], -1)

    def merge(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers of the matches that stand in the data, each of at most `leaves` bytes, one
        match after another, and how many each has."""
        many, none = len(sizes), self.many * leaves
        width = leaves + 1  # the places of a match, and its end
        within = np.arange(width) < sizes[:, None]
        bytes_ = np.zeros((many, width), np.int64)
        bytes_[within] = data[(starts[:, None] + np.arange(width))[within]]
        live = np.where(within, self.singles[bytes_], -1)
        ends = np.tile(np.arange(1, width + 1), many)  # where the live token at a place ends
        before = np.tile(np.arange(-1, leaves), many)  # the live token before it
        tree = np.empty((many, 2 * leaves), np.int64)
        pairs = np.where(within[:, 1:], self.first[bytes_[:, :-1] * 256 + bytes_[:, 1:]], -1)
        tree[:, leaves:] = np.where(pairs < 0, none, pairs * leaves + np.arange(leaves))
        level = leaves
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        live, tree = live.ravel(), tree.ravel()
        match = np.arange(many)
        while True:
            root = tree[match * (2 * leaves) + 1]
            more = root < none
            match, root = match[more], root[more]
            if not len(match):
                break
            at, top = match * width, match * (2 * leaves)
            token, i = np.divmod(root, leaves)
            j = ends[at + i]
            end = ends[at + j]
            live[at + i], live[at + j] = token, -1
            ends[at + i] = end
            before[at + end] = i
            # the pair of the token and the one behind it, where there is one, and the pair before
            h, behind = before[at + i], live[at + end]
            ahead = live[at + np.maximum(h, 0)]
            left, right = np.concatenate([token, ahead]), np.concatenate([behind, token])
            pair = self._pairs(left, np.maximum(right, 0))
            after, prior = pair[: len(i)], pair[len(i) :]
            after = np.where((behind < 0) | (after < 0), none, after * leaves + i)
            tree[top + leaves + j] = none
            tree[top + leaves + i] = after
            first = h < 0
            h, prior = np.where(first, i, h), np.where(first, after, np.where(prior < 0, none, prior * leaves + h))
            tree[top + leaves + h] = prior
            node, top = np.concatenate([i, j, h]) + leaves, np.concatenate([top, top, top])
            for _ in range(leaves.bit_length() - 1):
                node >>= 1
                below = top + 2 * node
                tree[top + node] = np.minimum(tree[below], tree[below + 1])
        kept = live >= 0
        numbers = live[kept]
        if len(numbers) and numbers.max() >= self.tokens:
            raise KeyError("a byte that is no token")
        return numbers, kept.reshape(many, width).sum(axis=1)


class Codec:
    """Encodes texts to packed ids.

    Texts fall into chunks at their spaces. The distinct chunks of many texts at once are split into
    matches, the distinct matches merged, and the ids gathered for all places.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        spelled = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.split = regex.compile(spelled).findall
        self.ranks, self.longest = ranks, max(map(len, ranks), default=0)
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.ids = np.array([ranks[t] for t in tokens], "<u4")
        self.whole = pa.array(tokens, pa.large_binary())
        self.trees = _Trees(tokens)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text.encode("utf-8", "replace").decode()])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        if not texts:
            return []
        # the first chunk of a text has no space before it; a text that is not cut is all first chunk
        heads, _, rests = zip(*(t.partition(" ") if " " in t and cuts_at_spaces(t) else (t, "", None) for t in texts), strict=True)
        lists = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        found = lists.values.dictionary_encode()
        first = lists.offsets.to_numpy()
        which = np.insert(found.indices.to_numpy().astype(np.int64), first[:-1], len(found.dictionary) + np.arange(len(texts)))
        first = first + np.arange(len(first))
        matches, many = self._matches(found.dictionary.to_pylist())
        for own in map(self.split, heads):
            matches += own
            many.append(len(own))
        found = pa.array(matches, pa.large_string()).dictionary_encode()
        del matches
        table, starts, sizes = self._merged(found.dictionary)
        # ids of the chunks, then of the texts
        table, ends = _gathered(table, starts, sizes, found.indices.to_numpy())
        ends = ends[np.cumsum([0, *many])]
        table, ends = _gathered(table, ends[:-1], np.diff(ends), which)
        bounds = ends[first].tolist()
        return [table[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]

    def _matches(self, chunks: list[str]) -> tuple[list[str], list[int]]:
        """Matches of chunks behind a space, in order, and how many each chunk has. All are split
        as one text, in which each space starts a chunk, but those that have white space at an end."""
        parts, many, at = [], [], 0
        for k in [*(k for k, c in enumerate(chunks) if not c or c[0].isspace() or c[-1].isspace()), len(chunks)]:
            together, alone = chunks[at:k], chunks[k : k + 1]
            at = k + 1
            if together:
                own = self.split(" " + " ".join(together))
                starts = [i for i, m in enumerate(own) if m[:1] == " "]
                if len(starts) == len(together):
                    many += [b - a for a, b in zip(starts, [*starts[1:], len(own)], strict=True)]
                    parts += own
                else:  # a pattern that also cuts elsewhere around spaces
                    alone = together + alone
            for chunk in alone:
                own = self.split(" " + chunk)
                many.append(len(own))
                parts += own
        return parts, many

    def _merged(self, matches: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A table of the ids of distinct matches, where each match stands in it and how many it has."""
        if not len(matches):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        offsets = np.frombuffer(matches.buffers()[1], np.int64, len(matches) + 1, 8 * matches.offset)
        data = np.frombuffer(matches.buffers()[2], np.uint8)
        lengths = np.diff(offsets)
        whole = pc.index_in(matches.cast(pa.large_binary()), value_set=self.whole)
        whole = pc.fill_null(whole, -1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(whole >= 0)
        blocks = [(known, self.ids[whole[known]], np.ones(len(known), np.int64))]
        alone = [np.flatnonzero((whole < 0) & (lengths > TREE_LEAVES[-1]))]
        for least, leaves in zip((-1, *TREE_LEAVES), TREE_LEAVES, strict=False):
            group = np.flatnonzero((whole < 0) & (lengths > least) & (lengths <= leaves))
            if len(group) < FEW_TREES:
                alone.append(group)
                continue
            for a in range(0, len(group), TREES_AT_ONCE):
                block = group[a : a + TREES_AT_ONCE]
                numbers, many = self.trees.merge(data, offsets[block], lengths[block], leaves)
                blocks.append((block, self.ids[numbers], many))
        for k in np.concatenate(alone).tolist():
            ids = merge(data[offsets[k] : offsets[k + 1]].tobytes(), self.ranks, self.longest)
            blocks.append(([k], np.array(ids, "<u4"), [len(ids)]))
        order, table, many = map(np.concatenate, zip(*blocks, strict=True))
        starts, sizes = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        starts[order], sizes[order] = np.cumsum(many) - many, many
        return table, starts, sizes


def _gathered(table: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The table's runs `which` one after another, and where each begins; at last, where all end."""
    sizes = sizes[which]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return table[np.repeat(starts[which] - ends[:-1], sizes) + np.arange(ends[-1])], ends


class Decoder:
    """Decodes packed ids to bytes. Its worker holds the tokens and no cache."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {i: t for t, i in ranks.items()}

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return b"".join(map(self.tokens.__getitem__, ids))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> Codec:
    return Codec(load_ranks(path), pattern)


@lru_cache(maxsize=2)
def _decoder(path: str) -> Decoder:
    return Decoder(load_ranks(path))


def _slices(batches: Iterator[pa.Array]) -> Iterator[list]:
    """The values of the batches, in order, of some CHARS_AT_ONCE bytes at a time; a batch holds
    thousands of rows whatever their length."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // CHARS_AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a).to_pylist()
        del batch
        pa.default_memory_pool().release_unused()  # before the next one comes


def encode(text: Column, ranks_path: str, pattern: str) -> Column:
    """Packed token ids of every whole text; a null text encodes as an empty one.

    ranks_path: the rank file's place on every machine, as installed there.
    """

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(ranks_path, pattern)
        for texts in _slices(batches):
            yield pa.array(codec.encode_all(texts), pa.binary())

    return run(F.coalesce(text, F.lit("")))


def decode(ids: Column, ranks_path: str, pattern: str) -> Column:
    """The bytes that packed ids stand for; null for null ids. An unknown id is an error."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _decoder(ranks_path)
        for packed in _slices(batches):
            yield pa.array([None if b is None else decoder.decode(b) for b in packed], pa.binary())

    return run(ids)
