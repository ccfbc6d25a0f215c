"""Packing documents into training sequences by length patterns.

Documents become token pieces of at most the sequence length. The histogram of piece lengths
is bounded by that length, however many documents there are, so the plan is made on it: few-
document patterns that fill a sequence are enumerated, their repeat counts fitted to the
histogram by non-negative least squares and rounded, and what remains is packed by greedy
patterns. Spark then ranks the pieces of each length and hands every rank its place.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txspark.llm.chunks import cuts_at_spaces
from txspark.llm.common import fresh, stored

# About 220 bytes each.
CHUNK_ENTRIES, WORD_ENTRIES = 690_000, 60_000
TEXTS_AT_ONCE = 1000
CHARS_AT_ONCE = 4_000_000
PIECES_PER_BUCKET = 100_000
LEAST_BUCKETS = 256
# Partners over all lengths together, and of one length at least.
PARTNERS, LEAST_PARTNERS = 4000, 3
MIXTURES = (0.0, 0.4, 0.8)
SWEEPS = 10
# What patterns may waste beyond the best ones, as shares of a sequence, round by round; first
# those of a document over half a sequence and one other.
LONG_PIECES = 2
LONG_WASTES = (0.0, 0.0005, 0.001, 0.002, 0.004)
WASTES = (0.0, 0.0, 0.001, 0.004)


_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,]?)").fullmatch


def _byte_spelling() -> dict[int, int]:
    """The characters by which byte-level tokenizers spell bytes: printable bytes as they
    are, the others as characters from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


class _Cache(dict):
    """Packed ids by text, in two generations: what is looked up stays, the rest goes once the
    younger one is full, so that the cache follows the texts and its size is bounded."""

    def __init__(self, make: Callable[[str], bytes], entries: int):
        super().__init__()
        self.make, self.half, self.older = make, max(entries // 2, 1), {}

    def __missing__(self, text: str) -> bytes:
        packed = self.older.get(text)
        if packed is None:
            packed = self.make(text)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[text] = packed
        return packed


class _Tokens:
    """Packed ids of texts, by the parts of a tokenizer of the `tokenizers` library: its
    pre-tokenizer and its model, without special tokens.

    Texts fall into chunks at their spaces. Of many texts at once the distinct chunks are looked
    up, each once, and their ids gathered for all places. With `added`, texts that hold an
    added token of the tokenizer literally go through the whole tokenizer, which gives that
    token's own id; else it is plain text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelling = _byte_spelling()
        self.space, self.line_end = chr(self.spelling[32]), chr(self.spelling[10])
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.words = _Cache(self._word, WORD_ENTRIES)
        self.chunks = _Cache(self._chunk, CHUNK_ENTRIES)

    def _word(self, word: str) -> bytes:
        """Of a pre-tokenizer's word, spelled its way."""
        ids = [t.id for t in self.model(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, text: str) -> bytes:
        return b"".join([self.words[word] for word, _ in self.split(text)])

    def _chunk(self, chunk: str) -> bytes:
        """Of a chunk behind a space. Latin words, alone or before one mark, and lines of such
        words need no pre-tokenizer: it cuts before the mark and around each line end."""
        if found := _PLAIN(chunk):
            word, mark = found.groups()
            if mark:
                return self.chunks[word] + self.words[mark]
            return self._word(self.space + self._spelled(word))
        lines = list(map(_PLAIN, chunk.split("\n")))
        if not all(lines):
            return self._ids(" " + chunk)
        packed = [self.chunks[lines[0][0]]]
        for found in lines[1:]:
            packed += [self.words[self.line_end], self.words[self._spelled(found[1])]]
            if found[2]:
                packed.append(self.words[found[2]])
        return b"".join(packed)

    def _spelled(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.spelling)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of each text, in order."""
        held: list[str] = []
        size = 0
        for text in texts:
            if held and (size + len(text) > CHARS_AT_ONCE or len(held) >= TEXTS_AT_ONCE):
                yield from self._together(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        yield from self._together(held)

    def _alone(self, text: str) -> bytes | None:
        """Of texts that do not fall into chunks."""
        if any(token in text for token in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return None if cuts_at_spaces(text) else self._ids(text)

    def _together(self, texts: list[str]) -> list[bytes]:
        out = [self._alone(t) for t in texts]
        rest = [k for k, packed in enumerate(out) if packed is None]
        if not rest:
            return out
        lists = pc.split_pattern(pa.array([texts[k] for k in rest], pa.large_string()), " ")
        found = lists.values.dictionary_encode()
        which, first = found.indices.to_numpy().astype(np.int64), lists.offsets.to_numpy()
        known = list(map(self.chunks.__getitem__, found.dictionary.to_pylist()))
        # the first chunk of a text has no space before it
        which[first[:-1]] = len(known) + np.arange(len(rest))
        known += [self._ids(c) for c in lists.values.take(pa.array(first[:-1])).to_pylist()]
        table = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        many = sizes[which]
        ends = np.concatenate([[0], np.cumsum(many)])
        ids = table[np.repeat(starts[which] - ends[:-1], many) + np.arange(ends[-1])]
        for k, a, b in zip(rest, ends[first[:-1]].tolist(), ends[first[1:]].tolist(), strict=True):
            out[k] = ids[a:b].tobytes()
        return out


@lru_cache(maxsize=1)
def _tokens(path: str, added: bool = False) -> _Tokens:
    return _Tokens(path, added)


PIECE = "struct<piece: int, start: long, length: long, ids_crc32: long, ids: binary>"


def cut(packed: bytes, capacity: int, end_id: int, with_ids: bool) -> list[dict]:
    """The pieces of a document's packed ids with the end id appended. Only longer documents
    than the capacity are cut, and all pieces but the first are then full."""
    packed += end_id.to_bytes(4, "little")
    n = len(packed) // 4
    extra = -(-n // capacity) - 1
    first = n - extra * capacity
    starts = [0, *range(first, n, capacity)]
    out = []
    for k, start in enumerate(starts):
        length = first if k == 0 else capacity
        ids = packed[4 * start : 4 * (start + length)]
        out.append({"piece": k, "start": start, "length": length, "ids_crc32": zlib.crc32(ids), "ids": ids if with_ids else None})
    return out


def token_pieces(
    text: Column, tokenizer_path: str, capacity: int, end_id: int = 0, with_ids: bool = False, added: bool = False
) -> Column:
    """The pieces of every whole text as an array of PIECE; a null text is an empty one.

    ids are little-endian unsigned 32-bit integers, left out unless asked for. added: the
    tokenizer's added tokens in a text get their own ids, else they are plain text.
    """

    @F.pandas_udf(f"array<{PIECE}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = _tokens(tokenizer_path, added)
        for batch in batches:
            packed = tokens.encode(batch.tolist())
            yield pd.Series([cut(ids, capacity, end_id, with_ids) for ids in packed], dtype=object)

    return run(F.coalesce(text, F.lit("")))


def enumerate_patterns(lengths: list[int], capacity: int) -> list[tuple[int, ...]]:
    """Patterns that fill a sequence as far as the lengths allow.

    Every length meets a bounded number of partners, spread over all lengths, in several
    mixtures of the two; then always the largest length that still fits closes the rest. Few
    documents make a pattern where they are long, more where they are short.
    """
    have = np.array(sorted(lengths))
    least = int(have[0]) if len(have) else 0
    partners = max(LEAST_PARTNERS, PARTNERS // max(len(have), 1))

    def closed(start: list[int]) -> tuple[int, ...]:
        space = capacity - sum(start)
        while space >= least:
            x = int(have[int(np.searchsorted(have, space, side="right")) - 1])
            start = start + [x] * (space // x)
            space %= x
        return tuple(sorted(start, reverse=True))

    patterns: set[tuple[int, ...]] = set()
    for k, x in enumerate(map(int, have)):
        patterns.add(closed([x]))
        room = have[have <= capacity - x]
        if not len(room):
            continue
        # other partners for each length, so that together they cover all
        spots = (np.linspace(0, len(room), partners, endpoint=False) + k) % len(room)
        for y in map(int, np.unique(room[spots.astype(int)])):
            for share in MIXTURES:
                many = max(int(capacity * share) // x, 1)
                rest = (capacity - many * x) // y
                patterns.add(closed([x] * many + [y] * rest))
                if rest > 1:
                    patterns.add(closed([x] * many + [y] * (rest - 1)))
    return sorted(patterns, reverse=True)


def fit_counts(histogram: dict[int, int], patterns: list[tuple[int, ...]]) -> np.ndarray:
    """Repeat counts by non-negative least squares, solved by coordinate descent.

    Minimises the squared difference between the histogram and what the patterns use.
    Patterns are visited from the fullest and those with the longest document, so that they win
    among equals: long documents have the fewest partners.
    """
    left = {k: float(v) for k, v in histogram.items()}
    counts = np.zeros(len(patterns))
    uses = []
    for pattern in patterns:
        times = Counter(pattern)
        uses.append((list(times.items()), float(sum(m * m for m in times.values()))))
    order = sorted(range(len(patterns)), key=lambda i: (-sum(patterns[i]), -patterns[i][0], len(patterns[i])))
    for _ in range(SWEEPS):
        moved = 0.0
        for i in order:
            times, norm = uses[i]
            step = max(sum(m * left[x] for x, m in times) / norm, -counts[i])
            if step:
                counts[i] += step
                moved += abs(step)
                for x, m in times:
                    left[x] -= m * step
        if moved < 0.001 * sum(histogram.values()):
            break
    return counts


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with repeat counts that use up the histogram exactly.

    Counts are fitted to what is left and rounded, round by round; only what rounding leaves
    is packed greedily. Counts are rounded to the nearest whole number or, where that comes
    out with fewer sequences, down: with few documents of a length most counts are near one.
    """
    plans = [_rounded(histogram, capacity, up) for up in (0.5, 0.0)]
    return min(plans, key=lambda chosen: sum(count for _, count in chosen))


def _rounded(histogram: dict[int, int], capacity: int, up: float) -> list[tuple[tuple[int, ...], int]]:
    left = {k: int(v) for k, v in histogram.items() if v}
    chosen: list[tuple[tuple[int, ...], int]] = []
    if full := left.pop(capacity, 0):
        chosen.append(((capacity,), full))
    chosen += fitted_patterns(left, capacity, up)
    while left:
        pattern, repeat = _greedy_pattern(left, capacity)
        _take(left, pattern, repeat)
        chosen.append((pattern, repeat))
    return chosen


def fitted_patterns(left: dict[int, int], capacity: int, up: float = 0.5) -> list[tuple[tuple[int, ...], int]]:
    """Fitted and rounded patterns; takes their documents out of `left`. Each round fits what the
    rounds before have left, with the patterns that waste next to nothing more than the best."""
    chosen: list[tuple[tuple[int, ...], int]] = []
    for long, share in [*((True, w) for w in LONG_WASTES), *((False, w) for w in WASTES)]:
        if not left:
            break
        patterns = enumerate_patterns(list(left), capacity)
        if long:
            patterns = [p for p in patterns if 2 * p[0] > capacity and len(p) <= LONG_PIECES]
            if not patterns:
                continue
        most = capacity - sum(max(patterns, key=sum)) + share * capacity
        patterns = [p for p in patterns if capacity - sum(p) <= most]
        fitted = fit_counts(left, patterns)
        for i in np.argsort(-fitted, kind="stable"):
            count = math.floor(fitted[i] + up)
            if count <= 0:
                break
            count = min(count, *(left.get(x, 0) // m for x, m in Counter(patterns[i]).items()))
            if count > 0:
                _take(left, patterns[i], count)
                chosen.append((patterns[i], count))
    return chosen


def _take(left: dict[int, int], pattern: tuple[int, ...], count: int) -> None:
    for x, m in Counter(pattern).items():
        left[x] -= m * count
        if left[x] == 0:
            del left[x]


def _greedy_pattern(left: dict[int, int], capacity: int) -> tuple[tuple[int, ...], int]:
    """The largest length left, then always the largest that still fits, and how often."""
    have = sorted(left)
    slots: list[int] = []
    space, used = capacity, {}
    while True:
        at = int(np.searchsorted(have, space, side="right")) - 1
        while at >= 0 and used.get(have[at], 0) >= left[have[at]]:
            at -= 1
        if at < 0:
            break
        x = have[at]
        fits = min(space // x, left[x] - used.get(x, 0))
        slots += [x] * fits
        used[x] = used.get(x, 0) + fits
        space -= x * fits
    return tuple(slots), min(left[x] // m for x, m in used.items())


def places(chosen: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the runs of ranks with one place: first rank, first sequence, offset."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    next_rank: dict[int, int] = {}
    sequence = 0
    for pattern, count in chosen:
        offset = 0
        for x in pattern:
            rank = next_rank.get(x, 0)
            runs.setdefault(x, []).append((rank, sequence, offset))
            next_rank[x] = rank + count
            offset += x
        sequence += count
    return {x: tuple(np.array(r, dtype=np.int64).T) for x, r in runs.items()}


def pack(pieces: DataFrame, capacity: int, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Adds sequence_id and offset to stored pieces of lengths from 1 to the capacity.

    Pieces of one length are alike to the plan; ties in `order` are placed in any order.
    Each (length, bucket) is ranked by itself and shifted by the counts of the buckets
    before it, so no task ever holds all pieces of a hot length. An empty frame gives an
    empty frame.
    """
    bucket, rank, base, count = fresh(pieces, "bucket", "rank", "base", "count")
    histogram = {r[0]: r[1] for r in pieces.groupBy(length).agg(F.count("*")).collect()}
    total = sum(histogram.values())
    buckets = max(LEAST_BUCKETS, math.ceil(total / PIECES_PER_BUCKET))
    chosen = places(plan(histogram, capacity))

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        size, at = sizes.to_numpy(), ranks.to_numpy()
        for x in np.unique(size):
            first, start, shift = chosen[int(x)]
            mine = size == x
            run = np.searchsorted(first, at[mine], side="right") - 1
            sequence[mine] = start[run] + at[mine] - first[run]
            offset[mine] = shift[run]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    dealt = pieces.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    shifts = (
        dealt.groupBy(length, bucket)
        .agg(F.count("*").alias(count))
        .withColumn(base, F.sum(count).over(Window.partitionBy(length).orderBy(bucket)) - F.col(count))
        .select(length, bucket, base)
    )
    ranked = dealt.withColumn(
        rank, F.row_number().over(Window.partitionBy(length, bucket).orderBy(*order)) - 1
    ).join(shifts, [length, bucket])
    placed, = fresh(pieces, "placed")
    return ranked.withColumn(placed, place(F.col(length), F.col(rank) + F.col(base))).select(
        *pieces.columns, f"{placed}.sequence_id", f"{placed}.offset"
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int, text: str = "text", key: str = "doc_id", added: bool = False
) -> DataFrame:
    """All documents as pieces with their places: key, piece, start, length, ids_crc32,
    sequence_id, offset.

    Null and empty texts are one piece that holds only the end id. Repeated rows are packed
    as often as they stand there. Other columns are left out. added: see token_pieces().
    """
    cut_up = token_pieces(F.col(text), tokenizer_path, capacity, added=added)
    pieces = docs.select(F.col(key).alias("doc_id"), F.explode(cut_up).alias("p")).select("doc_id", "p.*").drop("ids")
    return pack(stored(pieces, "pieces"), capacity).withColumnRenamed("doc_id", key)
