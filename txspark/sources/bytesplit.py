"""Data source `bytesplit`: one text file that was cut into parts at byte positions.

The parts, in name order, are one virtual file. Spark partitions are byte ranges of that
virtual file, whatever the part borders: a task emits every line that *starts* in its range
and reads on past the range, across part borders, to finish the last one. So a record cut
in two, inside a line ending or inside a character, comes back whole; no task holds more
than one block, and nothing passes through the driver but names and sizes.

Executors pickle this module by value and need no installed package. It therefore
uses nothing but numpy, pyarrow and pyspark's public data source API.

A part is known by name, size and time of modification, and by samples of its bytes where a
stored listing has them; one that was replaced is an error, also by bytes of the same number.

Options: `pattern` (part names), `rangeBytes` (size of a Spark partition; by default it
follows the input size and `cores`), `header` (skip the first line), `withPosition` (add each
line's byte position), `listing` (fingerprint of the parts that must be there, no more and
no less), `stored` (folder of a stored listing, so that ranges carry no names), and for streams `flush` (emit a last record that has no line end) and
`maxBytesPerTrigger` (how much one micro-batch takes, at least one line) and `until` (an end
taken by `end_offset`, beyond which the stream does not go).
"""

from __future__ import annotations

import csv
import fnmatch
import hashlib
import json
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

PATTERN = "part_*.csv"
MIN_RANGE_BYTES = 1 << 20
MAX_RANGE_BYTES = 128 << 20
BLOCK_BYTES = 4 << 20
# Past its range a task only needs the rest of one line, so it reads in small steps.
TAIL_BYTES = 64 << 10
# A range carries the names of its own parts and of those just behind it. A line that
# reaches further makes the task list the folder itself.
LOOKAHEAD_BYTES = 1 << 20

# Text offsets within a batch are 32 bits wide.
MAX_TEXT_BYTES = (1 << 31) - 1

BOM = b"\xef\xbb\xbf"


SAMPLE_BYTES = 4096


class Part:
    """A part file and its place in the virtual file. modified: nanoseconds, 0 if not known;
    sample: see `sample_of`, empty if none was taken."""

    def __init__(self, name: str, start: int, size: int, modified: int = 0, sample: str = "") -> None:
        self.name, self.start, self.size = name, start, size
        self.modified, self.sample = modified, sample

    @property
    def fields(self) -> tuple[str, int, int, int, str]:
        return self.name, self.start, self.size, self.modified, self.sample

    @property
    def end(self) -> int:
        return self.start + self.size


def open_filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a local path or a URI (file, s3, gs, hdfs, ...)."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    return pafs.FileSystem.from_uri(f"{scheme}://{rest}")


def find_parts(path: str, pattern: str = PATTERN) -> list[Part]:
    """The part files directly in `path`, in name order; an error if there are none."""
    files, base = open_filesystem(path)
    found = files.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    known = {
        f.base_name: f
        for f in found
        if f.type == pafs.FileType.File and fnmatch.fnmatchcase(f.base_name, pattern)
    }
    if not known:
        raise FileNotFoundError(f"Nothing in {path} is named like {pattern}")
    names = sorted(known)
    ends = accumulate(known[n].size for n in names)
    return [Part(n, end - known[n].size, known[n].size, known[n].mtime_ns or 0) for n, end in zip(names, ends)]


def fingerprint(parts: Sequence[Part]) -> str:
    """A short text that changes when a part is added, renamed, resized or written anew."""
    digest = hashlib.sha256()
    for p in parts:
        digest.update(f"{p.name}\t{p.size}\t{p.modified}\n".encode())
    return digest.hexdigest()


def sample_of(handle: pa.NativeFile, size: int) -> str:
    """A digest of the first, the middle and the last bytes of a file."""
    digest = hashlib.sha256()
    for at in sorted({0, max(size // 2 - SAMPLE_BYTES // 2, 0), max(size - SAMPLE_BYTES, 0)}):
        digest.update(handle.read_at(min(SAMPLE_BYTES, size - at), at))
    return digest.hexdigest()


class StoredParts:
    """A listing in storage: blocks of parts in order of position, and an index of the blocks'
    first positions. A task reads the index and the blocks that it needs, whatever their number."""

    def __init__(self, path: str) -> None:
        self.files, self.base = open_filesystem(path.rstrip("/"))
        index = pq.read_table(f"{self.base}/index.parquet", filesystem=self.files)
        self.first = index.column("first").to_numpy()
        self.blocks = index.column("block").to_pylist()
        known = {k.decode(): v.decode() for k, v in (index.schema.metadata or {}).items()}
        self.total, self.count, self.fingerprint = int(known["total"]), int(known["parts"]), known["fingerprint"]

    def at(self, position: int) -> list[Part]:
        """The block of parts that holds a position."""
        k = max(int(np.searchsorted(self.first, position, side="right")) - 1, 0)
        table = pq.read_table(f"{self.base}/{self.blocks[k]}", filesystem=self.files)
        return [Part(*row) for row in zip(*(c.to_pylist() for c in table.columns), strict=True)]


def range_bytes(total: int, cores: int) -> int:
    """Range size: all cores busy on small input, 128 MB on large. A task streams its range;
    set rangeBytes for longer tasks on very large input."""
    even = -(-total // (3 * cores))
    return min(max(even, MIN_RANGE_BYTES), MAX_RANGE_BYTES)


def plan_ranges(
    parts: Sequence[Part] | None, start: int, end: int, range_bytes: int
) -> list[InputPartition]:
    """Cut [start, end) into ranges. `start` must be the start of a line. Without parts the
    ranges carry no names: tasks look them up in a stored listing."""
    if parts is None:
        cuts = [(a, min(a + range_bytes, end)) for a in range(start, end, range_bytes)]
        return [InputPartition((a, b, end, a == start, None)) for a, b in cuts]
    ranges = []
    first = 0
    for a in range(start, end, range_bytes):
        b = min(a + range_bytes, end)
        begin = a if a == start else a - 1
        while first < len(parts) and parts[first].end <= begin:
            first += 1
        last = first
        while last < len(parts) and parts[last].start < min(b + LOOKAHEAD_BYTES, end):
            last += 1
        held = [p.fields for p in parts[first:last]]
        ranges.append(InputPartition((a, b, end, a == start, held)))
    return ranges


class VirtualFile:
    """Sequential reads of the concatenated parts, given or from a stored listing."""

    def __init__(
        self, path: str, pattern: str, parts: Sequence[Part], end: int, stored: StoredParts | None = None
    ) -> None:
        self.files, self.base = open_filesystem(path)
        self.path, self.pattern, self.end = path, pattern, end
        self.parts, self.stored = list(parts), stored
        self.verified: set[str] = set()

    def _find(self, position: int) -> None:
        """Make `parts` hold a position: from the stored listing or, for a line longer than
        the names a range carries, from a new one."""
        if self.stored is not None:
            self.parts = self.stored.at(position)
            return
        known = {p.name: p for p in self.parts}
        listed = [p for p in find_parts(self.path, self.pattern) if p.start < self.end]
        same = all(
            (p.start, p.size, p.modified) == (known[p.name].start, known[p.name].size, known[p.name].modified)
            for p in listed
            if p.name in known
        )
        if not same or listed[-1].end < self.end:
            raise OSError(f"Parts in {self.path} changed while they were read")
        self.parts = listed

    def _verify(self, part: Part, handle: pa.NativeFile) -> None:
        """An error if a part is not the one that was listed; looked at once by a task."""
        if part.name in self.verified:
            return
        now = self.files.get_file_info(f"{self.base}/{part.name}")
        same = handle.size() == part.size and part.modified in (0, now.mtime_ns or 0)
        if not same or part.sample and sample_of(handle, part.size) != part.sample:
            raise OSError(f"{part.name} has changed since it was listed")
        self.verified.add(part.name)

    def blocks(self, position: int, stop: int, step: int) -> Iterator[bytes]:
        """The bytes in [position, stop), at most `step` at a time."""
        stop = min(stop, self.end)
        while position < stop:
            if not self.parts or self.parts[-1].end <= position or self.parts[0].start > position:
                self._find(position)
            for part in self.parts:
                part_stop = min(part.end, stop)
                if part_stop <= position:
                    continue
                with self.files.open_input_file(f"{self.base}/{part.name}") as handle:
                    self._verify(part, handle)
                    while position < part_stop:
                        want = min(step, part_stop - position)
                        data = handle.read_at(want, position - part.start)
                        if len(data) != want:
                            raise OSError(f"{part.name} has changed since it was listed")
                        position += want
                        yield data


def _line_ends(block: bytes) -> np.ndarray:
    """Positions of CR and LF. The empty line between the two of a pair is dropped later,
    like every other empty line."""
    data = np.frombuffer(block, np.uint8)
    breaks = data == 10
    if b"\r" in block:
        breaks |= data == 13
    return np.flatnonzero(breaks)


def _pack(block: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Lines as one Arrow array, without a Python object per line."""
    region = np.frombuffer(block, np.uint8)[starts[0] : ends[-1]]
    if len(starts) > 1:
        text = region[(region != 10) & (region != 13)]
    else:
        text = region
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    if offsets[-1] > MAX_TEXT_BYTES:
        raise ValueError("A line is longer than 2 GB")
    buffers = [pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text)]
    lines = pa.StringArray.from_buffers(len(starts), *buffers)
    lines.validate(full=True)  # raises on text that is not UTF-8
    return lines


def _gather(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """Join the small blocks that short parts give, so that batches stay large."""
    held: list[bytes] = []
    size = 0
    for block in blocks:
        held.append(block)
        size += len(block)
        if size >= BLOCK_BYTES // 2:
            yield b"".join(held) if len(held) > 1 else block
            held, size = [], 0
    if held:
        yield b"".join(held)


def read_range(
    source: VirtualFile, start: int, end: int, at_line_start: bool
) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Positions and texts of the non-empty lines that start in [start, end)."""
    position = start if at_line_start else start - 1
    skipping = not at_line_start
    pending: list[bytes] = []
    inside = _gather(source.blocks(position, end, BLOCK_BYTES))
    behind = source.blocks(end, source.end, TAIL_BYTES)
    for block in chain(inside, behind):
        ends = _line_ends(block)
        if ends.size == 0:
            if skipping:
                position += len(block)
                if position >= end:
                    return
            else:
                pending.append(block)
            continue
        if skipping:
            cut = int(ends[0]) + 1
            block, ends = block[cut:], ends[1:] - cut
            position, skipping = position + cut, False
        elif pending:
            ends = ends + sum(map(len, pending))
            block = b"".join([*pending, block])
        pending = []
        rest = int(ends[-1]) + 1 if ends.size else 0
        if rest:
            starts = np.concatenate([[0], ends[:-1] + 1])
            keep = (ends > starts) & (position + starts < end)
            if keep.any():
                starts, ends = starts[keep], ends[keep]
                yield position + starts, _pack(block, starts, ends)
        position += rest
        if position >= end:
            return
        if rest < len(block):
            pending = [block[rest:]]
    if pending and not skipping:
        tail = b"".join(pending)
        yield np.array([position]), _pack(tail, np.array([0]), np.array([len(tail)]))


def read_header(
    path: str, pattern: str = PATTERN, parts: Sequence[Part] | None = None
) -> tuple[str, int]:
    """The first non-empty line, and the position just behind it."""
    parts = parts or find_parts(path, pattern)
    total = parts[-1].end
    source = VirtualFile(path, pattern, parts, total)
    begin = len(BOM) if _peek(source, 0, len(BOM)) == BOM else 0
    seen = b""
    for block in source.blocks(begin, total, TAIL_BYTES):
        seen += block
        text = seen.lstrip(b"\r\n")
        ends = _line_ends(text)
        if ends.size:
            size = int(ends[0])
            return text[:size].decode(), begin + len(seen) - len(text) + size + 1
    return seen.strip(b"\r\n").decode(), total


def _peek(source: VirtualFile, position: int, size: int) -> bytes:
    return b"".join(source.blocks(position, position + size, size))


def split_header(line: str) -> list[str]:
    """Column names of a header line."""
    names = next(csv.reader([line]), [])
    if len(set(names)) != len(names):
        raise ValueError(f"Repeated column names in header: {names}")
    return names


def last_line_end(path: str, pattern: str, parts: Sequence[Part], floor: int) -> int:
    """The position behind the last line end, or `floor` if none follows it."""
    high = parts[-1].end
    step = TAIL_BYTES
    while high > floor:
        low = max(floor, high - step)
        data = _peek(VirtualFile(path, pattern, parts, high), low, high - low)
        ends = _line_ends(data)
        if ends.size:
            return low + int(ends[-1]) + 1
        high, step = low, min(step * 2, BLOCK_BYTES)
    return floor


class _Options:
    def __init__(self, options: dict[str, str]) -> None:
        if not options.get("path"):
            raise ValueError("bytesplit needs a folder: load(path)")
        self.path = options["path"].rstrip("/")
        self.pattern = options.get("pattern", PATTERN)
        self.fixed_range = int(options.get("rangeBytes", 0))
        self.cores = max(int(options.get("cores", 1)), 1)
        if self.fixed_range < 0:
            raise ValueError("rangeBytes must be positive")
        self.listing = options.get("listing")
        self.stored = options.get("stored")
        self.most = int(options.get("maxBytesPerTrigger", 0))
        self.until = json.loads(options["until"]) if options.get("until") else None
        self.header = options.get("header", "true").lower() == "true"
        self.flush = options.get("flush", "false").lower() == "true"
        self.with_position = options.get("withPosition", "false").lower() == "true"

    def parts(self) -> list[Part]:
        return find_parts(self.path, self.pattern)

    def ranges(self, parts: Sequence[Part] | None, start: int, end: int) -> list[InputPartition]:
        size = self.fixed_range or range_bytes(end - start, self.cores)
        return plan_ranges(parts, start, end, size)

    def file(self, held: Sequence[tuple] | None, end: int) -> VirtualFile:
        """What a task reads from."""
        if held is None:
            return VirtualFile(self.path, self.pattern, [], end, StoredParts(self.stored))
        return VirtualFile(self.path, self.pattern, [Part(*h) for h in held], end)

    def data_start(self, parts: Sequence[Part]) -> int:
        if self.header:
            return read_header(self.path, self.pattern, parts)[1]
        source = VirtualFile(self.path, self.pattern, parts, parts[-1].end)
        return len(BOM) if _peek(source, 0, len(BOM)) == BOM else 0


class _RangeReader:
    """What the batch and the stream reader do on executors."""

    def __init__(self, options: _Options) -> None:
        self.options = options

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        start, end, stream_end, at_line_start, held = partition.value
        opts = self.options
        source = opts.file(held, stream_end)
        for positions, lines in read_range(source, start, end, at_line_start):
            if opts.with_position:
                columns = {"pos": pa.array(positions, pa.int64()), "value": lines}
            else:
                columns = {"value": lines}
            yield pa.RecordBatch.from_pydict(columns)


class ByteSplitReader(_RangeReader, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        parts = self.options.parts()
        if self.options.listing not in (None, fingerprint(parts)):
            raise OSError(f"Parts in {self.options.path} changed since they were listed")
        start = self.options.data_start(parts)
        if self.options.stored:
            kept = StoredParts(self.options.stored)
            if kept.fingerprint != fingerprint(parts):
                raise OSError(f"Parts in {self.options.path} changed since they were listed")
            parts = None
            ranges = self.options.ranges(None, start, kept.total)
        else:
            ranges = self.options.ranges(parts, start, parts[-1].end)
        return ranges or [InputPartition((0, 0, 0, True, []))]


class ByteSplitStreamReader(_RangeReader, DataSourceStreamReader):
    """New parts as they arrive, in name order.

    An offset is a position in the virtual file, always behind a line end: a record cut by
    the newest part's end waits for the next part. The offset also carries a fingerprint of
    the parts it covers, whose size does not grow with their number, so that a part which
    changed or arrived out of order is an error and never silently wrong data.
    """

    def __init__(self, options: _Options) -> None:
        super().__init__(options)
        self._data_start: int | None = None
        self._reached: int | None = None  # the last position given out in this run
        self._planned: dict | None = None  # the last offset Spark has planned up to

    def _floor(self, parts: Sequence[Part]) -> int:
        """Where data starts, found once the header line is complete."""
        if self._data_start is None:
            position = self.options.data_start(parts)
            if position < parts[-1].end:
                self._data_start = position
            return position
        return self._data_start

    def initialOffset(self) -> dict:
        return self._offset(self._floor(self.options.parts()), [], False)

    def _in_sight(self) -> list[Part]:
        """The parts up to the fixed end, or all."""
        parts, until = self.options.parts(), self.options.until
        if until is None:
            return parts
        parts = parts[: until["parts"]]
        if fingerprint(parts) != until["fingerprint"]:
            raise ValueError("Since the end of this run was fixed, a part has changed or a new part sorts before it")
        return parts

    def latestOffset(self) -> dict:
        """What the next batch may reach: never behind what is done, never beyond a fixed end."""
        found = self._latest(self._in_sight())
        if self._planned and found["position"] <= self._planned["position"] and not found["unfinished"]:
            return self._planned
        return found

    def _latest(self, parts: Sequence[Part]) -> dict:
        opts = self.options
        floor = self._floor(parts)
        position = last_line_end(opts.path, opts.pattern, parts, floor)
        total = max(parts[-1].end, floor)
        if opts.most:
            begin = max(floor, self._reached if self._reached is not None else floor)
            if position - begin > opts.most:
                self._reached = self._cut(parts, begin, position)
                covered = [p for p in parts if p.start < self._reached]
                return self._offset(self._reached, covered, False)
            self._reached = position
        if opts.flush and position < total:
            return self._offset(total, parts, True)
        return self._offset(position, parts, False)

    def _cut(self, parts: Sequence[Part], begin: int, end: int) -> int:
        """The end of the last line that fits in a trigger, or of the first one."""
        opts = self.options
        stop = begin + opts.most
        source = VirtualFile(opts.path, opts.pattern, parts, end)
        high = stop
        while high > begin:
            low = max(begin, high - TAIL_BYTES)
            ends = _line_ends(_peek(source, low, high - low))
            if ends.size:
                return low + int(ends[-1]) + 1
            high = low
        position = stop
        for block in source.blocks(stop, end, TAIL_BYTES):
            ends = _line_ends(block)
            if ends.size:
                return position + int(ends[0]) + 1
            position += len(block)
        return end

    @staticmethod
    def _offset(position: int, parts: Sequence[Part], unfinished: bool) -> dict:
        return {
            "position": position,
            "parts": len(parts),
            "fingerprint": fingerprint(parts),
            "unfinished": unfinished,
        }

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        parts = self.options.parts()
        self._reached = max(self._reached or 0, end["position"])
        if self._planned is None or end["position"] >= self._planned["position"]:
            self._planned = end
        for offset in (start, end):
            if fingerprint(parts[: offset["parts"]]) != offset["fingerprint"]:
                raise ValueError(
                    "A part that was already read has changed, or a new part sorts before it"
                )
        if start["unfinished"] and end["position"] > start["position"]:
            raise ValueError("More bytes arrived after the last record had been flushed")
        covered = parts[: end["parts"]]
        # An offset taken while the header was incomplete lies inside the header.
        begin = max(start["position"], self._floor(covered))
        return self.options.ranges(covered, begin, end["position"])


def end_offset(path: str, pattern: str = PATTERN, **options: object) -> str:
    """The end of what lies in `path` now, for the option `until`: a stream with this end takes
    these parts, in as many batches as its limit makes, and no part that arrives later."""
    texts = {k: str(v) for k, v in options.items() if k not in ("maxBytesPerTrigger", "until")}
    return json.dumps(ByteSplitStreamReader(_Options(texts | {"path": path, "pattern": pattern})).latestOffset())


class ByteSplitSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bytesplit"

    def schema(self) -> str:
        return "pos bigint, value string" if self._opts.with_position else "value string"

    @property
    def _opts(self) -> _Options:
        return _Options(self.options)

    def reader(self, schema) -> DataSourceReader:
        return ByteSplitReader(self._opts)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ByteSplitStreamReader(self._opts)
