"""Which of some 32-byte keys a run holds: a Bloom filter first, then the exact answer.

Executors pickle this module by value, so it uses nothing but numpy, pyarrow and the
shared file access.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow.parquet as pq
from pyarrow import fs as pafs

from txspark.sources.bytesplit import open_filesystem

KEY_BYTES = 32
BITS_PER_KEY = 10
PROBES = 7


def as_keys(values) -> np.ndarray:
    """Keys as an array of words; they are SHA-256 values, so their own bytes serve as hashes."""
    return np.frombuffer(b"".join(map(bytes, values)), np.dtype((np.void, KEY_BYTES)))


def _positions(keys: np.ndarray, size: int) -> np.ndarray:
    words = keys.view(np.uint64).reshape(-1, KEY_BYTES // 8)
    steps = np.arange(PROBES, dtype=np.uint64)
    return (words[:, :1] + steps * (words[:, 1:2] | np.uint64(1))) % np.uint64(size)


def bloom(keys: np.ndarray) -> bytes:
    """A Bloom filter of ten bits a key: about one key in a hundred is taken for held."""
    size = max(64, -(-len(keys) * BITS_PER_KEY // 8) * 8)
    bits = np.zeros(size, bool)
    bits[_positions(keys, size).ravel()] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, keys: np.ndarray) -> np.ndarray:
    packed = np.frombuffer(bits, np.uint8)
    at = _positions(keys, len(packed) * 8)
    return ((packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def files_of(folder: str, bucket: int) -> list[str]:
    """Data files of one bucket, as inner paths of the folder's file system."""
    files, base = open_filesystem(folder)
    found = files.get_file_info(pafs.FileSelector(f"{base}/bucket={bucket}", allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.endswith(".parquet") and not f.base_name.startswith((".", "_")))


def filter_of(folder: str, bucket: int) -> bytes | None:
    """The Bloom filter of one bucket; None where the run has no key in it."""
    files, _ = open_filesystem(folder)
    for path in files_of(folder, bucket):
        return pq.read_table(path, filesystem=files, columns=["bits"], partitioning=None).column(0)[0].as_py()
    return None


def held(folder: str, bucket: int, column: str, keys: np.ndarray) -> np.ndarray:
    """Exactly which keys one bucket of a run holds. Files are sorted by key, so only row
    groups whose range holds a key are read, and of these only the key column."""
    files, _ = open_filesystem(folder)
    wanted = sorted(k.tobytes() for k in keys)
    seen: set[bytes] = set()
    for path in files_of(folder, bucket):
        with files.open_input_file(path) as handle:
            source = pq.ParquetFile(handle)
            at = source.schema_arrow.names.index(column)
            for g in range(source.num_row_groups):
                stats = source.metadata.row_group(g).column(at).statistics
                if stats is not None and stats.has_min_max:
                    k = bisect_left(wanted, bytes(stats.min))
                    if k == len(wanted) or wanted[k] > bytes(stats.max):
                        continue
                found = source.read_row_group(g, columns=[column]).column(0)
                seen.update(set(wanted).intersection(found.to_pylist()))
    return np.array([k.tobytes() in seen for k in keys], bool)


def unseen(keys: np.ndarray, bucket: int, runs: list[tuple[str, str]], column: str) -> np.ndarray:
    """True for keys that no run holds. runs: folders of each run's data and of its filters."""
    fresh = np.ones(len(keys), bool)
    for data, filters in runs:
        bits = filter_of(filters, bucket)
        if bits is None:
            continue
        open_ = np.flatnonzero(fresh)
        hits = open_[may_hold(bits, keys[open_])]
        if len(hits):
            fresh[hits[held(data, bucket, column, keys[hits])]] = False
    return fresh
