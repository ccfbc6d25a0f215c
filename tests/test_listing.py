"""Stored listings, and parts that are replaced."""

from __future__ import annotations

import os
import pickle
import random
from pathlib import Path

import pytest
from conftest import HEADER, csv_line, raw_row
from test_bytesplit import expected_lines, write_parts

from txspark.sources import bytesplit
from txspark.sources.bytesplit import Part, StoredParts, VirtualFile, find_parts, plan_ranges, read_range
from txspark.sources.ingest import ingest
from txspark.sources.lines import read_lines, read_transactions, stream_lines
from txspark.sources.listing import read_listing, store_listing, with_samples
from txspark.streaming import live


def test_a_hundred_thousand_parts_cost_a_task_nothing(tmp_path):
    rng = random.Random(0)
    parts, at = [], 0
    for i in range(100_000):
        parts.append(Part(f"part_{i:08d}.csv", at, rng.choice([0, 700, 10_000]), i + 1))
        at = parts[-1].end
    path = store_listing(parts, str(tmp_path))
    stored = StoredParts(path)
    assert (stored.total, stored.count) == (at, 100_000)
    plan = plan_ranges(None, 5, at, 1 << 20)
    assert len(plan) > 300 and max(len(pickle.dumps(p)) for p in plan) < 200
    assert [p.value[:2] for p in plan] == [p.value[:2] for p in plan_ranges(parts, 5, at, 1 << 20)]
    for position in [0, at - 1, *(rng.randrange(at) for _ in range(200))]:
        found = [p for p in stored.at(position) if p.start <= position < p.end]
        assert [p.fields for p in found] == [p.fields for p in parts if p.start <= position < p.end]
    for _ in range(3):
        held = stored.at(rng.randrange(at))
        assert len(held) <= 4096


@pytest.mark.parametrize("per_block", [1, 2, 5, 1000])
def test_reading_by_a_stored_listing(tmp_path, monkeypatch, per_block):
    monkeypatch.setattr(bytesplit, "BLOCK_BYTES", 16)
    monkeypatch.setattr(bytesplit, "TAIL_BYTES", 5)
    folder = tmp_path / "in"
    folder.mkdir()
    content = "".join(f"row {i},{'é' * (i % 9)}\r\n" for i in range(60)).encode() + b"x" * 300 + b"\nlast"
    write_parts(folder, content, [0, 0, 5, 5, 6, 100, 101, 333, 500, 510, 520, len(content)])
    parts = find_parts(str(folder))
    stored = StoredParts(store_listing(parts, str(tmp_path / "kept"), per_block))
    for size in (3, 40, 10_000):
        lines = []
        for p in plan_ranges(None, 0, parts[-1].end, size):
            a, b, end, at_start, held = p.value
            assert held is None
            source = VirtualFile(str(folder), "part_*.csv", [], end, stored)
            for _, text in read_range(source, a, b, at_start):
                lines += text.to_pylist()
        assert lines == expected_lines(content)


def rows_of(n: int) -> str:
    return "\n".join([HEADER, *(csv_line(raw_row(login_frequency=i % 8, session_duration=i)) for i in range(n))]) + "\n"


def test_ingest_keeps_its_listing(spark, parts_dir, tmp_path):
    data = rows_of(200)
    folder = parts_dir(data[:900], data[900:901], "", data[901:])
    meta = ingest(spark, folder, str(tmp_path / "raw"), sampled=True).first()
    assert (meta["row_count"], meta["file_count"], meta["bytes_read"]) == (200, 4, len(data))
    (kept,) = (tmp_path / "raw-parts").iterdir()
    listed = read_listing(spark, str(kept)).orderBy("name").collect()
    assert [(r["start"], r["size"]) for r in listed] == [(0, 900), (900, 1), (901, 0), (901, len(data) - 901)]
    assert all(len(r["sample"]) == 64 for r in listed)
    got = spark.read.parquet(str(tmp_path / "raw"))
    assert got.exceptAll(read_transactions(spark, folder)).isEmpty() and got.count() == 200


def swap(part: Path, keep_time: bool) -> None:
    """Other bytes, the same number of them."""
    before = part.stat()
    part.write_bytes(bytes(reversed(part.read_bytes())))
    shift = 0 if keep_time else 1_000_000_000
    os.utime(part, ns=(before.st_atime_ns, before.st_mtime_ns + shift))


def test_a_part_replaced_by_one_of_the_same_size_is_an_error(spark, parts_dir, tmp_path):
    folder = parts_dir("h\na1\n", "b2\nc3\n")
    parts = find_parts(folder)
    planned = read_lines(spark, folder, listing=bytesplit.fingerprint(parts))
    kept = store_listing(parts, str(tmp_path / "kept"))
    by_listing = read_lines(spark, folder, stored=kept)
    assert by_listing.count() == planned.count() == 3
    source = VirtualFile(folder, "part_*.csv", parts, parts[-1].end)
    swap(Path(folder, "part_001.csv"), keep_time=False)
    for df in (planned, by_listing):
        with pytest.raises(Exception, match="changed since"):
            df.count()
    with pytest.raises(OSError, match="part_001.csv has changed"):
        list(read_range(source, 0, parts[-1].end, True))


def test_samples_find_a_replacement_of_the_same_time(spark, parts_dir, tmp_path):
    folder = parts_dir("h\na1\n", "b2\nc3\n")
    parts = with_samples(spark, folder, find_parts(folder))
    by_listing = read_lines(spark, folder, stored=store_listing(parts, str(tmp_path / "kept")))
    assert by_listing.count() == 3
    swap(Path(folder, "part_001.csv"), keep_time=True)
    with pytest.raises(Exception, match="part_001.csv has changed"):
        by_listing.count()


def test_samples_look_at_both_ends_and_the_middle(tmp_path):
    files, base = bytesplit.open_filesystem(str(tmp_path))
    data = bytearray(random.Random(1).randbytes(50_000))

    def sample() -> str:
        (tmp_path / "f").write_bytes(bytes(data))
        with files.open_input_file(f"{base}/f") as handle:
            return bytesplit.sample_of(handle, len(data))

    first = sample()
    for at in (0, 25_000, 49_999):
        data[at] ^= 1
        assert sample() != first
        data[at] ^= 1
    assert sample() == first


def test_a_stream_notices_a_replaced_part(spark, parts_dir, tmp_path):
    folder = parts_dir("h\na1\n", "b2\n")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        writer = stream_lines(spark, folder).writeStream.format("parquet").option("checkpointLocation", checkpoint)
        live.started(writer, out).awaitTermination()
        return spark.read.schema("value string").parquet(out).count()

    assert run() == 2
    swap(Path(folder, "part_001.csv"), keep_time=False)
    with pytest.raises(Exception, match="has changed"):
        run()
