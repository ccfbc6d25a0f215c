"""Reading by Spark's own file access gives what the byte-split source gives."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from conftest import HEADER, csv_line, raw_row
from test_bytesplit import write_parts

from txspark.sources import lines as by_range
from txspark.sources import wholefiles


def positions(df):
    return sorted((r["pos"], r["value"]) for r in df.collect())


CASES = [
    b"h\na1\nb2\n",
    b"\xef\xbb\xbfh1,h2\r\n\r\n1,x\r\n2,\xc3\xa9\xe6\xbc\xa2\r\n\n\n3,z",
    b"\n\r\n\nh\n" + b"x" * 90 + b"\n\n" + b"y" * 40 + b"\rz",
    b"h",
    b"h\n",
    b"header only, no end",
]


@pytest.mark.parametrize("content", CASES)
@pytest.mark.parametrize("seed", [0, 1])
def test_same_lines_for_any_cutting(spark, tmp_path, content, seed):
    rng = random.Random(seed)
    cuts = [rng.randrange(len(content) + 1) for _ in range(rng.choice([0, 3, 12]))]
    write_parts(tmp_path, content, cuts)
    got = wholefiles.read_lines(spark, str(tmp_path), with_position=True)
    assert positions(got) == positions(by_range.read_lines(spark, str(tmp_path), withPosition="true"))


def test_every_byte_a_part(spark, tmp_path):
    content = "h\r\naé\r\n\nb\r\nlast".encode()
    write_parts(tmp_path, content, list(range(1, len(content))))
    assert sorted(r.value for r in wholefiles.read_lines(spark, str(tmp_path)).collect()) == ["aé", "b", "last"]


def test_transactions(spark, parts_dir):
    data = "\n".join([HEADER, *(csv_line(raw_row(session_duration=i)) for i in range(60))])
    folder = parts_dir(data[:300], data[300:301], data[301:2000], "", data[2000:])
    got, expected = wholefiles.read_transactions(spark, folder), by_range.read_transactions(spark, folder)
    assert got.schema == expected.schema and got.count() == 60
    assert got.exceptAll(expected).isEmpty()


def test_errors(spark, tmp_path, parts_dir):
    with pytest.raises(FileNotFoundError):
        wholefiles.read_lines(spark, str(tmp_path), "part_*.csv").count()
    with pytest.raises(ValueError, match="no line"):
        wholefiles.read_lines(spark, parts_dir("\n", "\r\n"))
    folder = parts_dir("h\na\n", "b\n")
    lines = wholefiles.read_lines(spark, folder)
    assert lines.count() == 2
    Path(folder, "part_001.csv").write_text("longer\n")
    with pytest.raises(Exception, match="has changed"):
        lines.count()
    for broken in (b"h\nok\n\xff\xfe\n", b"h\nok\n\xff"):
        (tmp_path / "part_000.csv").write_bytes(broken)
        with pytest.raises(Exception, match="(?i)utf"):
            wholefiles.read_lines(spark, str(tmp_path)).collect()
