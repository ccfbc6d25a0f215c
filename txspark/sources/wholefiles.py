"""Lines of a byte-split file by Spark's own file access.

`bytesplit` opens parts with pyarrow, which knows local paths and the common object stores. This is
for stores that only Spark can open, by its Hadoop settings, credentials or mounts. Spark's
binary file source hands each part to a task, which gives out the lines that lie whole in it; what
a part begins and ends with is put together across part borders in a second, small step.

A part is the unit of work here, so it must fit in a task (2 GB at most), and parts are read twice,
once for their ends. Where pyarrow can open the store, `bytesplit` is the better way.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txspark.schema import RAW_SCHEMA
from txspark.session import new_shared_dir
from txspark.sources import bytesplit
from txspark.sources.bytesplit import PATTERN, split_header
from txspark.sources.lines import parse_csv

# What a part holds outside its whole lines: its beginning up to the first line end, its end behind
# the last one, or all of it where it has no line end.
_HEAD, _TAIL, _THROUGH = 0, 1, 2
_ENDS = "part long, kind int, pos long, value binary, first_pos long, first binary"


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def _listed(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, part, start, size) in name order, as small as a listing; empty parts hold nothing."""
    found = _files(spark, path, pattern).select("path", "length").collect()
    if not found:
        raise FileNotFoundError(f"Nothing in {path} is named like {pattern}")
    rows, at = [], 0
    for number, r in enumerate(sorted(found, key=lambda r: r["path"].rsplit("/", 1)[1])):
        rows.append((r["path"], number, at, r["length"]))
        at += r["length"]
    return spark.createDataFrame(rows, "path string, part long, start long, size long")


def _parts(spark: SparkSession, path: str, pattern: str, listed: DataFrame) -> DataFrame:
    # the listing is on the driver already
    return _files(spark, path, pattern).join(F.broadcast(listed), "path").select("part", "start", "size", "content")


def _cut(content: bytes, size: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Line ends, and those of them behind which a whole, non-empty line stands."""
    if len(content) != size:
        raise OSError("A part has changed since it was listed")
    ends = bytesplit._line_ends(content)
    return ends, np.flatnonzero(np.diff(ends) > 1)


def _ends_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for part, start, size, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ends, whole = _cut(content, size, start)
            if not len(ends):
                rows.append((part, _THROUGH, start, content, None, None))
                continue
            first = (None, None)
            if len(whole):
                a, b = int(ends[whole[0]]) + 1, int(ends[whole[0] + 1])
                first = (start + a, content[a:b])
            last = int(ends[-1]) + 1
            rows.append((part, _HEAD, start, content[: int(ends[0])], *first))
            rows.append((part, _TAIL, start + last, content[last:], None, None))
        names = ["part", "kind", "pos", "value", "first_pos", "first"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, start, size, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ends, whole = _cut(content, size, start)
            if len(whole):
                a, b = ends[whole] + 1, ends[whole + 1]
                block = np.frombuffer(content, np.uint8)
                keep = np.zeros(len(block) + 1, np.int64)
                np.add.at(keep, a, 1)
                np.add.at(keep, b, -1)
                text = block[np.cumsum(keep[:-1]) > 0]
                offsets = np.concatenate([[0], np.cumsum(b - a)]).astype(np.int32)
                lines = pa.StringArray.from_buffers(len(a), pa.py_buffer(offsets), pa.py_buffer(text))
                lines.validate(full=True)  # raises on text that is not UTF-8
                yield pa.RecordBatch.from_arrays([pa.array(start + a, pa.int64()), lines], ["pos", "value"])


def _stitched(ends: DataFrame) -> DataFrame:
    """(pos, value) of the lines that parts cut in two or more, empty ones too.

    A line goes from one part's tail through parts without a line end to the next head. Which
    head and tail belong together follows from which parts have a line end: two numbers a part.
    """
    spark = ends.sparkSession
    broken = {r["part"] for r in ends.where(f"kind = {_HEAD}").select("part").collect()}
    through = {r["part"] for r in ends.where(f"kind = {_THROUGH}").select("part").collect()}
    line, rows = 0, []
    for part in sorted(broken | through):
        if part in through:
            rows.append((part, _THROUGH, line))
        else:
            rows += [(part, _HEAD, line), (part, _TAIL, line + 1)]
            line += 1
    # as long as the listing
    belongs = spark.createDataFrame(rows, "part long, kind int, line long")
    pieces = ends.join(F.broadcast(belongs), ["part", "kind"]).groupBy("line")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "part", "kind", F.hex("value").alias("value"))))
    whole = pieces.agg(F.min("pos").alias("pos"), ordered.alias("pieces"))
    return whole.select("pos", F.unhex(F.array_join("pieces.value", "")).alias("value"))


def _with_header(spark: SparkSession, path: str, pattern: str) -> tuple[str, DataFrame]:
    """The first non-empty line, and all other ones with their positions."""
    cloudpickle.register_pickle_by_value(sys.modules[bytesplit.__name__])
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    listed = _listed(spark, path, pattern)
    parts = _parts(spark, path, pattern, listed)
    kept = new_shared_dir(spark, "part-ends")
    parts.mapInArrow(_ends_of, _ENDS).write.parquet(kept)
    ends = spark.read.schema(_ENDS).parquet(kept)
    # the byte order mark is no text
    stripped = F.expr(f"CASE WHEN pos = 0 AND startswith(value, X'{bytesplit.BOM.hex()}') THEN substr(value, 4) ELSE value END")
    cut = _stitched(ends).select("pos", stripped.alias("value")).where("length(value) > 0")
    first = ends.where("first IS NOT NULL").select(F.col("first_pos").alias("pos"), F.col("first").alias("value"))
    header = cut.union(first).orderBy("pos").limit(1).collect()
    if not header:
        raise ValueError(f"The parts in {path} hold no line")
    at, text = header[0]["pos"], bytes(header[0]["value"]).decode()
    whole = parts.mapInArrow(_lines_of, "pos long, value string")
    lines = whole.union(cut.select("pos", F.expr("validate_utf8(CAST(value AS string))")))
    return text, lines.where(F.col("pos") > at)


def read_lines(spark: SparkSession, path: str, pattern: str = PATTERN, with_position: bool = False) -> DataFrame:
    """The data lines of the parts in `path`, header excluded, as `sources.lines.read_lines` gives them."""
    lines = _with_header(spark, path, pattern)[1]
    return lines if with_position else lines.select("value")


def read_transactions(spark: SparkSession, path: str, pattern: str = PATTERN, string_nulls: bool = False) -> DataFrame:
    """The raw relation held by the parts in `path`."""
    header, lines = _with_header(spark, path, pattern)
    return parse_csv(lines.select("value"), split_header(header), RAW_SCHEMA, string_nulls=string_nulls)
