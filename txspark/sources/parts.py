"""Discovery and pre-flight check of part files."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession

from txspark.sources.bytesplit import PATTERN, Part, find_parts

PART_DDL = "file string, size_bytes bigint, pos bigint"


def discover(path: str, pattern: str = PATTERN) -> list[Part]:
    """Part files in name order. Warns where that order is not the numeric one."""
    parts = find_parts(path, pattern)
    if len({len(p.name) for p in parts}) > 1:
        warnings.warn(f"Part names in {path} differ in length; they are read in text order")
    return parts


def list_parts(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """(file, size_bytes, pos), where `pos` is the part's place in the virtual file.

    A plain directory listing, because Spark's own file sources leave empty files out.
    """
    rows = [(p.name, p.size, p.start) for p in discover(path, pattern)]
    return spark.createDataFrame(rows, PART_DDL)


def validate_parts(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """`list_parts`, or an error that names every empty part."""
    require_content(discover(path, pattern))
    return list_parts(spark, path, pattern)


def require_content(parts: list[Part]) -> None:
    """An error that names every empty part."""
    empty = [p.name for p in parts if p.size == 0]
    if empty:
        raise ValueError(f"These parts hold no bytes: {', '.join(empty)}")
