"""Counting operators. Each is one scan, however many counters it holds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.functions.numbers import count_nulls
from txspark.functions.sqltext import ident
from txspark.schema import COLUMNS


def named(counters: dict[str, str]) -> list[str]:
    """Aggregates by name as aliased expressions."""
    return [f"{expr} AS {ident(name)}" for name, expr in counters.items()]


def row_count(df: DataFrame) -> DataFrame:
    return df.selectExpr("count(1) AS row_count")


def null_profile(df: DataFrame, columns: Iterable[str] = COLUMNS) -> DataFrame:
    """NULLs per column as (column_name, null_count)."""
    counts = df.selectExpr(*named({c: count_nulls(ident(c)) for c in columns}))
    return counts.unpivot([], counts.columns, "column_name", "null_count")


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is a value of its own."""
    return df.groupBy(column).count().orderBy(F.desc("count"), F.asc(column))
