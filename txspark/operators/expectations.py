"""A rule suite compiled to one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from txspark.functions.numbers import count_nulls
from txspark.functions.sqltext import ident, literal
from txspark.operators.profile import named
from txspark.rules import NOT_NULL, ROW_COUNT, Rule

RESULT_COLUMNS = (
    "position",
    "rule",
    "column",
    "element_count",
    "missing_count",
    "unexpected_count",
)


def _value(schema: T.StructType, column: str) -> str:
    """The column where it holds a value; NaN in a floating-point column is none."""
    if isinstance(schema[column].dataType, (T.DoubleType, T.FloatType)):
        return f"nanvl({ident(column)}, NULL)"
    return ident(column)


def suite_counters(schema: T.StructType, suite: list[Rule]) -> dict[str, str]:
    """Named counters from which every rule's outcome follows.

    Counters add up, so they may be taken per group or per partition first.
    """
    counters = {"rows": "count(1)"}
    for i, rule in enumerate(suite):
        if rule.type == ROW_COUNT:
            continue
        value = _value(schema, rule.column)
        counters[f"missing_{rule.column}"] = count_nulls(value)
        if rule.type != NOT_NULL:
            counters[f"broken_{i}"] = f"count_if({rule.violated(value)})"
    return counters


def _rows_off(low: int | None, high: int | None) -> str:
    """How many rows there are too few or too many."""
    off = ["0L"]
    if low is not None:
        off.append(f"{literal(low)} - rows")
    if high is not None:
        off.append(f"rows - {literal(high)}")
    return f"greatest({', '.join(off)})" if len(off) > 1 else off[0]


def _outcome(i: int, rule: Rule) -> str:
    if rule.type == ROW_COUNT:
        missing = "0L"
        unexpected = _rows_off(rule.kwargs.get("min_value"), rule.kwargs.get("max_value"))
    else:
        missing = ident(f"missing_{rule.column}")
        unexpected = missing if rule.type == NOT_NULL else f"broken_{i}"
    column = f"CAST({literal(rule.column)} AS STRING)"
    # not-null rules count all rows, the others only those that hold a value
    judged = "rows" if rule.type in (NOT_NULL, ROW_COUNT) else f"(rows - {missing})"
    tolerated = f"(1 - {literal(float(rule.mostly))}) * {judged} + 1e-9D" if rule.mostly < 1 else "0D"
    return f"{i + 1}, {literal(rule.type)}, {column}, rows, {missing}, {unexpected}, {tolerated}"


def suite_outcomes(counts: DataFrame, suite: list[Rule]) -> DataFrame:
    """One row per rule, from the single row of counters."""
    cells = ", ".join(_outcome(i, rule) for i, rule in enumerate(suite))
    names = ", ".join(ident(c) for c in (*RESULT_COLUMNS, "tolerated"))
    rows = counts.selectExpr(f"stack({len(suite)}, {cells}) AS ({names})")
    kept = [ident(c) for c in RESULT_COLUMNS]
    return rows.selectExpr(*kept, "unexpected_count <= tolerated AS success")


def run_suite(df: DataFrame, suite: list[Rule]) -> DataFrame:
    """Evaluate a whole suite over `df` in one pass without a shuffle of rows."""
    return suite_outcomes(df.selectExpr(*named(suite_counters(df.schema, suite))), suite)
