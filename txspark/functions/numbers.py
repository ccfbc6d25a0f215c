"""Number parsing and rounding."""

from __future__ import annotations

from txspark.functions.sqltext import literal

# What a decimal number looks like. A plain cast to double would also take
# Java's own spellings, such as `1d` or `0x1p3`.
_DECIMAL_TEXT = (
    r"^[ \t]*[+-]?"
    r"([0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))"
    r"[ \t]*\z"
)


def strict_double(expr: str, name: str) -> str:
    """Parse a decimal number, raising on anything else; NULL stays NULL."""
    problem = f"concat({literal(f'Column {name}: invalid number ')}, {expr})"
    return (
        f"CASE WHEN {expr} NOT RLIKE {literal(_DECIMAL_TEXT)} "
        f"THEN CAST(raise_error({problem}) AS DOUBLE) ELSE CAST({expr} AS DOUBLE) END"
    )


def strict_integer(expr: str, name: str, kind: str = "BIGINT") -> str:
    """Parse or narrow an integer, raising on anything else, whether or not the session
    casts strictly; NULL stays NULL."""
    problem = f"concat({literal(f'Column {name}: no integer, or overflow: ')}, CAST({expr} AS STRING))"
    refused = f"CASE WHEN {expr} IS NOT NULL THEN CAST(raise_error({problem}) AS {kind}) END"
    return f"coalesce(try_cast({expr} AS {kind}), {refused})"


def rounded_mean(expr: str, digits: int = 6) -> str:
    """Average rounded half away from zero."""
    return f"round(avg({expr}), {digits})"


def percent_correct(total: str, errors: str, digits: int = 4) -> str:
    """Share of `total` left after `errors`, in percent; 0 for an empty table.

    Errors are counted per cell, so the result may be negative.
    """
    share = f"CAST({total} - {errors} AS DOUBLE) / CAST({total} AS DOUBLE) * double('100')"
    return f"CASE WHEN {total} > 0 THEN round({share}, {digits}) ELSE double('0') END"


def count_nulls(expr: str) -> str:
    """NULLs as rows less values; a plain COUNT needs no branch per row."""
    return f"count(1) - count({expr})"
