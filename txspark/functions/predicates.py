"""Row predicates with SQL's three-valued logic."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from txspark.functions.sqltext import ident, literal, literals


def all_present(columns: Iterable[str]) -> str:
    """Every column is non-NULL. Unlike `dropna`, NaN counts as a value."""
    return " AND ".join(f"{ident(c)} IS NOT NULL" for c in columns)


def any_null(columns: Iterable[str]) -> str:
    return " OR ".join(f"{ident(c)} IS NULL" for c in columns)


def in_set(expr: str, values: Iterable[Any]) -> str:
    return f"{expr} IN ({literals(values)})"


def not_in_set(expr: str, values: Iterable[Any]) -> str:
    return f"{expr} NOT IN ({literals(values)})"


def outside(
    expr: str,
    low: Any = None,
    high: Any = None,
    strict_low: bool = False,
    strict_high: bool = False,
) -> str:
    """Value lies outside the bounds; a strict bound excludes itself."""
    if low is None and high is None:
        raise ValueError("At least one bound is needed")
    misses = []
    if low is not None:
        misses.append(f"{expr} {'<=' if strict_low else '<'} {literal(low)}")
    if high is not None:
        misses.append(f"{expr} {'>=' if strict_high else '>'} {literal(high)}")
    return " OR ".join(misses)


def matches(expr: str, pattern: str) -> str:
    """Regex search, anchored only by the pattern itself.

    Java lets `$` match before a final line break; it is made to mean the very end.
    """
    return f"{expr} RLIKE {literal(strict_end(pattern))}"


def strict_end(pattern: str) -> str:
    """The pattern with every `$` anchor as `\\z`; escaped ones, those in a character class
    and quoted text stay."""
    out: list[str] = []
    depth = at = 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            quoted = pattern.startswith("\\Q", at)
            end = pattern.find("\\E", at) + 2 if quoted else at + 2
            end = len(pattern) if end < at + 2 else end
            out.append(pattern[at:end])
            at = end
            continue
        if c == "[":
            depth += 1
        elif c == "]" and depth:
            depth -= 1
        out.append("\\z" if c == "$" and not depth else c)
        at += 1
    return "".join(out)


def not_matches(expr: str, pattern: str) -> str:
    """The opposite; NULL, and so not true, where there is no text."""
    return f"NOT ({matches(expr, pattern)})"


def positive(expr: str) -> str:
    return f"{expr} > 0"


def not_positive(expr: str) -> str:
    return f"{expr} <= 0"


def null_or_not_positive(expr: str) -> str:
    return f"{expr} IS NULL OR {expr} <= 0"
