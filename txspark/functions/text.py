"""Text normalisation with built-in string functions."""

from __future__ import annotations

from collections.abc import Iterable

from txspark.functions.sqltext import literal, literals

# The Unicode space separators (general category Zs).
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)

# Spellings of "no value", compared case-sensitively with the whole field.
NULL_TOKENS = ("", "none", "None", "null", "NULL", "N/A", "n/a", "NaN", "nan")


def trim_spaces(expr: str) -> str:
    """Strip space separators at both ends; tabs and line breaks stay.

    Pure ASCII text, as many bytes as characters, can only hold the plain space, for which
    the plain TRIM is several times faster.
    """
    return (
        f"CASE WHEN length({expr}) = octet_length({expr}) THEN trim({expr}) "
        f"ELSE trim(BOTH {literal(SPACE_SEPARATORS)} FROM {expr}) END"
    )


def lower_trim(expr: str) -> str:
    return f"lower({trim_spaces(expr)})"


def null_if_token(expr: str, tokens: Iterable[str] = NULL_TOKENS) -> str:
    """NULL where the text is one of the tokens."""
    return f"CASE WHEN {expr} NOT IN ({literals(tokens)}) THEN {expr} END"
