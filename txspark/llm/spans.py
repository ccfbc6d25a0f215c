"""Where a regular expression matches in a text, as Spark SQL expressions."""

from __future__ import annotations


def literal(text: str) -> str:
    """A SQL string literal for any text, however the session reads backslashes."""
    return "decode(unhex('" + text.encode().hex() + "'), 'UTF-8')"


def found(body: str, pattern: str, gate: str = "true") -> str:
    """SQL for an array of struct(s, e, m): start, end (exclusive) and text of all matches,
    left to right, in code points. The gate skips texts that cannot match.

    The pattern must not match empty text. Starts are sums over the gaps before a match.
    """
    p = literal(pattern)
    empty = "CAST(array() AS array<struct<s: int, e: int, m: string>>)"
    starts = (
        "transform(sequence(1, size(q.m)), i -> "
        "aggregate(slice(q.g, 1, i), 0, (a, x) -> a + length(x)) + "
        "aggregate(slice(q.m, 1, i - 1), 0, (a, x) -> a + length(x)))"
    )
    return (
        f"CASE WHEN {gate} THEN flatten(transform(filter(array(struct("
        f"regexp_extract_all({body}, {p}, 0) AS m, split({body}, {p}, -1) AS g)), q -> size(q.m) > 0), q -> "
        f"zip_with({starts}, q.m, (s, m) -> struct(s AS s, s + length(m) AS e, m AS m)))) ELSE {empty} END"
    )
