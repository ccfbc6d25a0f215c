"""Names and values as SQL text."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any


def ident(name: str) -> str:
    """A column name, quoted."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: Any) -> str:
    """A constant."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"double('{value!r}')"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise ValueError(f"No SQL literal for {value!r}")


def literals(values: Iterable[Any]) -> str:
    return ", ".join(literal(v) for v in values)
