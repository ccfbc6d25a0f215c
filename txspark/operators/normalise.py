"""Raw columns to clean types and spellings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txspark.functions.numbers import strict_integer
from txspark.functions.sqltext import ident
from txspark.functions.text import lower_trim, trim_spaces
from txspark.schema import COLUMNS

LOWERED = ("sending_address", "receiving_address", "transaction_type", "anomaly")
TRIMMED = ("location_region", "ip_prefix", "purchase_pattern", "age_group")
NARROWED = ("login_frequency", "session_duration")


def clean_column(name: str) -> str:
    """The clean form of one contract column."""
    expr = ident(name)
    if name == "timestamp":
        expr = f"timestamp_seconds({expr})"
    elif name in LOWERED:
        expr = lower_trim(expr)
    elif name in TRIMMED:
        expr = trim_spaces(expr)
    elif name in NARROWED:
        expr = strict_integer(expr, name, "INT")
    return f"{expr} AS {ident(name)}"


def normalise(df: DataFrame) -> DataFrame:
    """Project to the thirteen contract columns in contract order, cleaned.

    One narrow projection; extra columns vanish here.
    """
    return df.selectExpr(*[clean_column(c) for c in COLUMNS])
