"""The transaction data model: one fixed list of thirteen flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("sending_address", T.StringType()),
        T.StructField("receiving_address", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("location_region", T.StringType()),
        T.StructField("ip_prefix", T.StringType()),
        T.StructField("login_frequency", T.LongType()),
        T.StructField("session_duration", T.LongType()),
        T.StructField("purchase_pattern", T.StringType()),
        T.StructField("age_group", T.StringType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("anomaly", T.StringType()),
    ]
)

_NARROWED = {
    "timestamp": T.TimestampType(),
    "login_frequency": T.IntegerType(),
    "session_duration": T.IntegerType(),
}

CLEAN_SCHEMA = T.StructType(
    [T.StructField(f.name, _NARROWED.get(f.name, f.dataType)) for f in RAW_SCHEMA]
)

COLUMNS = RAW_SCHEMA.names


def missing_columns(names: list[str], expected: list[str] | None = None) -> list[str]:
    """Expected columns that are not among `names`, in contract order."""
    present = set(names)
    return [c for c in expected or COLUMNS if c not in present]


def require_columns(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Return `df` unchanged, or raise if a contract column is absent.

    Only the plan's schema is looked at, so no job runs. Extra columns pass.
    """
    missing = missing_columns(df.columns, expected)
    if missing:
        raise ValueError(f"Missing expected columns: {missing}")
    return df
