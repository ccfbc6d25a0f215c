"""Short keys for whole rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txspark.functions.sqltext import ident


def _field(name: str, kind: T.DataType) -> Column:
    """A value as text with its length in front, so that fields cannot run together."""
    value = F.col(ident(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)  # -0.0 equals 0.0
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(value)
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_key(schema: T.StructType) -> Column:
    """SHA-256 over all fields, 32 bytes: equal rows, NULLs included, have equal keys."""
    fields = [_field(f.name, f.dataType) for f in schema]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def row_hashes(schema: T.StructType) -> list[Column]:
    """Two 64-bit hashes over all fields, from different seeds: 128 bits that equal rows share.

    For counting, where a key need not outlive the query: several times cheaper than `row_key`,
    as no field turns into text. The hash passes over NULLs, so it also takes where they are.
    """
    fields = [F.col(ident(f.name)) for f in schema]
    nulls = [c.isNull() for c in fields]
    return [F.xxhash64(*fields, *nulls, F.lit(1)), F.xxhash64(F.lit(2), *nulls, *fields)]
