"""Exact duplicate rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.functions.rowkey import row_hashes, row_key


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one copy of every distinct row, in batches and streams.

    A two-phase hash aggregate over all columns: copies of a hot row collapse in the
    map-side phase, so no task ever sees more than one copy per input partition.

    On a stream every distinct row stays known, whatever its age: late rows are neither lost
    nor doubled. The state then holds a 256-bit key of each row in place of the row.
    """
    if not df.isStreaming:
        return df.dropDuplicates()
    key = "row_key"
    while key in df.columns:
        key = f"_{key}"
    return df.withColumn(key, row_key(df.schema)).dropDuplicates([key]).drop(key)


def count_copies(df: DataFrame, **flags: str) -> DataFrame:
    """(row_hash, row_check, copies, flags) of every distinct row, in one shuffle of 16-byte keys
    and flags.

    flags: SQL conditions on the row, the same for all its copies.
    """
    kept = [F.coalesce(F.expr(e), F.lit(False)).alias(n) for n, e in flags.items()]
    one, two = row_hashes(df.schema)
    keyed = df.select(one.alias("row_hash"), two.alias("row_check"), *kept)
    return keyed.groupBy("row_hash", "row_check").agg(
        F.count(F.lit(1)).alias("copies"), *[F.max(n).alias(n) for n in flags]
    )
