"""Byte-split parts to a raw Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txspark.sinks.tables import write_table
from txspark.sources.bytesplit import PATTERN, Part, find_parts, fingerprint
from txspark.sources.lines import header_of, parse_csv, read_lines
from txspark.sources.listing import store_listing, with_samples


def ingest(
    spark: SparkSession,
    raw_dir: str,
    target: str,
    pattern: str = PATTERN,
    string_nulls: bool = False,
    parts: list[Part] | None = None,
    sampled: bool = False,
) -> DataFrame:
    """Parse the parts into the table `target`; returns its metadata as one row.

    Header, rows and metadata come from one listing, `parts` if it was taken before; parts that
    come, go or change meanwhile are an error. The listing is kept beside the table, in
    `<target>-parts`, and tasks find their parts there. sampled: bytes of each part are looked
    at as well, so that a part replaced by one of the same size and time is found out.

    One pass without a shuffle. The rows are counted from the written files' footers, which
    stays right when tasks run twice.
    """
    parts = parts or find_parts(raw_dir, pattern)
    header = header_of(raw_dir, pattern, parts=parts)
    kept = store_listing(with_samples(spark, raw_dir, parts) if sampled else parts, f"{target.rstrip('/')}-parts")
    lines = read_lines(spark, raw_dir, pattern, stored=kept, listing=fingerprint(parts))
    raw = parse_csv(lines, header, string_nulls=string_nulls)
    stored = write_table(raw, target)
    return stored.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(parts)).cast("bigint").alias("file_count"),
        F.lit(parts[-1].end).cast("bigint").alias("bytes_read"),
        F.array(*[F.lit(c) for c in header]).alias("columns"),
    )
