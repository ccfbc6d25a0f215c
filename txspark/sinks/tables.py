"""Sinks for tables, CSV results and validation outcomes."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from txspark.sinks.publish import publish_tables, published_runs, read_published

PREVIEW_ROWS = 1000


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Store as Snappy Parquet, replacing what is there, and return the stored table."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str, order: list[Column]) -> None:
    """Write ordered CSV with a header line.

    The sort cuts the rows into ranges, written as files whose names sort like the rows.
    A small result is a single range and so a single file; a large one is never squeezed
    through one task.
    """
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, n: int = 20) -> list[Row]:
    """The first n rows; asking for more than a driver should hold is an error."""
    if n > PREVIEW_ROWS:
        raise ValueError(f"A preview shows at most {PREVIEW_ROWS} rows; export larger results")
    return df.limit(n).collect()


RESULTS = "results"


def store_results(
    results: DataFrame, path: str, run_id: str, run_time: datetime | None = None
) -> DataFrame:
    """Add one run's outcomes to the result store and return the whole store.

    A run owns its place, so storing it again replaces it and never doubles it, on whatever day
    that happens. `read_results` sees a run as it was before or as it is after, never neither:
    it follows the store's own documents. The partition `run_id=` beside them is a copy for tools
    that know nothing of these; replacing that copy is not one step.
    """
    run_time = run_time or datetime.now(timezone.utc)
    stamped = results.select(
        "*",
        F.lit(run_time.isoformat()).cast("timestamp").alias("run_time"),
        F.lit(run_time.date()).alias("run_date"),
        F.lit(run_id).alias("run_id"),
    )
    store = _store_of(path)
    publish_tables({RESULTS: stamped.coalesce(1)}, store, run_id)
    writer = read_published(results.sparkSession, store, RESULTS, run_id).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").parquet(path)
    return read_results(results.sparkSession, path)


def _store_of(path: str) -> str:
    return f"{path.rstrip('/')}-published"


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All runs of a result store, each as it was last stored."""
    store = _store_of(path)
    runs = published_runs(store)
    if not runs:
        raise FileNotFoundError(f"No run has been stored in {path}")
    return reduce(DataFrame.unionByName, [read_published(spark, store, RESULTS, r) for r in runs])
