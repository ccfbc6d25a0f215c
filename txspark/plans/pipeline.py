"""The whole batch run: check, ingest, clean, validate, build and export."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from txspark.plans.clean import clean, cleaning_metrics
from txspark.plans.quality import QualityReport, gate, quality_profile
from txspark.plans.tables import (
    receiver_order,
    region_order,
    region_risk,
    top_receivers,
)
from txspark.rules import RULES, TransactionRules
from txspark.session import sized_shuffles
from txspark.sinks.publish import publish_tables
from txspark.sinks.tables import export_csv, store_results, write_table
from txspark.sources.ingest import ingest
from txspark.sources.parts import discover, require_content

# A raw CSV row is about this many times as long as its key and flags in a shuffle.
KEY_SHARE = 4

# What a run makes visible in one step.
PUBLISHED = (
    "ingestion",
    "cleaning_metrics",
    "dq_metrics",
    "null_profile",
    "anomaly_breakdown",
    "dq_results",
    "region_risk",
    "top_receivers",
)


def run_quality(
    cleaned: DataFrame,
    out_dir: str,
    rules: TransactionRules = RULES,
    run_id: str | None = None,
    raise_on_failure: bool = True,
) -> dict[str, DataFrame]:
    """Store the quality report of `cleaned`, then let the gate decide.

    The data is scanned once, into the small stored profile. All reports are on disk before
    the gate may raise, so a failed run can be examined.
    """
    profile = write_table(quality_profile(cleaned, rules), f"{out_dir}/quality/profile")
    report = QualityReport(profile, rules)
    results = report.results()
    stored = {
        "dq_metrics": write_table(report.metrics(), f"{out_dir}/quality/metrics"),
        "null_profile": write_table(report.null_profile(), f"{out_dir}/quality/nulls"),
        "anomaly_breakdown": report.anomaly_breakdown(),
        "dq_results": results,
        "result_store": store_results(
            results, f"{out_dir}/quality/results", run_id or uuid.uuid4().hex
        ),
    }
    gate(results, raise_on_failure)
    return stored


def build_tables(cleaned: DataFrame, out_dir: str, k: int = 3) -> dict[str, DataFrame]:
    """Store both result tables as Parquet and as CSV."""
    regions = write_table(region_risk(cleaned), f"{out_dir}/region_risk")
    export_csv(regions, f"{out_dir}/region_risk_csv", region_order())
    receivers = write_table(top_receivers(cleaned, k), f"{out_dir}/top_receivers")
    export_csv(receivers, f"{out_dir}/top_receivers_csv", receiver_order())
    return {
        "region_risk": regions.orderBy(*region_order()),
        "top_receivers": receivers.orderBy(*receiver_order()),
    }


def run_pipeline(
    spark: SparkSession,
    raw_dir: str,
    work_dir: str,
    out_dir: str,
    rules: TransactionRules = RULES,
    run_id: str | None = None,
    raise_on_failure: bool = True,
    string_nulls: bool = False,
    k: int = 3,
) -> dict[str, DataFrame]:
    """Run every step over all parts in `raw_dir` and return the stored results by name.

    The raw and the clean table are written once to `work_dir`, and each later step reads
    only the columns it needs from there: lost executors never cause cleaning to be redone.
    Every run is a full refresh. Its reports and result tables are also published together in
    `out_dir`/published, where `sinks.publish.read_published` gives readers the tables of one
    run, the last one that got through, while the next one is being stored.
    """
    run_id = run_id or uuid.uuid4().hex
    parts = discover(raw_dir)
    require_content(parts)
    input_bytes = parts[-1].end
    ingestion = ingest(
        spark, raw_dir, f"{work_dir}/raw", string_nulls=string_nulls, parts=parts
    )
    raw = spark.read.parquet(f"{work_dir}/raw")
    with sized_shuffles(spark, input_bytes):  # whole rows are shuffled
        cleaned = write_table(clean(raw, rules), f"{work_dir}/clean")
    with sized_shuffles(spark, input_bytes // KEY_SHARE):  # keys and flags only
        metrics = write_table(
            cleaning_metrics(raw, cleaned, rules), f"{out_dir}/quality/cleaning"
        )
    results = {"ingestion": ingestion, "cleaned": cleaned, "cleaning_metrics": metrics}
    results |= run_quality(cleaned, out_dir, rules, run_id, raise_on_failure)
    results |= build_tables(cleaned, out_dir, k)
    publish_tables({n: results[n] for n in PUBLISHED}, f"{out_dir}/published", run_id)
    return results
