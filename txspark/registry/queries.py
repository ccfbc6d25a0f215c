"""Every operator as a query over the fixture relation; see `oracle` for the expected rows.

Queries read the whole relation. Row operators return all rows they let through; those that
need files first have Spark derive them from the given tables into the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txspark import fixtures
from txspark import rules as R
from txspark.functions.predicates import (
    not_matches,
    not_positive,
    null_or_not_positive,
    positive,
)
from txspark.functions.text import null_if_token
from txspark.operators.dedupe import drop_exact_duplicates
from txspark.operators.expectations import run_suite
from txspark.operators.normalise import NARROWED, TRIMMED, clean_column, normalise
from txspark.operators.profile import frequency, null_profile, row_count
from txspark.operators.unexpected import unexpected_values
from txspark.plans import quality, tables
from txspark.plans.clean import clean, cleaning_metrics, valid_rows
from txspark.plans.pipeline import build_tables, run_pipeline
from txspark.plans.profiles import ProfileStore, start_quality
from txspark.rules import (
    BETWEEN,
    IN_SET,
    NOT_NULL,
    REGEX,
    RULES,
    Rule,
    TransactionRules,
    suite_from_json,
    suite_to_json,
)
from txspark.schema import COLUMNS, missing_columns
from txspark.session import configure, new_shared_dir, shuffle_partitions
from txspark.sinks.publish import read_published
from txspark.sinks.tables import export_csv, preview, store_results, write_table
from txspark.sources import wholefiles
from txspark.sources.bytesplit import find_parts, read_header, split_header
from txspark.sources.ingest import ingest
from txspark.sources.lines import (
    read_lines,
    read_transactions,
    stream_transactions,
)
from txspark.sources.parts import validate_parts
from txspark.streaming import distinct, live

Query = Callable[[SparkSession, str], DataFrame]

# The reference bound on the number of rows, for the queries that report on it.
BOUNDED = TransactionRules(max_rows=10_000_000)
RUN_TIME = datetime(2024, 1, 31, tzinfo=timezone.utc)
RUN_ID = "run-1"


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, the form in which other engines compare them."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            F.col(c).cast("timestamp_ntz").alias(c) if isinstance(t, T.TimestampType) else c
            for c, t in kinds.items()
        ]
    )


def raw_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.transactions(fixtures.events(spark, sf_dir))


def clean_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_of(spark, sf_dir))


def parts_of(spark: SparkSession, sf_dir: str, form: dict[str, str] | None = None) -> str:
    """A folder of parts cut inside records, derived from the events."""
    path = new_shared_dir(spark, "parts")
    fixtures.write_byte_split(fixtures.events(spark, sf_dir), path, form)
    return path


def _on_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(raw_of(spark, sf_dir))


def _on_normal(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(normalise(raw_of(spark, sf_dir)))


def _on_clean(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(clean_of(spark, sf_dir))


def _on_parts(build: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(spark, parts_of(spark, sf_dir))


def _on_odd_parts(build: Callable[[SparkSession, str], DataFrame]) -> Query:
    """Parts of an exporter that orders, quotes and pads in its own way."""
    return lambda spark, sf_dir: build(spark, parts_of(spark, sf_dir, fixtures.ODD_FORM))


def _on_lacking_parts(build: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(spark, parts_of(spark, sf_dir, fixtures.LACKING_FORM))


def _nan_apart(df: DataFrame) -> DataFrame:
    """NaN as a flag, since engines differ in how they show it."""
    return df.withColumns({"risk_is_nan": F.isnan("risk_score"), "risk_score": F.nanvl("risk_score", F.lit(None))})


# -- projections -----------------------------------------------------------------------


def epoch_to_ts(raw: DataFrame) -> DataFrame:
    return raw.selectExpr("timestamp AS epoch", "timestamp_seconds(timestamp) AS ts")


def normalise_address(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*[clean_column(c) for c in fixtures.ADDRESSES])


def normalise_category(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*[clean_column(c) for c in ("transaction_type", "anomaly")])


def trim_columns(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*[clean_column(c) for c in TRIMMED])


def narrow_cast(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*[clean_column(c) for c in NARROWED])


def null_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["amount", "risk_score"]
    texts = fixtures.number_texts(fixtures.events(spark, sf_dir), columns)
    return null_profile(texts.selectExpr(*[f"{null_if_token(c)} AS {c}" for c in columns]), columns)


# -- quality ---------------------------------------------------------------------------


def invalid_addresses(rows: DataFrame) -> DataFrame:
    bad = {c: not_matches(c, RULES.address_pattern) for c in fixtures.ADDRESSES}
    return rows.selectExpr(*[f"count_if({p}) AS invalid_{c}" for c, p in bad.items()])


def amount_checks(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        f"count_if({null_or_not_positive('amount')}) AS null_or_not_positive",
        f"count_if({not_positive('amount')}) AS not_positive",
    )


def expect(rule_type: str) -> Query:
    suite = quality.rules_of_type(BOUNDED, rule_type)
    return _on_normal(lambda rows: run_suite(rows, suite))


def bounded_results(rows: DataFrame) -> DataFrame:
    return quality.dq_suite_results(rows, BOUNDED)


def failed_rules(rows: DataFrame) -> DataFrame:
    results = bounded_results(rows)
    return results.where("NOT success").select("position", "rule", "column")


def stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store a run twice under one id: the store holds it once."""
    path = new_shared_dir(spark, "results")
    cleaned = clean_of(spark, sf_dir)
    results = write_table(quality.dq_suite_results(cleaned, BOUNDED), f"{path}-once")
    for _ in range(2):
        store = store_results(results, path, RUN_ID, RUN_TIME)
    return store.withColumn("run_date", F.col("run_date").cast("string")).drop("run_time")


# -- sources, sinks and whole runs -----------------------------------------------------


def ingest_metadata(spark: SparkSession, raw_dir: str) -> DataFrame:
    stored = ingest(spark, raw_dir, new_shared_dir(spark, "raw"))
    columns = F.size("columns").alias("column_count")
    return stored.select("row_count", "file_count", "bytes_read", columns)


def parquet_round_trip(cleaned: DataFrame) -> DataFrame:
    return write_table(cleaned, new_shared_dir(cleaned.sparkSession, "clean"))


def csv_export(cleaned: DataFrame) -> DataFrame:
    spark = cleaned.sparkSession
    table = tables.region_risk(cleaned)
    path = new_shared_dir(spark, "csv")
    export_csv(table, path, tables.region_order())
    return spark.read.schema(table.schema).option("header", True).csv(path)


def pipeline_table(name: str) -> Query:
    def run(spark: SparkSession, raw_dir: str) -> DataFrame:
        base = new_shared_dir(spark, "run")
        # The fixture holds rows that the gate must refuse, so it only reports here.
        results = run_pipeline(
            spark,
            raw_dir,
            f"{base}/work",
            f"{base}/out",
            raise_on_failure=False,
        )
        return results[name]

    return _on_parts(run)


def stored_tables(name: str) -> Query:
    def run(cleaned: DataFrame) -> DataFrame:
        return build_tables(cleaned, new_shared_dir(cleaned.sparkSession, "out"))[name]

    return _on_clean(run)


def column_contract(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Which columns of the contract the parts' header holds."""
    absent = set(missing_columns(split_header(read_header(raw_dir)[0])))
    return spark.createDataFrame([(c, c not in absent) for c in COLUMNS], "column_name string, present boolean")


def preview_rows(cleaned: DataFrame) -> DataFrame:
    table = tables.top_receivers(cleaned)
    return cleaned.sparkSession.createDataFrame(preview(table), table.schema)


def receivers_csv(cleaned: DataFrame) -> DataFrame:
    """Instants leave as ISO text in UTC, with milliseconds and zone."""
    table = tables.top_receivers(cleaned)
    path = new_shared_dir(cleaned.sparkSession, "csv")
    export_csv(table, path, tables.receiver_order())
    return cleaned.sparkSession.read.option("header", True).csv(path)


def gate_verdict(cleaned: DataFrame) -> DataFrame:
    """What the gate decides on, as one row."""
    results = write_table(
        quality.dq_suite_results(cleaned, BOUNDED), new_shared_dir(cleaned.sparkSession, "results")
    )
    verdict = (quality.gate(results, raise_on_failure=False), ", ".join(quality.failed_rules(results)))
    return cleaned.sparkSession.createDataFrame([verdict], "success boolean, failed string")


MOSTLY_SUITE = suite_to_json(
    "mostly",
    [
        Rule(NOT_NULL, {"column": "amount", "mostly": 0.5}),
        Rule(NOT_NULL, {"column": "amount", "mostly": 0.999}),
        Rule(IN_SET, {"column": "age_group", "value_set": ["new"], "mostly": 0.1}),
        Rule(BETWEEN, {"column": "risk_score", "min_value": 50, "mostly": 0.9}),
        Rule(REGEX, {"column": "sending_address", "regex": "^0x", "mostly": 0.8}),
    ],
)


# -- profiles that add up ---------------------------------------------------------------


def _profiles_of_slots(cleaned: DataFrame) -> ProfileStore:
    """A store with a profile for each of four slots, one of them put twice."""
    spark = cleaned.sparkSession
    store = ProfileStore(spark, new_shared_dir(spark, "profiles"), BOUNDED)
    for slot in (0, 1, 2, 3, 1):
        store.put(f"slot-{slot}", cleaned.where(F.pmod(F.hash("sending_address", "timestamp"), F.lit(4)) == slot))
    store.fold(["slot-0", "slot-2"], "slot-2")
    return store


def profile_slots_results(cleaned: DataFrame) -> DataFrame:
    return _profiles_of_slots(cleaned).report().results()


def profile_slots_metrics(cleaned: DataFrame) -> DataFrame:
    return _profiles_of_slots(cleaned).report().metrics()


EXAMPLES = 4


def unexpected(rows: DataFrame) -> DataFrame:
    """The most frequent breaking values of each set and pattern rule, with one scan of the rows."""
    return unexpected_values(rows, BOUNDED.suite(), EXAMPLES).where(F.col("rule").isin(IN_SET, REGEX))


# A few frequent values among hundreds of rare ones.
MIXED = "CASE WHEN login_frequency < 3 THEN transaction_type ELSE ip_prefix END"


def unexpected_small_sketch(rows: DataFrame) -> DataFrame:
    """The same by a sketch that is too small for all breaking values."""
    suite = [Rule(IN_SET, {"column": "mixed", "value_set": ["none"]})]
    return unexpected_values(rows.selectExpr(f"{MIXED} AS mixed"), suite, 3, tracked=200)


def stream_quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite's outcome after the last batch of a stream whose rows arrive in any order."""
    base = new_shared_dir(spark, "stream")
    rows = valid_rows(_out_of_order(spark, sf_dir, base))
    query = start_quality(rows, f"{base}/rows", f"{base}/checkpoint", BOUNDED, raise_on_failure=False)
    query.awaitTermination()
    return read_published(spark, f"{base}/rows/report", "dq_results")


# -- streams ---------------------------------------------------------------------------


def _state_partitions(spark: SparkSession, size: int) -> int:
    return shuffle_partitions(size, spark.sparkContext.defaultParallelism)


def _limited(raw_dir: str) -> dict[str, object]:
    """A bounded stream over the parts, taken in a few micro-batches whatever their size."""
    return {"bounded": True, "flush": True, "maxBytesPerTrigger": max(find_parts(raw_dir)[-1].end // 4, 1)}


def stream_ingest(spark: SparkSession, raw_dir: str) -> DataFrame:
    base = new_shared_dir(spark, "stream")
    rows = stream_transactions(spark, raw_dir, **_limited(raw_dir))
    writer = rows.writeStream.option("checkpointLocation", f"{base}/checkpoint").format("parquet")
    live.started(writer, f"{base}/raw").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/raw")


BATCHES = 4
EVENTS_PER_FILE = 100_000


def _out_of_order(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """The raw relation as a stream of several batches, each with rows of all times.

    A batch has files of a bounded number of rows, so that its tasks grow in number and not in size.
    """
    events = fixtures.events(spark, sf_dir)
    files = max(math.ceil(events.count() / (BATCHES * EVENTS_PER_FILE)), 1)
    events.repartition(BATCHES * files, "event_id").write.parquet(f"{base}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/events")
    return fixtures.transactions(stream)


def stream_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows of such a stream, deduplicated against runs in shared storage."""
    base = new_shared_dir(spark, "stream")
    rows = valid_rows(_out_of_order(spark, sf_dir, base))
    distinct.start_distinct(rows, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return distinct.read_distinct(spark, f"{base}/rows")


def stream_distinct_region_risk(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Parts in limited batches, and the region table from what is new in each."""
    base = new_shared_dir(spark, "stream")
    rows = valid_rows(stream_transactions(spark, raw_dir, **_limited(raw_dir)))
    distinct.start_region_risk(rows, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return live.read_table(spark, f"{base}/table").orderBy(*tables.region_order())


def stream_latest_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest sale of every receiver, kept current by changes alone."""
    base = new_shared_dir(spark, "stream")
    rows = valid_rows(_out_of_order(spark, sf_dir, base))
    parts = _state_partitions(spark, fixtures.events_bytes(sf_dir))
    live.start_top_receivers(rows, f"{base}/table", f"{base}/checkpoint", state_partitions=parts).awaitTermination()
    return live.read_latest_sales(spark, f"{base}/table")


def stream_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows of a stream whose arrivals are not in time order: none is lost as late."""
    base = new_shared_dir(spark, "stream")
    rows = clean(_out_of_order(spark, sf_dir, base))
    with live.stream_settings(spark, _state_partitions(spark, fixtures.events_bytes(sf_dir))):
        writer = rows.writeStream.option("checkpointLocation", f"{base}/checkpoint")
        writer.trigger(availableNow=True).format("parquet").start(f"{base}/clean").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/clean")


def stream_region_risk(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Parts, byte-split stream, cleaning and table in one query."""
    base = new_shared_dir(spark, "stream")
    query = live.start_region_risk(
        clean(stream_transactions(spark, raw_dir, **_limited(raw_dir))),
        f"{base}/table",
        f"{base}/checkpoint",
        state_partitions=_state_partitions(spark, find_parts(raw_dir)[-1].end),
    )
    query.awaitTermination()
    return live.read_table(spark, f"{base}/table").orderBy(*tables.region_order())


def stream_top_receivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream."""
    base = new_shared_dir(spark, "stream")
    query = live.start_top_receivers(
        valid_rows(fixtures.transactions(fixtures.stream_events(spark, sf_dir))),
        f"{base}/table",
        f"{base}/checkpoint",
        state_partitions=_state_partitions(spark, fixtures.events_bytes(sf_dir)),
    )
    query.awaitTermination()
    return live.read_table(spark, f"{base}/table").orderBy(*tables.receiver_order())


QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_raw": _on_raw(lambda raw: raw),
    "list_parts": _on_parts(validate_parts),
    "ingest_lines": _on_parts(read_lines),
    "ingest_parse": _on_parts(read_transactions),
    "ingest_parse_string_nulls": _on_parts(
        lambda spark, raw_dir: read_transactions(spark, raw_dir, string_nulls=True)
    ),
    "ingest_metadata": _on_parts(ingest_metadata),
    "ingest_lines_by_spark": _on_parts(wholefiles.read_lines),
    "ingest_odd_by_spark": _on_odd_parts(lambda spark, parts: _nan_apart(wholefiles.read_transactions(spark, parts))),
    "ingest_odd": _on_odd_parts(lambda spark, parts: _nan_apart(read_transactions(spark, parts))),
    "clean_odd": _on_odd_parts(lambda spark, parts: _nan_apart(clean(read_transactions(spark, parts)))),
    "column_contract_broken": _on_lacking_parts(column_contract),
    "null_token_counts": null_token_counts,
    "parquet_round_trip": _on_clean(parquet_round_trip),
    "csv_export": _on_clean(csv_export),
    "result_store": stored_results,
    # projections
    "epoch_to_ts": _on_raw(epoch_to_ts),
    "normalise_address": _on_raw(normalise_address),
    "normalise_category": _on_raw(normalise_category),
    "trim_columns": _on_raw(trim_columns),
    "narrow_cast": _on_raw(narrow_cast),
    "project_columns": _on_raw(normalise),
    # filters
    "filter_critical_not_null": _on_normal(lambda df: df.where(RULES.critical_present())),
    "filter_critical_null": _on_normal(lambda df: df.where(RULES.critical_missing())),
    "filter_amount_positive": _on_normal(lambda df: df.where(positive("amount"))),
    "filter_regex": _on_normal(lambda df: df.where(RULES.valid_region())),
    "filter_in_set": _on_normal(lambda df: df.where(RULES.allowed_values())),
    "filter_sales": _on_normal(tables.sales),
    # distinct and aggregation
    "dedupe_exact": _on_normal(drop_exact_duplicates),
    "row_count": _on_raw(row_count),
    "anomaly_breakdown": _on_clean(lambda df: frequency(df, "anomaly")),
    "region_frequency": _on_normal(lambda df: frequency(df, "location_region")),
    "null_profile": _on_normal(null_profile),
    "invalid_addresses": _on_normal(invalid_addresses),
    "amount_checks": _on_normal(amount_checks),
    "cleaning_metrics": _on_raw(cleaning_metrics),
    "dq_metrics": _on_clean(quality.dq_metrics),
    "dq_metrics_uncleaned": _on_normal(quality.dq_metrics),
    # validation
    "expect_row_count": expect(R.ROW_COUNT),
    "expect_not_null": expect(R.NOT_NULL),
    "expect_in_set": expect(R.IN_SET),
    "expect_between": expect(R.BETWEEN),
    "expect_regex": expect(R.REGEX),
    "dq_suite_results": _on_clean(bounded_results),
    "dq_suite_uncleaned": _on_normal(bounded_results),
    "dq_suite_summary": _on_clean(lambda df: quality.summarise(bounded_results(df))),
    "suite_mostly": _on_normal(lambda rows: run_suite(rows, suite_from_json(MOSTLY_SUITE))),
    "gate_verdict": _on_clean(gate_verdict),
    "column_contract": _on_parts(column_contract),
    "preview_rows": _on_clean(preview_rows),
    "receivers_csv": _on_clean(receivers_csv),
    "stream_out_of_order": stream_out_of_order,
    "dq_failed_rules": _on_clean(failed_rules),
    # tables
    "clean_transactions": clean_of,
    "region_risk": _on_clean(tables.region_risk),
    "latest_sale_per_receiver": _on_clean(tables.latest_sale_per_receiver),
    "latest_sale_aggregate": _on_clean(live.latest_sales),
    "top_receivers": _on_clean(tables.top_receivers),
    "stored_region_risk": stored_tables("region_risk"),
    "stored_top_receivers": stored_tables("top_receivers"),
    # whole runs over byte-split parts
    "pipeline_region_risk": pipeline_table("region_risk"),
    "pipeline_top_receivers": pipeline_table("top_receivers"),
    "pipeline_cleaning_metrics": pipeline_table("cleaning_metrics"),
    "pipeline_dq_results": pipeline_table("dq_results"),
    # profiles that add up
    "profile_slots_results": _on_clean(profile_slots_results),
    "profile_slots_metrics": _on_clean(profile_slots_metrics),
    "unexpected_values": _on_normal(unexpected),
    "unexpected_values_small_sketch": _on_normal(unexpected_small_sketch),
    "stream_quality_results": stream_quality_results,
    # streams
    "stream_ingest": _on_parts(stream_ingest),
    "stream_region_risk": _on_parts(stream_region_risk),
    "stream_top_receivers": stream_top_receivers,
    "stream_latest_sales": stream_latest_sales,
    "stream_distinct_rows": stream_distinct_rows,
    "stream_distinct_region_risk": _on_parts(stream_distinct_region_risk),
}


def queries() -> dict[str, Query]:
    """Queries by name, each with its session settings and comparable time columns."""

    def wrap(query: Query) -> Query:
        return lambda spark, sf_dir: plain_times(query(configure(spark), sf_dir))

    return {name: wrap(query) for name, query in QUERIES.items()}
