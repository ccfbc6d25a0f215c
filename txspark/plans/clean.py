"""The cleaning plan and its metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.functions.predicates import not_positive
from txspark.operators.dedupe import count_copies, drop_exact_duplicates
from txspark.operators.normalise import normalise
from txspark.rules import RULES, TransactionRules
from txspark.schema import require_columns


def valid_rows(raw: DataFrame, rules: TransactionRules = RULES) -> DataFrame:
    """Normalise and keep valid rows, copies included. Works on batches and streams.

    The filters look at nothing but the row's own columns, so filtering before the
    duplicates go gives the same rows as after, and only valid rows are shuffled. NULLs and
    amounts are tested on the raw columns, where the test reaches the Parquet scan.
    """
    present = require_columns(raw).where(rules.valid_raw())
    return normalise(present).where(rules.valid_values())


def clean(raw: DataFrame, rules: TransactionRules = RULES) -> DataFrame:
    """The valid rows, one of each. Works on batches and streams."""
    return drop_exact_duplicates(valid_rows(raw, rules))


def raw_metrics(raw: DataFrame, rules: TransactionRules = RULES) -> DataFrame:
    """Counters over the raw rows and over the distinct raw rows, in one job.

    Only a key and two flags of each row are shuffled.
    """
    flags = {"missing": rules.critical_missing(), "off": not_positive("amount")}
    return count_copies(raw, **flags).selectExpr(
        "coalesce(sum(copies), 0) AS total_raw",
        "count(1) AS distinct_raw",
        "count_if(missing) AS null_critical_dropped",
        "count_if(off) AS invalid_amount_dropped",
    )


def cleaning_metrics(
    raw: DataFrame, cleaned: DataFrame | None = None, rules: TransactionRules = RULES
) -> DataFrame:
    """Six cleaning counters as one row.

    Pass the stored clean table as `cleaned`: its rows are then counted from Parquet
    footers instead of being cleaned a second time. Counts come from stored data, never
    from accumulators, so a stage that is run again after a lost executor cannot inflate them.

    The drop counters may overlap and do not add up to `total_dropped`.
    """
    if cleaned is None:
        cleaned = clean(raw, rules)
    total_cleaned = cleaned.agg(F.count(F.lit(1))).scalar()
    counts = raw_metrics(raw, rules).withColumn("total_cleaned", total_cleaned)
    return counts.selectExpr(
        "total_raw",
        "total_cleaned",
        "total_raw - total_cleaned AS total_dropped",
        "total_raw - distinct_raw AS duplicates_removed",
        "null_critical_dropped",
        "invalid_amount_dropped",
    )
