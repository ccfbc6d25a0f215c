"""The quality report: metrics, null profile, value breakdown and rule outcomes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.functions.numbers import count_nulls, percent_correct
from txspark.functions.predicates import not_matches, null_or_not_positive, outside
from txspark.functions.sqltext import ident
from txspark.operators.expectations import suite_counters, suite_outcomes
from txspark.operators.profile import named
from txspark.rules import RULES, Rule, TransactionRules
from txspark.schema import COLUMNS


class DataQualityError(Exception):
    """A validation suite failed."""


def quality_profile(df: DataFrame, rules: TransactionRules = RULES) -> DataFrame:
    """All counters of the report, one row per `anomaly` value.

    The only scan a report needs: everything else is derived from this small frame.
    Counters are summed map-side, so one value holding most rows does no harm.
    """
    counters = suite_counters(df.schema, rules.suite())
    counters |= {f"null_{c}": count_nulls(c) for c in COLUMNS}
    counters["invalid_amount_rows"] = f"count_if({null_or_not_positive('amount')})"
    for side in ("sending", "receiving"):
        bad = not_matches(ident(f"{side}_address"), rules.address_pattern)
        counters[f"invalid_{side}_addresses"] = f"count_if({bad})"
    counters["risk_score_out_of_range"] = f"count_if({outside('risk_score', *rules.risk_range)})"
    return df.groupBy("anomaly").agg(*map(F.expr, named(counters)))


def _totals(profile: DataFrame) -> DataFrame:
    names = [c for c in profile.columns if c != "anomaly"]
    return profile.selectExpr(*named({n: f"coalesce(sum({n}), 0)" for n in names}))


@dataclass(frozen=True)
class QualityReport:
    """Views on one quality profile. Give it a stored profile to read the data once only."""

    profile: DataFrame
    rules: TransactionRules = RULES

    def metrics(self) -> DataFrame:
        """Record, error and compliance figures as one row.

        Errors are counted per cell: a NULL amount is both a NULL and an invalid amount.
        """
        errors = (
            "total_nulls + invalid_amount_rows + invalid_sending_addresses"
            " + invalid_receiving_addresses"
        )
        nulls = " + ".join(f"null_{c}" for c in COLUMNS)
        rows = _totals(self.profile).selectExpr("*", f"{nulls} AS total_nulls")
        rows = rows.selectExpr("*", f"{errors} AS error_count")
        return rows.selectExpr(
            "rows AS total_records",
            "total_nulls",
            "invalid_amount_rows",
            "invalid_sending_addresses",
            "invalid_receiving_addresses",
            "risk_score_out_of_range",
            "error_count",
            f"{percent_correct('rows', 'error_count')} AS compliance_pct",
        )

    def null_profile(self) -> DataFrame:
        counts = _totals(self.profile).selectExpr(*[f"null_{c} AS {c}" for c in COLUMNS])
        return counts.unpivot([], COLUMNS, "column_name", "null_count")

    def anomaly_breakdown(self) -> DataFrame:
        """Rows per anomaly value, most frequent first."""
        counts = self.profile.selectExpr("anomaly", "rows AS count")
        return counts.orderBy(F.desc("count"), F.asc("anomaly"))

    def results(self) -> DataFrame:
        """One row per rule of the suite."""
        return suite_outcomes(_totals(self.profile), self.rules.suite())


def summarise(results: DataFrame) -> DataFrame:
    """Evaluated, successful and unsuccessful rules, and the overall verdict."""
    return results.selectExpr(
        "coalesce(bool_and(success), true) AS success",
        "count(1) AS evaluated_expectations",
        "count_if(success) AS successful_expectations",
        "count_if(NOT success) AS unsuccessful_expectations",
    )


def failed_rules(results: DataFrame) -> list[str]:
    """Types of the failed rules, in suite order; the frame holds one row per rule."""
    rows = results.where("NOT success").orderBy("position").select("rule").collect()
    return [r.rule for r in rows]


def gate(results: DataFrame, raise_on_failure: bool = True) -> bool:
    """Whether every rule passed; raises on failure unless told not to."""
    failed = failed_rules(results)
    if failed and raise_on_failure:
        raise DataQualityError(f"The data breaks {len(failed)} rules: {', '.join(failed)}")
    return not failed


def dq_metrics(df: DataFrame, rules: TransactionRules = RULES) -> DataFrame:
    return QualityReport(quality_profile(df, rules), rules).metrics()


def dq_suite_results(df: DataFrame, rules: TransactionRules = RULES) -> DataFrame:
    return QualityReport(quality_profile(df, rules), rules).results()


def rules_of_type(rules: TransactionRules, rule_type: str) -> list[Rule]:
    return [r for r in rules.suite() if r.type == rule_type]
