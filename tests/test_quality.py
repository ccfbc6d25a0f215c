"""Metrics, rule suite, gate and result store."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from conftest import clean_row
from pyspark.sql import functions as F

from txspark import rules as R
from txspark.operators.expectations import run_suite
from txspark.operators.profile import frequency, null_profile
from txspark.plans.quality import (
    DataQualityError,
    QualityReport,
    dq_metrics,
    dq_suite_results,
    gate,
    quality_profile,
    summarise,
)
from txspark.rules import RULES, Rule, TransactionRules, suite_from_json, suite_to_json
from txspark.sinks.tables import store_results


def metrics(df):
    return dq_metrics(df).first().asDict()


def test_clean_rows_comply_fully(cleaned):
    got = metrics(cleaned(clean_row(), clean_row()))
    assert got.pop("total_records") == 2
    assert got.pop("compliance_pct") == 100.0
    assert set(got.values()) == {0}


@pytest.mark.parametrize(
    "changes, counters, errors",
    [
        # A NULL amount counts twice.
        ({"amount": None}, {"total_nulls": 1, "invalid_amount_rows": 1}, 2),
        ({"amount": 0.0}, {"invalid_amount_rows": 1}, 1),
        ({"amount": -3.0}, {"invalid_amount_rows": 1}, 1),
        ({"ip_prefix": None}, {"total_nulls": 1}, 1),
        ({"sending_address": "0x" + "A" * 40}, {"invalid_sending_addresses": 1}, 1),
        ({"receiving_address": "0xbad"}, {"invalid_receiving_addresses": 1}, 1),
        ({"receiving_address": "0x" + "b" * 40 + "\n"}, {"invalid_receiving_addresses": 1}, 1),
        # No address is a NULL, but not an invalid address.
        ({"sending_address": None}, {"total_nulls": 1}, 1),
        # A risk out of range is reported but no error.
        ({"risk_score": 150.0}, {"risk_score_out_of_range": 1}, 0),
        ({"risk_score": -0.5}, {"risk_score_out_of_range": 1}, 0),
        ({"risk_score": 100.0}, {}, 0),
        ({"amount": float("nan")}, {}, 0),
    ],
    ids=str,
)
def test_counters(cleaned, changes, counters, errors):
    got = metrics(cleaned(clean_row(), clean_row(**changes), clean_row(), clean_row()))
    assert got["error_count"] == errors
    assert got["compliance_pct"] == (4 - errors) / 4 * 100
    for name in ("total_nulls", "invalid_amount_rows", "risk_score_out_of_range"):
        assert got[name] == counters.get(name, 0)
    for side in ("sending", "receiving"):
        name = f"invalid_{side}_addresses"
        assert got[name] == counters.get(name, 0)


def test_compliance_rounding_and_sign(cleaned):
    third = [clean_row(), clean_row(), clean_row(amount=0.0)]
    assert metrics(cleaned(*third))["compliance_pct"] == 66.6667
    nothing = clean_row() | {c: None for c in ("amount", "ip_prefix", "anomaly")}
    assert metrics(cleaned(nothing))["compliance_pct"] == -300.0


def test_empty_table(cleaned):
    got = metrics(cleaned())
    assert got["compliance_pct"] == 0.0 and got["total_records"] == 0
    assert QualityReport(quality_profile(cleaned())).anomaly_breakdown().count() == 0


def test_breakdown_has_null_as_a_value(cleaned):
    values = ["low_risk", "low_risk", "high_risk", None]
    df = cleaned(*[clean_row(anomaly=v) for v in values])
    expected = [("low_risk", 2), (None, 1), ("high_risk", 1)]
    for got in (frequency(df, "anomaly"), QualityReport(quality_profile(df)).anomaly_breakdown()):
        assert [tuple(r) for r in got.collect()] == expected


def test_null_profiles_agree(cleaned):
    df = cleaned(clean_row(amount=None), clean_row(amount=None, ip_prefix=None))
    one = {r[0]: r[1] for r in null_profile(df).collect()}
    two = {r[0]: r[1] for r in QualityReport(quality_profile(df)).null_profile().collect()}
    assert one == two
    assert (one["amount"], one["ip_prefix"], one["anomaly"], len(one)) == (2, 1, 0, 13)


def outcome(df, rule):
    return run_suite(df, [rule]).first()


@pytest.mark.parametrize(
    "rule, changes, missing, unexpected",
    [
        (Rule(R.NOT_NULL, {"column": "anomaly"}), {"anomaly": None}, 1, 1),
        (Rule(R.NOT_NULL, {"column": "amount"}), {"amount": float("nan")}, 1, 1),
        (Rule(R.IN_SET, {"column": "anomaly", "value_set": ["low_risk"]}), {"anomaly": "x"}, 0, 1),
        (Rule(R.IN_SET, {"column": "anomaly", "value_set": ["low_risk"]}), {"anomaly": None}, 1, 0),
        (Rule(R.BETWEEN, {"column": "amount", "min_value": 0, "strict_min": True}), {"amount": 0.0}, 0, 1),
        (Rule(R.BETWEEN, {"column": "amount", "min_value": 0}), {"amount": 0.0}, 0, 0),
        (Rule(R.BETWEEN, {"column": "risk_score", "min_value": 0, "max_value": 100}), {"risk_score": 100.5}, 0, 1),
        (Rule(R.BETWEEN, {"column": "risk_score", "max_value": 100, "strict_max": True}), {"risk_score": 100.0}, 0, 1),
        (Rule(R.BETWEEN, {"column": "risk_score", "max_value": 100}), {"risk_score": float("nan")}, 1, 0),
        (Rule(R.BETWEEN, {"column": "login_frequency", "min_value": 0}), {"login_frequency": -1}, 0, 1),
        (Rule(R.REGEX, {"column": "ip_prefix", "regex": "^172"}), {"ip_prefix": "10.1"}, 0, 1),
        (Rule(R.REGEX, {"column": "ip_prefix", "regex": "^172"}), {"ip_prefix": None}, 1, 0),
    ],
    ids=str,
)
def test_single_rules(cleaned, rule, changes, missing, unexpected):
    got = outcome(cleaned(clean_row(), clean_row(**changes)), rule)
    assert (got.element_count, got.missing_count, got.unexpected_count) == (2, missing, unexpected)
    assert got.success == (unexpected == 0)


@pytest.mark.parametrize(
    "low, high, off", [(1, 5, 0), (3, 5, 0), (4, None, 1), (None, 1, 2), (None, None, 0)]
)
def test_row_count_rule(cleaned, low, high, off):
    rule = Rule(R.ROW_COUNT, {"min_value": low, "max_value": high})
    got = outcome(cleaned(*[clean_row()] * 3), rule)
    assert (got.success, got.unexpected_count) == (off == 0, off)


def test_the_suite_has_nineteen_rules(cleaned):
    results = dq_suite_results(cleaned(clean_row()))
    assert summarise(results).first().asDict() == {
        "success": True,
        "evaluated_expectations": 19,
        "successful_expectations": 19,
        "unsuccessful_expectations": 0,
    }
    assert [r.position for r in results.collect()] == list(range(1, 20))


def test_an_empty_table_fails_only_the_row_count(cleaned):
    failed = dq_suite_results(cleaned()).where("NOT success").collect()
    assert [r.rule for r in failed] == [R.ROW_COUNT]


def test_gate(cleaned):
    good = dq_suite_results(cleaned(clean_row()))
    bad = dq_suite_results(cleaned(clean_row(risk_score=101.0, receiving_address="0xbad")))
    assert gate(good) is True
    assert gate(bad, raise_on_failure=False) is False
    with pytest.raises(DataQualityError, match=f"{R.BETWEEN}.*{R.REGEX}"):
        gate(bad)


def test_row_bound_is_a_parameter(cleaned):
    df = cleaned(clean_row(), clean_row())
    assert not gate(dq_suite_results(df, TransactionRules(max_rows=1)), False)
    assert gate(dq_suite_results(df, TransactionRules(max_rows=None)))


def test_suite_survives_json():
    suite = RULES.suite()
    assert suite_from_json(suite_to_json("transactions", suite)) == suite
    with pytest.raises(ValueError, match="Unsupported"):
        Rule("expect_magic", {})
    with pytest.raises(ValueError, match="needs"):
        Rule(R.IN_SET, {"column": "a"})


def test_result_store_keeps_runs_apart(cleaned, tmp_path):
    path = str(tmp_path / "store")
    results = dq_suite_results(cleaned(clean_row()))
    time = datetime(2024, 3, 1, tzinfo=timezone.utc)
    store_results(results, path, "a", time)
    store_results(results, path, "b", time)
    store = store_results(results, path, "a", time)
    counts = {r.run_id: r["count"] for r in store.groupBy("run_id").count().collect()}
    assert counts == {"a": 19, "b": 19}
    assert store.where(F.col("run_date") == "2024-03-01").count() == 38
