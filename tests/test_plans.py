"""Plan shapes that have to hold at any scale."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

import pytest
from conftest import HEADER, clean_row, csv_line, raw_row

from txspark.plans.clean import clean, cleaning_metrics
from txspark.plans.quality import dq_suite_results, quality_profile
from txspark.plans.tables import region_risk, top_receivers
from txspark.rules import RULES
from txspark.sources.lines import read_transactions
from txspark.streaming.live import latest_sales


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def operators(text: str) -> list[str]:
    """Operator names of the plan tree, outermost first."""
    tree = text.split("\n\n")[0]
    return re.findall(r"([A-Z]\w+(?: parquet)?) +\(\d+\)", tree)


def read_columns(text: str) -> set[str]:
    (schema,) = set(re.findall(r"ReadSchema: struct<(.*?)>", text))
    return {field.split(":")[0] for field in schema.split(",")}


@pytest.fixture
def stored_raw(spark, raw, tmp_path):
    raw(raw_row()).write.parquet(str(tmp_path / "raw"))
    return spark.read.parquet(str(tmp_path / "raw"))


@pytest.fixture
def stored_clean(spark, cleaned, tmp_path):
    cleaned(clean_row()).write.parquet(str(tmp_path / "clean"))
    return spark.read.parquet(str(tmp_path / "clean"))


def test_cleaning_filters_before_its_only_shuffle(stored_raw):
    text = plan(clean(stored_raw))
    names = operators(text)
    assert names.count("Exchange") == 1
    assert names.index("Filter") > names.index("Exchange")
    pushed = text.split("PushedFilters")[1].split("\n")[0]
    assert "GreaterThan(amount,0.0)" in pushed
    for column in RULES.critical:
        assert f"IsNotNull({column})" in pushed


def test_raw_metrics_shuffle_distinct_rows_once(stored_raw, stored_clean):
    text = plan(cleaning_metrics(stored_raw, stored_clean))
    main = text.split("===== Subqueries =====")[0]
    assert operators(main).count("Scan parquet") == 1
    # The partial aggregate collapses copies before they travel.
    assert operators(main).count("Exchange") == 2
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_stored_clean_rows_are_counted_without_reading_columns(stored_raw, stored_clean):
    text = plan(cleaning_metrics(stored_raw, stored_clean))
    assert "ReadSchema: struct<>" in text.split("===== Subqueries =====")[1]


def test_quality_is_one_narrow_scan(stored_clean):
    for df in (quality_profile(stored_clean), dq_suite_results(stored_clean)):
        names = operators(plan(df))
        assert names.count("Scan parquet") == 1
        assert "Sort" not in names and "Window" not in names


def test_region_table_reads_two_columns(stored_clean):
    text = plan(region_risk(stored_clean))
    assert read_columns(text) == {"location_region", "risk_score"}


def test_latest_sale_is_limited_before_the_shuffle(stored_clean):
    text = plan(top_receivers(stored_clean))
    names = operators(text)
    assert names[1] == "TakeOrderedAndProject"
    assert names.count("Exchange") == 1
    inner = names[names.index("Exchange") :]
    assert "WindowGroupLimit" in inner
    assert "EqualTo(transaction_type,sale)" in text
    assert read_columns(text) == {"receiving_address", "amount", "timestamp", "transaction_type"}


def test_stream_form_needs_no_more_shuffles(stored_clean):
    assert operators(plan(latest_sales(stored_clean))).count("Exchange") == 1


def test_parsing_is_one_narrow_stage(spark, parts_dir):
    df = read_transactions(spark, parts_dir(HEADER + "\n" + csv_line(raw_row())))
    text = plan(df)
    names = operators(text)
    assert "Exchange" not in names
    assert text.count("from_csv(") == 1


def test_no_row_at_a_time_python(stored_raw, stored_clean):
    for df in (clean(stored_raw), quality_profile(stored_clean), top_receivers(stored_clean)):
        assert "Python" not in plan(df)
