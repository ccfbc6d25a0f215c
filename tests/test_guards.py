"""What must fail loudly, stay whole, or not depend on the session."""

from __future__ import annotations

from datetime import datetime, timezone
from pathlib import Path

import pytest
from conftest import HEADER, csv_line, raw_row
from pyspark.sql import functions as F

from txspark.functions.predicates import matches, strict_end
from txspark.functions.rowkey import row_hashes, row_key
from txspark.operators.dedupe import count_copies
from txspark.operators.expectations import run_suite
from txspark.rules import BETWEEN, NOT_NULL, Rule, TransactionRules, suite_from_json, suite_to_json
from txspark.sinks.tables import store_results
from txspark.sources.bytesplit import fingerprint, find_parts
from txspark.sources.ingest import ingest
from txspark.sources.lines import read_lines, read_transactions


def test_every_closing_anchor_is_strict(spark):
    assert strict_end(r"^(ab$|cd$)") == r"^(ab\z|cd\z)"
    assert strict_end(r"a\$") == r"a\$"
    assert strict_end(r"a\\$") == r"a\\\z"
    assert strict_end(r"[$]x$") == r"[$]x\z"
    assert strict_end(r"\Qa$\E$") == r"\Qa$\E\z"
    df = spark.createDataFrame([("ab\n",), ("ab",), ("cd",)], "t string")
    assert df.where(matches("t", "^(ab$|cd$)")).count() == 2


def test_suites_know_mostly_and_refuse_what_they_do_not_know(spark):
    df = spark.createDataFrame([(1.0,), (None,), (30.0,)], "v double")
    suite = [
        Rule(NOT_NULL, {"column": "v", "mostly": 0.5}),
        Rule(NOT_NULL, {"column": "v", "mostly": 0.7}),
        Rule(BETWEEN, {"column": "v", "max_value": 10, "mostly": 0.5}),
        Rule(BETWEEN, {"column": "v", "max_value": 10, "mostly": 0.6}),
    ]
    again = suite_from_json(suite_to_json("s", suite))
    assert [r.success for r in run_suite(df, again).orderBy("position").collect()] == [True, False, True, False]
    with pytest.raises(ValueError, match="does not know"):
        Rule(NOT_NULL, {"column": "v", "parse_strings": True})
    with pytest.raises(ValueError, match="mostly"):
        Rule(NOT_NULL, {"column": "v", "mostly": 2})
    assert TransactionRules().max_rows is None


def test_row_keys_tell_rows_apart(spark):
    rows = [("a", "bc", 0.0), ("ab", "c", 0.0), (None, "-", 0.0), ("-", None, 0.0), ("a", "bc", -0.0), ("a", "bc", float("nan"))]
    df = spark.createDataFrame(rows, "x string, y string, v double")
    assert df.select(row_key(df.schema)).distinct().count() == 5
    copies = count_copies(df, bad="v > 0").collect()
    assert sorted(r["copies"] for r in copies) == [1, 1, 1, 1, 2]


def test_row_hashes_tell_rows_apart(spark):
    rows = [(x, y, z) for x in (None, "", "0", "1", "a") for y in (None, "", "0", "1", "a") for z in (None, 0, 1, 42)]
    df = spark.createDataFrame(rows, "x string, y string, z long")
    for h in row_hashes(df.schema):
        assert df.select(h).distinct().count() == len(rows)
    one, two = row_hashes(df.schema)
    assert df.where(one == two).count() == 0


def test_a_part_that_changes_is_an_error(spark, parts_dir, tmp_path):
    folder = parts_dir("h\n1\n", "2\n3\n")
    listed = fingerprint(find_parts(folder))
    assert read_lines(spark, folder, listing=listed).count() == 3
    Path(folder, "part_002.csv").write_bytes(b"4\n")
    with pytest.raises(Exception, match="changed"):
        read_lines(spark, folder, listing=listed).count()
    data = parts_dir(HEADER + "\n", csv_line(raw_row()) + "\n")
    parts = find_parts(data)
    Path(data, "part_001.csv").write_bytes((csv_line(raw_row()) + "\n").encode() * 2)
    with pytest.raises(Exception, match="changed"):
        ingest(spark, data, str(tmp_path / "raw"), parts=parts)


def test_a_run_stored_on_two_days_stays_one(spark, tmp_path):
    results = spark.createDataFrame([("rule", True)], "rule string, success boolean")
    for day in (1, 2):
        store = store_results(results, str(tmp_path / "s"), "r", datetime(2024, 1, day, tzinfo=timezone.utc))
    assert store.count() == 1


def test_bad_integers_fail_without_strict_casts(spark, parts_dir):
    folder = parts_dir(HEADER + "\n", csv_line(raw_row(timestamp="soon")) + "\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="no integer"):
            read_transactions(spark, folder).select(F.col("timestamp")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
