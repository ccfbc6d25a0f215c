"""Every registered query against its SQL on another engine, over the given tables."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from txspark.registry import oracle as registered_sql  # noqa: E402
from txspark.registry import queries as registered  # noqa: E402

duckdb = pytest.importorskip("duckdb")

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")

QUERIES = registered.queries()
EXPECTED = registered_sql.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in records)


def test_every_query_has_expected_rows():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, str(DATA))
    expected = oracle.execute(EXPECTED[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, expected.fetchall())


@pytest.mark.parametrize("name", ["region_risk", "top_receivers", "dq_suite_results"])
def test_order_is_part_of_the_result(spark, oracle, name):
    order = {
        "region_risk": "avg_risk_score DESC, location_region",
        "top_receivers": "amount DESC, receiving_address",
        "dq_suite_results": "position",
    }[name]
    got = [tuple(r) for r in QUERIES[name](spark, str(DATA)).collect()]
    assert got == oracle.execute(f"SELECT * FROM ({EXPECTED[name]}) ORDER BY {order}").fetchall()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["location_region", "avg_risk_score", "transaction_count"]
    assert df.count() == 5
