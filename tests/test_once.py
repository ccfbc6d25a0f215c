"""Derived input and parsed records are computed once a row, and stream batches stay divided."""

import re

from pyspark.sql import functions as F

from txspark import fixtures
from txspark.plans.clean import valid_rows
from txspark.registry import queries
from txspark.schema import COLUMNS
from txspark.sources.lines import parse_csv


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events_of(spark, count):
    return spark.range(count).selectExpr(
        "id AS event_id", "id % 90 AS user_id", "element_at(array('purchase', 'signup', 'view', 'click'), "
        "CAST(id % 4 + 1 AS INT)) AS event_type", "CAST(id % 50 + 1 AS DOUBLE) AS value"
    )


def test_filters_do_not_derive_fields_again(spark):
    plan = plan_of(valid_rows(fixtures.transactions(events_of(spark, 10))))
    assert plan.count("md5(") == sum(e.count("md5(") for e in fixtures.RAW_EXPRESSIONS.values())


def test_filters_do_not_parse_a_line_again(spark):
    lines = fixtures.csv_records(events_of(spark, 10), 5).select(F.col("record").alias("value"))
    assert len(re.findall("from_csv", plan_of(valid_rows(parse_csv(lines, COLUMNS))))) == 1


def test_batches_have_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "EVENTS_PER_FILE", 50)
    events_of(spark, 1000).write.parquet(f"{tmp_path}/sf/events.parquet")
    stream = queries._out_of_order(spark, f"{tmp_path}/sf", f"{tmp_path}/base")
    files = sorted((tmp_path / "base" / "events").glob("part-*.parquet"))
    assert len(files) == queries.BATCHES * 5
    assert max(spark.read.parquet(str(f)).count() for f in files) <= 100
    query = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == queries.BATCHES and max(batches) < 400
