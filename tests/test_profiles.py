"""Profiles of parts add up to that of the whole; breaking values are counted exactly."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import clean_row, raw_row

from txspark.operators.unexpected import merged_sketches, sketches, unexpected_values
from txspark.plans import profiles
from txspark.plans.clean import clean, valid_rows
from txspark.plans.profiles import ProfileStore, start_quality
from txspark.plans.quality import QualityReport, quality_profile
from txspark.rules import BETWEEN, IN_SET, NOT_NULL, REGEX, RULES, ROW_COUNT, Rule, TransactionRules
from txspark.schema import CLEAN_SCHEMA, COLUMNS, RAW_SCHEMA
from txspark.sinks.publish import read_published


def rows_of(spark, rng, n):
    made = [
        clean_row(
            amount=rng.choice([None, -1.0, 5.0]),
            age_group=rng.choice([None, "new", "old", "ancient"]),
            risk_score=rng.choice([None, 5.0, 101.0, float("nan")]),
            anomaly=rng.choice([None, "low_risk", "odd"]),
            sending_address=rng.choice(["0x" + "a" * 40, "0xbad", "x"]),
            login_frequency=rng.randrange(9),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in made], CLEAN_SCHEMA)


def same(a, b):
    order = sorted(a.columns)
    assert order == sorted(b.columns)
    assert sorted(map(str, a.select(order).collect())) == sorted(map(str, b.select(order).collect()))


def test_merged_profiles_equal_one_scan(spark, tmp_path):
    rng = random.Random(1)
    parts = {f"part-{i}": rows_of(spark, rng, n) for i, n in enumerate((30, 0, 1, 45))}
    store = ProfileStore(spark, str(tmp_path))

    def check():
        whole = None
        for df in parts.values():
            whole = df if whole is None else whole.union(df)
        report, expected = store.report(), QualityReport(quality_profile(whole))
        for view in ("metrics", "results", "null_profile", "anomaly_breakdown"):
            same(getattr(report, view)(), getattr(expected, view)())
        same(store.unexpected(), unexpected_values(whole, RULES.suite()))

    for slot, df in parts.items():
        store.put(slot, df)
    check()
    parts["part-0"] = rows_of(spark, rng, 12)  # a part that comes again
    store.put("part-0", parts["part-0"])
    check()
    store.fold(["part-1", "part-3"], "old")
    assert sorted(store.slots) == ["old", "part-0", "part-2"]
    check()
    store.put("part-9", rows_of(spark, rng, 5), reset=True)
    assert store.slots == ["part-9"]
    assert len(list((tmp_path / "data").iterdir())) <= 5
    with pytest.raises(ValueError, match="other rules"):
        ProfileStore(spark, str(tmp_path), TransactionRules(risk_range=(0, 50))).merged()
    with pytest.raises(FileNotFoundError):
        ProfileStore(spark, str(tmp_path / "none")).merged()


SUITE = [
    Rule(ROW_COUNT, {"min_value": 1}),
    Rule(IN_SET, {"column": "v", "value_set": ["fine"]}),
    Rule(NOT_NULL, {"column": "v"}),
    Rule(REGEX, {"column": "v", "regex": "^f"}),
    Rule(BETWEEN, {"column": "x", "min_value": 0, "max_value": 9}),
]


def values(spark, texts):
    return spark.createDataFrame([(t, float(len(t or ""))) for t in texts], "v string, x double").repartition(3)


def told(df):
    return [(r["position"], r["value"], r["unexpected_count"], r["certain"]) for r in df.collect()]


def test_all_breaking_values_with_their_counts(spark):
    texts = ["fine"] * 50 + ["foul"] * 5 + ["bad"] * 7 + ["ant"] * 7 + [None] * 4 + ["a very long one"] * 2
    got = told(unexpected_values(values(spark, texts), SUITE, 3))
    assert got == [
        (2, "ant", 7, True), (2, "bad", 7, True), (2, "foul", 5, True),
        (4, "ant", 7, True), (4, "bad", 7, True), (4, "a very long one", 2, True),
        (5, "15.0", 2, True),
    ]
    assert told(unexpected_values(values(spark, ["fine"]), SUITE)) == []
    assert told(unexpected_values(values(spark, []), SUITE)) == []


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([(float("nan"),), (-1.0,), (None,)], "x double")
    assert told(unexpected_values(df, [Rule(BETWEEN, {"column": "x", "min_value": 0})])) == [(1, "-1.0", 1, True)]


@pytest.mark.parametrize("seed", range(3))
def test_a_sketch_that_is_full_still_finds_the_frequent_ones(spark, seed):
    rng = random.Random(seed)
    texts = [f"rare{rng.randrange(10**6)}" for _ in range(3000)] + ["often"] * 900 + ["usual"] * 700 + [f"mid{i % 3}" for i in range(120)]
    rng.shuffle(texts)
    df = values(spark, texts)
    got = told(unexpected_values(df, SUITE[1:2], 4, tracked=60))
    exact = Counter(texts)
    assert got[:2] == [(1, "often", 900, True), (1, "usual", 700, True)]
    assert all(n == exact[v] for _, v, n, _ in got)
    bound = len(texts) * 3.5 / 60
    assert all(sure == (n > bound) for _, _, n, sure in got)
    # from stored sketches alone, nothing is certain
    taken = sketches(df.where("x > 5"), SUITE[1:2], 60).union(sketches(df.where("x <= 5"), SUITE[1:2], 60))
    alone = told(unexpected_values(None, SUITE[1:2], 4, merged_sketches(taken, SUITE[1:2], 60), 60))
    assert [v for _, v, _, _ in alone[:2]] == ["often", "usual"] and not any(sure for *_, sure in alone)


def test_the_gate_on_a_stream(spark, tmp_path, monkeypatch):
    """Each batch is judged with all before it, copies counted once; a refused batch does not count."""
    monkeypatch.setattr(profiles, "MOST_SLOTS", 3)
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rules = TransactionRules(max_rows=12)

    def run(rows, **options):
        if rows:
            df = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], RAW_SCHEMA)
            df.coalesce(1).write.mode("append").parquet(source)
        stream = valid_rows(spark.readStream.schema(RAW_SCHEMA).parquet(source))
        start_quality(stream, path, checkpoint, rules, buckets=2, **options).awaitTermination()

    def report(table="dq_results"):
        return read_published(spark, f"{path}/report", table)

    def some(a, b):
        return [raw_row(session_duration=i) for i in range(a, b)]

    for a, b in ((0, 4), (2, 6), (6, 7), (6, 9), (9, 10), (0, 11)):
        run(some(a, b))
        whole = clean(spark.read.parquet(source))
        same(report(), QualityReport(quality_profile(whole, rules), rules).results())
        same(report("dq_metrics"), QualityReport(quality_profile(whole, rules), rules).metrics())
    assert report().where("rule = 'expect_table_row_count_to_be_between'").first()["element_count"] == 11
    with pytest.raises(Exception, match="breaks 1 rules"):
        run(some(11, 20))
    # the report of the refused batch can be read, and the batch is judged again
    assert report().where("NOT success").count() == 1
    with pytest.raises(Exception, match="breaks 1 rules"):
        run([])
    run([], raise_on_failure=False)
    assert report().where("rule = 'expect_table_row_count_to_be_between'").first()["element_count"] == 20
    assert len(ProfileStore(spark, f"{path}/profiles", rules).slots) <= 4
