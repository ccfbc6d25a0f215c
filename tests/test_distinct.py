"""Deduplication by runs: exact whatever the order of arrival, with little in memory."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from conftest import raw_row
from pyspark.sql import functions as F

from txspark.plans.clean import clean, valid_rows
from txspark.plans.tables import region_order, region_risk
from txspark.schema import COLUMNS, RAW_SCHEMA
from txspark.streaming import distinct, live, lookup
from txspark.streaming.runs import Manifest, Run, RunStore


def keys_of(n: int, seed: int = 0) -> np.ndarray:
    rng = random.Random(seed)
    return lookup.as_keys([rng.randbytes(32) for _ in range(n)])


def test_filters_know_all_their_keys_and_few_others():
    for n in (1, 2, 50, 4000):
        own, other = keys_of(n), keys_of(20_000, seed=1)
        bits = lookup.bloom(own)
        assert lookup.may_hold(bits, own).all()
        assert lookup.may_hold(bits, other).mean() < 0.02
    assert len(lookup.as_keys([])) == 0


def test_keys_that_end_in_zeros_stay_apart():
    keys = lookup.as_keys([bytes(32), bytes(31) + b"\x01", b"\x01" + bytes(31)])
    assert len({k.tobytes() for k in keys}) == 3


@pytest.fixture
def arrive(spark, tmp_path):
    """Adds rows to a folder and runs a stream over it."""
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))

    def run(rows, start=distinct.start_distinct, **options):
        if rows:
            df = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], RAW_SCHEMA)
            df.coalesce(1).write.mode("append").parquet(source)
        stream = valid_rows(spark.readStream.schema(RAW_SCHEMA).parquet(source))
        start(stream, table, checkpoint, buckets=3, **options).awaitTermination()
        return table, spark.read.parquet(source)

    return run


def dirty(rng: random.Random, n: int) -> list[dict]:
    return [
        raw_row(
            timestamp=1_700_000_000 + rng.randrange(30) * 86_400,
            login_frequency=rng.randrange(4),
            amount=rng.choice([None, 5.0, 6.0]),
            risk_score=rng.choice([None, 10.25, 70.5]),
            location_region=rng.choice(["Asia", " Europe", "9"]),
            purchase_pattern=rng.choice([None, "random"]),
        )
        for _ in range(n)
    ]


def test_rows_in_any_order_of_time_are_kept_once(spark, arrive):
    rng = random.Random(5)
    for n in (40, 1, 60, 0, 50, 30, 40, 25):
        table, raw = arrive(dirty(rng, n))
        got, expected = distinct.read_distinct(spark, table), clean(raw)
        assert got.columns == expected.columns
        assert got.count() == expected.count() > 0
        assert got.exceptAll(expected).isEmpty()
    # runs have been merged, and each row is in one of them
    runs = distinct.DistinctRows(spark, table, got.schema).store.newest().runs
    assert max(r.level for r in runs) >= 1 and sum(r.rows for r in runs) == got.count()
    assert set(os.listdir(f"{table}/runs")) >= {r.name for r in runs}


def test_region_risk_equals_the_batch_after_every_arrival(spark, arrive):
    rng = random.Random(6)
    for n in (50, 30, 1, 45, 60):
        table, raw = arrive(dirty(rng, n), distinct.start_region_risk)
        assert live.read_table(spark, table).orderBy(*region_order()).collect() == region_risk(clean(raw)).collect()
    assert len(os.listdir(f"{table}/sums")) <= 4


@pytest.mark.parametrize("after", [False, True])
def test_a_repeated_batch_loses_and_doubles_nothing(spark, arrive, monkeypatch, after):
    rng = random.Random(7)
    arrive(dirty(rng, 40), distinct.start_region_risk)
    publish = RunStore.publish

    def fails(self, manifest):
        if after:
            publish(self, manifest)
        raise RuntimeError("broken off")

    monkeypatch.setattr(RunStore, "publish", fails)
    with pytest.raises(Exception, match="broken off"):
        arrive(dirty(rng, 40), distinct.start_region_risk)
    monkeypatch.setattr(RunStore, "publish", publish)
    table, raw = arrive(dirty(rng, 20), distinct.start_region_risk)
    assert distinct.read_distinct(spark, table).exceptAll(clean(raw)).isEmpty()
    assert distinct.read_distinct(spark, table).count() == clean(raw).count()
    assert live.read_table(spark, table).orderBy(*region_order()).collect() == region_risk(clean(raw)).collect()


def test_look_ups_read_only_what_may_hold_a_key(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], "row_key binary, n long").schema
    store = RunStore(spark, str(tmp_path), schema, "row_key", buckets=2, filters=True)
    rows = spark.range(40_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("row_key"), F.col("id").alias("n"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    run = store.write(store.bucketed(rows), "a")
    assert run == Run("a", 0, 40_000)
    held = {b: [bytes(r["row_key"]) for r in store.read([run], [b]).collect()] for b in (0, 1)}
    assert all(held.values()) and sum(map(len, held.values())) == 40_000
    assert all(k == sorted(k) for k in held.values())
    for b in (0, 1):
        where = [(f"{tmp_path}/runs/a", f"{tmp_path}/filters/a")]
        mixed = lookup.as_keys(held[b][::97] + [k.tobytes() for k in keys_of(300, seed=b)])
        fresh = lookup.unseen(mixed, b, where, "row_key")
        assert not fresh[: len(held[b][::97])].any() and fresh[len(held[b][::97]) :].all()
        # keys below and above all that is stored touch no row group
        read = []
        original = lookup.pq.ParquetFile.read_row_group
        monkeypatch.setattr(lookup.pq.ParquetFile, "read_row_group", lambda self, g, **k: read.append(g) or original(self, g, **k))
        outside = lookup.as_keys([bytes(32), b"\xff" * 32])
        assert not lookup.held(where[0][0], b, "row_key", outside).any() and read == []
        monkeypatch.undo()
    asked = spark.createDataFrame([(bytes(held[0][0]), 0), (b"\x07" * 32, 0)], "row_key binary, bucket int")
    assert [bytes(r[0]) for r in store.unseen(asked, [run, Run("none", 0, 0)]).collect()] == [b"\x07" * 32]
    assert store.unseen(asked, []).count() == 2


def test_batches_of_another_checkpoint_are_an_error(spark, tmp_path):
    schema = spark.createDataFrame([], "k binary").schema
    store = RunStore(spark, str(tmp_path), schema, "k", buckets=1)
    store.publish(Manifest(store.name_of(0, 0), 0))
    store.publish(Manifest(store.name_of(0, 1), 1))
    assert store.before(2, store.name_of(1, 2)).batch == 1
    assert store.before(1, store.name_of(1, 1)).batch == 0  # a repeated batch
    assert store.before(0, store.name_of(1, 0)).batch == -1  # a fresh checkpoint
    assert store.next_start() == 1
    with pytest.raises(ValueError, match="does not hold batch 6"):
        store.before(7, store.name_of(1, 7))
    with pytest.raises(ValueError, match="bucket"):
        RunStore(spark, str(tmp_path), spark.createDataFrame([], "bucket int").schema, "bucket")
