"""Readers see what was there before or what is there after, never neither."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest

from txspark.sinks import publish
from txspark.sinks.publish import get_document, published_runs, publish_tables, put_document, read_published
from txspark.sinks.tables import read_results, store_results

RUN_TIME = datetime(2024, 5, 6, 7, tzinfo=timezone.utc)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long").coalesce(1)


def seen(spark, path, table="t", run=None):
    return sorted(r.n for r in read_published(spark, path, table, run).collect())


def test_a_second_store_shows_the_old_run_until_all_of_it_is_there(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    publish_tables({"t": numbers(spark, 1), "u": numbers(spark, 10)}, path, "a")
    held = read_published(spark, path, "t")
    during = []
    original = publish.put_document

    def watched(folder, name, content):
        during.append((name, seen(spark, path), seen(spark, path, "u"), seen(spark, path, run="a")))
        original(folder, name, content)

    monkeypatch.setattr(publish, "put_document", watched)
    publish_tables({"t": numbers(spark, 2, 3), "u": numbers(spark)}, path, "a")
    # all data is written before the first document, and readers still have the old run
    assert [d[1:] for d in during] == [([1], [10], [1]), ([1], [10], [2, 3])]
    assert seen(spark, path) == seen(spark, path, run="a") == [2, 3] and seen(spark, path, "u") == []
    assert [r.n for r in held.collect()] == [1]  # a reader that began before goes on


def test_a_store_that_fails_leaves_the_old_run(spark, tmp_path):
    path = str(tmp_path)
    publish_tables({"t": numbers(spark, 1)}, path, "a")
    broken = spark.createDataFrame([("x",)], "s string").selectExpr("assert_true(s = 'y') AS n")
    with pytest.raises(Exception, match="is not true"):
        publish_tables({"u": numbers(spark, 5), "t": broken}, path, "a")
    assert seen(spark, path) == [1] and published_runs(path) == ["a"]


def test_runs_are_kept_apart(spark, tmp_path):
    path = str(tmp_path)
    ids = ["a/b", "a_b", "é", "x" * 300]
    for k, run in enumerate(ids):
        publish_tables({"t": numbers(spark, k)}, path, run)
    assert published_runs(path) == ids
    assert [seen(spark, path, run=r) for r in ids] == [[0], [1], [2], [3]]
    publish_tables({"t": numbers(spark, 9)}, path, "a/b")
    assert seen(spark, path) == [9] and published_runs(path)[-1] == "a/b"
    with pytest.raises(FileNotFoundError):
        read_published(spark, path, "t", "unknown")
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"), "t")


def test_data_nobody_names_goes_when_it_is_old(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    for v in range(4):
        publish_tables({"t": numbers(spark, v)}, path, "a")
    assert len(list((tmp_path / "data").iterdir())) == 4  # another writer's, for all one knows
    monkeypatch.setattr(publish, "GRACE_NS", 1)
    publish_tables({"t": numbers(spark, 4)}, path, "a")
    assert len(list((tmp_path / "data").iterdir())) == 2  # this one and the one before
    assert seen(spark, path) == [4]


def test_documents_are_replaced_in_one_step(tmp_path):
    for v in range(3):
        put_document(str(tmp_path), "d", {"v": v})
        assert get_document(str(tmp_path), "d") == {"v": v}
    assert [p.name for p in tmp_path.iterdir()] == ["d.json"]
    assert publish.documents(str(tmp_path)) == ["d"] and publish.documents(str(tmp_path / "none")) == []


def test_the_result_store_is_read_while_it_is_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    for run, value in (("a", 1), ("b", 2)):
        store = store_results(numbers(spark, value), path, run, RUN_TIME)
    assert sorted((r.run_id, r.n) for r in store.collect()) == [("a", 1), ("b", 2)]
    during = []
    original = publish.put_document
    monkeypatch.setattr(
        publish, "put_document", lambda *a: during.append(sorted((r.run_id, r.n) for r in read_results(spark, path).collect())) or original(*a)
    )
    store = store_results(numbers(spark, 7), path, "a", RUN_TIME)
    assert during[0] == [("a", 1), ("b", 2)]
    assert sorted((r.run_id, r.n) for r in store.collect()) == [("a", 7), ("b", 2)]
    # the plain copy holds the same
    assert sorted((r.run_id, r.n) for r in spark.read.parquet(path).collect()) == [("a", 7), ("b", 2)]
    with pytest.raises(FileNotFoundError):
        read_results(spark, str(tmp_path / "other"))
