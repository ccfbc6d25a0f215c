"""Sinks and whole runs."""

from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import HEADER, at, clean_row, csv_line, raw_row
from pyspark.sql import functions as F

from txspark.plans.pipeline import build_tables, run_pipeline
from txspark.plans.quality import DataQualityError
from txspark.schema import CLEAN_SCHEMA
from txspark.session import new_shared_dir, shuffle_partitions, sized_shuffles
from txspark.sinks.tables import PREVIEW_ROWS, export_csv, preview, write_table


def csv_text(folder: Path) -> list[str]:
    return [p.read_text() for p in sorted(folder.glob("*.csv"))]


def receiver(i: int) -> str:
    return f"0x{i:040x}"


def split_anywhere(text: str, size: int) -> list[str]:
    return [text[i : i + size] for i in range(0, len(text), size)]


@pytest.fixture
def small_run(spark, parts_dir, tmp_path):
    """Run the pipeline over rows cut every 61 bytes."""

    def run(rows, **options):
        text = "\n".join([HEADER, *map(csv_line, rows)]) + "\n"
        folder = parts_dir(*split_anywhere(text, 61))
        base = str(tmp_path)
        return run_pipeline(spark, folder, f"{base}/work", f"{base}/out", **options)

    return run


def test_write_table_replaces(cleaned, tmp_path):
    path = str(tmp_path / "a" / "b")
    write_table(cleaned(clean_row(), clean_row()), path)
    stored = write_table(cleaned(clean_row(amount=1.0)), path)
    assert [r.amount for r in stored.collect()] == [1.0]
    assert all(".snappy." in p.name for p in Path(path).glob("*.parquet"))


def test_an_empty_table_keeps_its_schema(cleaned, tmp_path):
    stored = write_table(cleaned(), str(tmp_path / "t"))
    assert stored.count() == 0
    assert stored.sparkSession.read.parquet(str(tmp_path / "t")).schema == CLEAN_SCHEMA


def test_csv_keeps_order_in_one_file_when_small(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n{i}") for i in (3, 1, 2)], "v int, name string")
    export_csv(df, str(tmp_path / "csv"), [F.desc("v")])
    assert csv_text(tmp_path / "csv") == ["v,name\n3,n3\n2,n2\n1,n1\n"]


def test_csv_of_many_rows_is_several_ordered_files(spark, tmp_path):
    noise = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(4)])
    df = spark.range(20_000).withColumn("text", noise)
    export_csv(df, str(tmp_path / "csv"), [F.desc("id")])
    files = csv_text(tmp_path / "csv")
    ids = [int(line.split(",")[0]) for f in files for line in f.splitlines()[1:]]
    assert len(files) > 1
    assert ids == list(range(19_999, -1, -1))


def test_preview_is_bounded(spark):
    assert len(preview(spark.range(5), 3)) == 3
    with pytest.raises(ValueError, match="at most"):
        preview(spark.range(5), PREVIEW_ROWS + 1)


def test_pipeline(small_run, spark, tmp_path):
    rows = [
        raw_row(receiving_address=receiver(1), amount=10.0, risk_score=20.0),
        raw_row(receiving_address=receiver(1), amount=10.0, risk_score=20.0),
        raw_row(receiving_address=receiver(2), amount=30.0, location_region="Europe"),
        raw_row(receiving_address=receiver(2), amount=99.0, timestamp=1_600_000_000),
        raw_row(amount=None),
        raw_row(location_region="17"),
    ]
    got = small_run(rows, run_id="r1")
    assert got["ingestion"].first().row_count == 6
    assert got["cleaning_metrics"].first().asDict() == {
        "total_raw": 6,
        "total_cleaned": 3,
        "total_dropped": 3,
        "duplicates_removed": 1,
        "null_critical_dropped": 1,
        "invalid_amount_dropped": 0,
    }
    assert got["dq_metrics"].first().compliance_pct == 100.0
    assert got["null_profile"].where("null_count > 0").count() == 0
    assert [tuple(r) for r in got["anomaly_breakdown"].collect()] == [("low_risk", 3)]
    assert [r.location_region for r in got["region_risk"].collect()] == ["Europe", "Asia"]
    assert [r.amount for r in got["top_receivers"].collect()] == [30.0, 10.0]
    assert got["result_store"].where("run_id = 'r1' AND success").count() == 19
    assert csv_text(tmp_path / "out" / "region_risk_csv") == [
        "location_region,avg_risk_score,transaction_count\nEurope,31.25,1\nAsia,25.625,2\n"
    ]
    assert csv_text(tmp_path / "out" / "top_receivers_csv")[0].splitlines()[1].startswith(
        f"{receiver(2)},30.0,2023-11-14T"
    )


def test_the_gate_stops_the_run_after_the_reports_are_stored(small_run, spark, tmp_path):
    with pytest.raises(DataQualityError, match="regex"):
        small_run([raw_row(), raw_row(sending_address="nobody")], run_id="bad")
    out = tmp_path / "out"
    assert not (out / "region_risk").exists()
    assert spark.read.parquet(str(out / "quality" / "metrics")).first().error_count == 1
    store = spark.read.parquet(str(out / "quality" / "results"))
    assert store.where("NOT success").count() == 1


def test_the_gate_may_only_report(small_run):
    got = small_run([raw_row(sending_address="nobody")], raise_on_failure=False)
    assert got["region_risk"].count() == 1


def test_empty_parts_stop_the_run(spark, parts_dir, tmp_path):
    folder = parts_dir(HEADER + "\n", "")
    with pytest.raises(ValueError, match="part_001.csv"):
        run_pipeline(spark, folder, str(tmp_path / "w"), str(tmp_path / "o"))
    assert not (tmp_path / "w").exists()


def test_build_tables_on_no_rows(cleaned, tmp_path):
    tables = build_tables(cleaned(), str(tmp_path / "out"))
    assert [t.count() for t in tables.values()] == [0, 0]


def test_top_k_is_a_parameter(cleaned, tmp_path):
    rows = [clean_row(receiving_address=receiver(i), timestamp=at(1), amount=i + 1.0) for i in range(5)]
    assert build_tables(cleaned(*rows), str(tmp_path), k=4)["top_receivers"].count() == 4


def test_shuffles_fit_the_input(spark):
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(1 << 40, 8) == 8192
    assert shuffle_partitions(100 << 40, 4000) == 819_200
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with pytest.raises(RuntimeError), sized_shuffles(spark, 1 << 40):
        assert spark.conf.get(key) == "8192"
        raise RuntimeError
    assert spark.conf.get(key, None) == before


def session_like(master: str, folder: str | None):
    conf = {"spark.checkpoint.dir": folder} if folder else {}
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_comes_from_the_session(spark):
    named = session_like("yarn", "/shared/place/")
    assert new_shared_dir(named, "x").startswith("/shared/place/x-")
    assert new_shared_dir(spark, "x") != new_shared_dir(spark, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_shared_dir(session_like("yarn", None), "x")
