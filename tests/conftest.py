"""One Spark session and builders for small relations."""

from __future__ import annotations

import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from txspark.schema import CLEAN_SCHEMA, COLUMNS, RAW_SCHEMA  # noqa: E402
from txspark.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("txspark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def raw_row(**changes):
    row = {
        "timestamp": 1_700_000_000,
        "sending_address": "0x" + "a1" * 20,
        "receiving_address": "0x" + "b2" * 20,
        "amount": 12.5,
        "transaction_type": "sale",
        "location_region": "Asia",
        "ip_prefix": "172.16",
        "login_frequency": 4,
        "session_duration": 90,
        "purchase_pattern": "random",
        "age_group": "veteran",
        "risk_score": 31.25,
        "anomaly": "low_risk",
    }
    unknown = set(changes) - set(row)
    assert not unknown, unknown
    return row | changes


def at(day: int, hour: int = 0) -> datetime:
    return datetime(2024, 3, day, hour, tzinfo=timezone.utc)


def clean_row(**changes):
    return raw_row(timestamp=at(1)) | changes


def csv_line(row) -> str:
    return ",".join("" if row[c] is None else str(row[c]) for c in COLUMNS)


HEADER = ",".join(COLUMNS)


@pytest.fixture
def raw(spark):
    return lambda *rows: spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], RAW_SCHEMA)


@pytest.fixture
def cleaned(spark):
    return lambda *rows: spark.createDataFrame(
        [tuple(r[c] for c in COLUMNS) for r in rows], CLEAN_SCHEMA
    )


@pytest.fixture
def parts_dir(tmp_path):
    """Write byte strings as consecutive parts."""

    def write(*chunks: bytes | str) -> str:
        folder = tmp_path / "parts"
        folder.mkdir(exist_ok=True)
        for i, chunk in enumerate(chunks):
            data = chunk.encode() if isinstance(chunk, str) else chunk
            (folder / f"part_{i:03d}.csv").write_bytes(data)
        return str(folder)

    return write
