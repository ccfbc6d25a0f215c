"""A dirty transaction relation derived from an `events` table, for checks and benchmarks.

The expressions use integer arithmetic and `md5` only, so that any SQL engine derives the
same rows. They plant every defect the cleaner handles, and ties in time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txspark.schema import COLUMNS
from txspark.sources.bytesplit import open_filesystem

ADDRESSES = ("sending_address", "receiving_address")

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]
EVENT_DDL = "event_id bigint, user_id bigint, event_type string, value double"

_SENDER = "substr(md5(CAST(user_id AS STRING)) || md5(CAST(user_id + 1 AS STRING)), 1, 40)"
_RECEIVER = (
    "substr(md5(CAST(event_id % 400 AS STRING)) || md5(CAST(event_id % 400 + 7 AS STRING)), 1, 40)"
)

RAW_EXPRESSIONS = {
    "timestamp": "1704067200 + ((event_id * 7919) % 720) * 3600",
    "sending_address": (
        "CASE WHEN event_id % 101 = 0 THEN NULL "
        f"WHEN event_id % 3 = 0 THEN ' 0x' || upper({_SENDER}) ELSE '0x' || {_SENDER} END"
    ),
    "receiving_address": f"CASE WHEN event_id % 211 = 0 THEN '0xbad' ELSE '0x' || {_RECEIVER} END",
    "amount": (
        "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -value "
        "WHEN event_id % 83 = 0 THEN 0e0 ELSE value END"
    ),
    "transaction_type": (
        "CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'transfer' "
        "WHEN 'error' THEN 'phishing' WHEN 'view' THEN 'SALE ' ELSE 'sale' END"
    ),
    "location_region": (
        "CASE WHEN event_id % 103 = 0 THEN '0' WHEN event_id % 107 = 0 THEN NULL "
        "WHEN user_id % 5 = 0 THEN 'Africa' WHEN user_id % 5 = 1 THEN 'North America' "
        "WHEN user_id % 5 = 2 THEN 'Asia' WHEN user_id % 5 = 3 THEN ' Europe' "
        "ELSE 'South America' END"
    ),
    "ip_prefix": "'192.' || CAST(user_id % 256 AS STRING)",
    "login_frequency": "CAST(event_id % 8 AS BIGINT)",
    "session_duration": "CAST(20 + event_id % 140 AS BIGINT)",
    "purchase_pattern": (
        "CASE WHEN event_id % 109 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'focused' "
        "WHEN event_id % 3 = 1 THEN 'random' ELSE 'high_value' END"
    ),
    "age_group": (
        "CASE WHEN event_id % 113 = 0 THEN 'New' WHEN user_id % 3 = 0 THEN 'new' "
        "WHEN user_id % 3 = 1 THEN 'established' ELSE 'veteran' END"
    ),
    "risk_score": (
        "CASE WHEN event_id % 127 = 0 THEN NULL "
        "ELSE CAST((event_id * 37) % 10001 AS DOUBLE) / 100e0 END"
    ),
    "anomaly": (
        "CASE event_id % 4 WHEN 0 THEN 'HIGH_RISK' WHEN 1 THEN 'moderate_risk' ELSE 'low_risk' END"
    ),
}

# Rows that occur twice.
DUPLICATED = "event_id % 50 = 0"

# How a missing number is spelled in the CSV form.
_TOKEN = "CASE event_id % 3 WHEN 0 THEN 'N/A' WHEN 1 THEN 'none' ELSE '' END"


def record_text(column: str) -> str:
    expr = f"({RAW_EXPRESSIONS[column]})"
    if column in ("amount", "risk_score"):
        return f"coalesce(CAST(CAST({expr} AS DECIMAL(18,2)) AS STRING), {_TOKEN})"
    return f"coalesce(CAST({expr} AS STRING), '')"


# One CSV record. No field holds a comma, a quote or a line break.
RECORD = " || ',' || ".join(record_text(c) for c in COLUMNS)

# The same relation as another exporter might write it: columns in another order and one more
# among them, fields in quotes that hold commas and quotes, NaN (in a spelling that is no null
# token), and no-break padding.
ODD_NAN = "event_id % 131 = 0"
ODD_PADDED = "event_id % 7 = 0"
ODD_NOTE = """'said "no, ' || CAST(event_id AS STRING) || '"'"""


def odd_text(column: str) -> str:
    if column == "note":
        return f"""'"' || replace({ODD_NOTE}, '"', '""') || '"'"""
    text = record_text(column)
    if column == "risk_score":
        return f"CASE WHEN {ODD_NAN} THEN 'NAN' ELSE {text} END"
    if column in ("location_region", "age_group"):
        padded = f"CASE WHEN {ODD_PADDED} AND {text} <> '' THEN '\u00a0' || {text} || '\u2003' ELSE {text} END"
        return f"""CASE WHEN event_id % 2 = 0 THEN '"' || {padded} || '"' ELSE {padded} END"""
    return text


_BACKWARDS = COLUMNS[::-1]
ODD_FORM = {c: odd_text(c) for c in [*_BACKWARDS[:5], "note", *_BACKWARDS[5:]]}

# A header that breaks the column contract.
LACKING = ("risk_score", "anomaly")
LACKING_FORM = {c: e for c, e in ODD_FORM.items() if c not in LACKING}

# Parts hold this many events.
EVENTS_PER_PART = 997


def part_name(number: int) -> str:
    return f"part_{number:08d}.csv"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*EVENT_COLUMNS)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream. The glob lets the table be one file or a folder."""
    return spark.readStream.schema(EVENT_DDL).parquet(f"{sf_dir}/event[s].parquet")


def events_bytes(sf_dir: str) -> int:
    """Stored size of the events table."""
    files, path = open_filesystem(f"{sf_dir}/events.parquet")
    info = files.get_file_info(path)
    if info.type == pafs.FileType.File:
        return info.size
    listed = files.get_file_info(pafs.FileSelector(path, recursive=True))
    return sum(f.size or 0 for f in listed)


def _with_copies(df: DataFrame) -> DataFrame:
    copies = f"explode(CASE WHEN {DUPLICATED} THEN array(1, 2) ELSE array(1) END) AS copy"
    return df.selectExpr("*", copies)


def transactions(events_df: DataFrame) -> DataFrame:
    """The raw relation. One scan: duplicates come from a generator, not from a union.

    The fields come from a one-row generator, which no filter passes: each is computed once,
    and not again in every condition on it.
    """
    fields = ", ".join(f"{e} AS {c}" for c, e in RAW_EXPRESSIONS.items())
    return _with_copies(events_df).selectExpr(f"inline(array(struct({fields})))")


def number_texts(events_df: DataFrame, columns: list[str]) -> DataFrame:
    """Number columns as spelled in the CSV form."""
    return _with_copies(events_df).selectExpr(*[f"{record_text(c)} AS {c}" for c in columns])


def csv_records(events_df: DataFrame, width: int, record: str = RECORD) -> DataFrame:
    """The raw relation as CSV records, with their place in the file sequence."""
    part = f"event_id DIV {width}"
    return _with_copies(events_df).selectExpr(
        "event_id", "copy", f"{part} AS part", f"{record} AS record"
    )


def _byte_pieces(events_df: DataFrame, record: str) -> DataFrame:
    """Records cut so that every part file but the last ends inside a record."""
    width = EVENTS_PER_PART
    ends_part = f"event_id % {width} = {width - 1} AND copy = last_copy"
    cut = "CAST(1 + event_id % (length(record) - 1) AS INT)"
    line = "concat(record, '\n')"
    pieces = f"""inline(CASE WHEN {ends_part} THEN array(
        struct(part, substr({line}, 1, {cut}) AS piece),
        struct(part + 1 AS part, substr({line}, {cut} + 1) AS piece))
      ELSE array(struct(part, {line} AS piece)) END)"""
    rows = csv_records(events_df, width, record).selectExpr(
        "*", f"CASE WHEN {DUPLICATED} THEN 2 ELSE 1 END AS last_copy"
    )
    return rows.selectExpr("event_id", "copy", pieces)


def write_byte_split(events_df: DataFrame, path: str, form: dict[str, str] | None = None) -> DataFrame:
    """Write the CSV form to `path` as part files cut inside records.

    form: the text of each field by column, in file order, where it is not the plain one.

    A part is written by the one task that owns its range and renamed into place, so a
    task that runs twice leaves the same file. Returns (file, size_bytes), evaluated once.
    """
    header = ",".join(form or COLUMNS) + "\n"
    record = " || ',' || ".join(form.values()) if form else RECORD
    # so that executors need no installed package
    cloudpickle.register_pickle_by_value(sys.modules[open_filesystem.__module__])

    def write(batches: Iterator) -> Iterator:
        import uuid

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        target, base = open_filesystem(path)
        target.create_dir(base, recursive=True)
        names, sizes = [], []
        number = out = temp = None

        def finish() -> None:
            final = f"{base}/part_{number:08d}.csv"
            out.close()
            target.move(temp, final)
            names.append(final.rsplit("/", 1)[1])

        for batch in batches:
            parts = batch.column("part").to_numpy()
            borders = np.flatnonzero(np.diff(parts)) + 1
            for begin, end in zip([0, *borders], [*borders, len(parts)], strict=True):
                if begin == end:
                    continue
                if parts[begin] != number:
                    if out is not None:
                        finish()
                    number = int(parts[begin])
                    temp = f"{base}/_{number}-{uuid.uuid4().hex}"
                    out = target.open_output_stream(temp)
                    sizes.append(0)
                    if number == 0:
                        out.write(header.encode())
                        sizes[-1] += len(header)
                run = batch.column("piece").slice(int(begin), int(end - begin)).cast(pa.large_string())
                whole = pa.LargeListArray.from_arrays(pa.array([0, len(run)], pa.int64()), run)
                data = pc.binary_join(whole, pa.scalar("", pa.large_string()))[0].as_buffer()
                out.write(data)
                sizes[-1] += data.size
        if out is not None:
            finish()
        yield pa.RecordBatch.from_pydict(
            {"file": pa.array(names, pa.string()), "size_bytes": pa.array(sizes, pa.int64())}
        )

    pieces = (
        _byte_pieces(events_df, record)
        .repartitionByRange("part")
        .sortWithinPartitions("part", "event_id", "copy")
        .select("part", "piece")
    )
    pieces.mapInArrow(write, "file string, size_bytes bigint").write.mode("overwrite").parquet(
        f"{path}_manifest"
    )
    return events_df.sparkSession.read.parquet(f"{path}_manifest")


def without_bad_receivers(raw: DataFrame) -> DataFrame:
    """The raw relation without the rows planted to fail the quality gate."""
    return raw.where(F.col("receiving_address") != "0xbad")
