"""Listings of part files kept in storage.

With one, ranges of a plan carry no names, so a plan of a hundred thousand parts is as small
for each task as a plan of one. It also says later what a table was made from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from txspark.sinks.publish import new_name
from txspark.sources import bytesplit
from txspark.sources.bytesplit import Part, fingerprint, open_filesystem
from txspark.sources.lines import register

PARTS_PER_BLOCK = 4096
COLUMNS = pa.schema(
    [("name", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("modified", pa.int64()), ("sample", pa.string())]
)
LISTING_DDL = "name string, start bigint, size bigint, modified bigint, sample string"


def store_listing(parts: Sequence[Part], folder: str, per_block: int = PARTS_PER_BLOCK) -> str:
    """Keep a listing in a new folder below `folder`; returns its path. The index comes last."""
    path = f"{folder.rstrip('/')}/{new_name()}"
    files, base = open_filesystem(path)
    files.create_dir(base, recursive=True)
    first, blocks = [], []
    for at in range(0, len(parts), per_block):
        some = parts[at : at + per_block]
        name = f"block-{len(blocks):08d}.parquet"
        columns = [list(c) for c in zip(*(p.fields for p in some), strict=True)]
        pq.write_table(pa.table(columns, schema=COLUMNS), f"{base}/{name}", filesystem=files)
        first.append(some[0].start)
        blocks.append(name)
    known = {"total": str(parts[-1].end), "parts": str(len(parts)), "fingerprint": fingerprint(parts)}
    index = pa.table({"first": pa.array(first, pa.int64()), "block": pa.array(blocks, pa.string())})
    pq.write_table(index.replace_schema_metadata(known), f"{base}/index.parquet", filesystem=files)
    return path


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """A stored listing as a table."""
    return spark.read.schema(LISTING_DDL).parquet(f"{path}/block-*.parquet")


def with_samples(spark: SparkSession, folder: str, parts: Sequence[Part]) -> list[Part]:
    """The parts with samples of their bytes, taken by the executors."""
    register(spark)
    by_value, path = bytesplit, folder

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = by_value.open_filesystem(path)
        for batch in batches:
            found = []
            for name, size in zip(batch.column("name").to_pylist(), batch.column("size").to_pylist(), strict=True):
                with files.open_input_file(f"{base}/{name}") as handle:
                    if handle.size() != size:
                        raise OSError(f"{name} has changed since it was listed")
                    found.append(by_value.sample_of(handle, size))
            yield pa.RecordBatch.from_pydict({"name": batch.column("name"), "sample": pa.array(found, pa.string())})

    names = spark.createDataFrame([(p.name, p.size) for p in parts], "name string, size bigint")
    spread = names.repartition(spark.sparkContext.defaultParallelism)
    samples = {r["name"]: r["sample"] for r in spread.mapInArrow(take, "name string, sample string").collect()}
    return [Part(p.name, p.start, p.size, p.modified, samples[p.name]) for p in parts]
