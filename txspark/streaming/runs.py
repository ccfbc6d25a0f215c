"""Keyed rows in shared storage that grow by runs.

Each batch of a stream adds one run: its rows, dealt to hash buckets and sorted by key in each.
Once `fan` runs of one level are there they become one run of the next level, so n batches
leave about fan * log(n) runs, and a row is rewritten log(n) times. A manifest names the runs
that count after a batch and is written last: a batch that is repeated after a failure starts
from the manifest before it and leaves the same state.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txspark.functions.sqltext import ident
from txspark.sinks.publish import documents, folders, get_document, put_document, remove_document, remove_folder
from txspark.sources import bytesplit
from txspark.streaming import lookup

KEPT_MANIFESTS = 3
# Small row groups, so that a look-up reads little more than what it asks for.
GROUP_BYTES = 8 << 20


@dataclass(frozen=True)
class Run:
    """A folder of rows; `level` counts how often they have been merged."""

    name: str
    level: int
    rows: int


@dataclass
class Manifest:
    """What counts after a batch."""

    name: str
    batch: int
    runs: list[Run] = field(default_factory=list)


class RunStore:
    """Rows of `schema`, addressed by the column `key`.

    combine: how the rows of one key become one when runs merge; None if keys never repeat.
    buckets stay the same for the life of a store; take as many as it will ever need.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        combine: Callable[[DataFrame], DataFrame] | None = None,
        buckets: int = 32,
        fan: int = 4,
        filters: bool = False,
    ) -> None:
        if "bucket" in schema.names:
            raise ValueError("A run store has a column `bucket` of its own")
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = schema
        self.stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        self.combine, self.buckets, self.fan, self.filters = combine, buckets, fan, filters

    # -- manifests

    @property
    def manifests(self) -> str:
        return f"{self.path}/manifests"

    def manifest(self, name: str) -> Manifest:
        content = get_document(self.manifests, name)
        return Manifest(content["name"], content["batch"], [Run(**r) for r in content["runs"]])

    def newest(self) -> Manifest | None:
        names = documents(self.manifests)
        return self.manifest(names[-1]) if names else None

    def next_start(self) -> int:
        """A number above all starts before: names of a new start sort behind all older ones."""
        known = documents(self.manifests)
        return int(known[-1].split("-")[0]) + 1 if known else 0

    @staticmethod
    def name_of(start: int, batch: int) -> str:
        return f"{start:010d}-{batch:019d}"

    def before(self, batch: int, name: str) -> Manifest:
        """The state that a batch builds on. Batch 0 belongs to a fresh checkpoint and starts
        from nothing, whatever an older query left; any other needs the batch before it."""
        if batch == 0:
            return Manifest("", -1)
        for known in reversed([n for n in documents(self.manifests) if n < name]):
            manifest = self.manifest(known)
            if manifest.batch < batch:
                if manifest.batch == batch - 1:
                    return manifest
                break
        raise ValueError(f"{self.path} does not hold batch {batch - 1} of this checkpoint")

    def publish(self, manifest: Manifest) -> None:
        """Merge what is due, write the manifest, and remove what no kept one names."""
        self._merge(manifest)
        content = {"name": manifest.name, "batch": manifest.batch, "runs": [asdict(r) for r in manifest.runs]}
        put_document(self.manifests, manifest.name, content)
        names = documents(self.manifests)
        for old in names[:-KEPT_MANIFESTS]:
            remove_document(self.manifests, old)
        used = {r.name for n in names[-KEPT_MANIFESTS:] for r in self.manifest(n).runs}
        for kind in ("runs", "filters"):
            for folder in folders(f"{self.path}/{kind}"):
                if folder not in used:
                    remove_folder(f"{self.path}/{kind}", folder)

    def _merge(self, manifest: Manifest) -> None:
        level = 0
        while True:
            same = [r for r in manifest.runs if r.level == level]
            if len(same) >= self.fan:
                rows = self.read(same)
                merged = self.write(self.combine(rows) if self.combine else rows, f"{manifest.name}-{level + 1}", level + 1)
                manifest.runs = [r for r in manifest.runs if r.level != level] + [merged]
            elif not any(r.level > level for r in manifest.runs):
                return
            level += 1

    # -- runs

    def bucketed(self, df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(ident(self.key)), F.lit(self.buckets)).cast("int")
        return df.select(*[F.col(ident(f.name)) for f in self.schema], bucket.alias("bucket"))

    def write(self, rows: DataFrame, name: str, level: int = 0) -> Run:
        """Rows with their bucket as a run; writing it again replaces it."""
        tasks = min(self.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        sorted_ = rows.repartition(tasks, "bucket").sortWithinPartitions("bucket", ident(self.key))
        writer = sorted_.write.mode("overwrite").option("parquet.block.size", GROUP_BYTES)
        writer.partitionBy("bucket").parquet(f"{self.path}/runs/{name}")
        run = Run(name, level, self.read([Run(name, level, 0)]).count())
        if self.filters:
            self._write_filters(run)
        return run

    def read(self, runs: list[Run], buckets: list[int] | None = None) -> DataFrame:
        """Rows of some runs, each key as often as runs hold it."""
        reader = self.spark.read.schema(self.stored)
        parts = [reader.parquet(f"{self.path}/runs/{r.name}") for r in runs]
        rows = reduce(DataFrame.union, parts) if parts else self.spark.createDataFrame([], self.stored)
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def _write_filters(self, run: Run) -> None:
        key, by_value = self.key, lookup
        self._ship()

        def build(group: pd.DataFrame) -> pd.DataFrame:
            bits = by_value.bloom(by_value.as_keys(group[key]))
            return pd.DataFrame({"bits": [bits], "bucket": group["bucket"].iloc[:1].to_numpy()})

        made = self.read([run]).select(ident(key), "bucket").groupBy("bucket").applyInPandas(build, "bits binary, bucket int")
        made.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/filters/{run.name}")

    def _ship(self) -> None:
        for module in (lookup, bytesplit):
            cloudpickle.register_pickle_by_value(sys.modules[module.__name__])

    def unseen(self, keys: DataFrame, runs: list[Run]) -> DataFrame:
        """Of (key, bucket) rows, one a key, those that no run holds.

        A task takes the keys of one bucket, asks each run's filter, and looks up only what a
        filter lets through. It holds one filter and one row group at a time.
        """
        key, by_value = self.key, lookup
        self._ship()
        where = [(f"{self.path}/runs/{r.name}", f"{self.path}/filters/{r.name}") for r in runs if r.rows]
        if not where:
            return keys

        def fresh(group: pd.DataFrame) -> pd.DataFrame:
            mask = by_value.unseen(by_value.as_keys(group[key]), int(group["bucket"].iloc[0]), where, key)
            return group[mask]

        return keys.groupBy("bucket").applyInPandas(fresh, keys.schema)

