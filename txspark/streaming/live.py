"""Result tables that stay current while parts arrive.

The region table runs in complete mode: every trigger replaces the whole table of a few
rows. Copies must not count twice in a mean; `distinct` has a form of it that keeps
the keys of distinct rows in shared storage instead of state. The receiver table takes a
maximum, which copies cannot change: it needs no deduplication. It runs in update mode, and a
batch costs what it changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from txspark.operators.ranking import top_k
from txspark.plans.tables import receiver_order, region_means, region_order, sales
from txspark.session import STREAM_CONF
from txspark.sinks.publish import documents, folders, remove_folder
from txspark.sources.bytesplit import open_filesystem
from txspark.streaming.runs import Manifest, RunStore

# Versions of a table that stay: the newest, and those a reader may still hold.
KEPT_VERSIONS = 3


@contextmanager
def stream_settings(spark: SparkSession, state_partitions: int | None = None) -> Iterator[None]:
    """Settings a query takes over when it starts; the session gets its own back."""
    wanted = dict(STREAM_CONF)
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class Drain:
    """A query that takes all its source may give and then ends.

    Batches keep the source's own limit; one checkpoint holds through all of them, so that a
    run that was broken off goes on where it stood. A bounded source (`bounded=True`) has a fixed
    end; without one the run ends as soon as nothing new is there.
    """

    def __init__(self, query: StreamingQuery) -> None:
        self.query = query

    def awaitTermination(self) -> StreamingQuery:  # noqa: N802, as in StreamingQuery
        """Returns the ended query; a failure of the query is raised."""
        try:
            self.query.processAllAvailable()
        finally:
            self.query.stop()
        return self.query

    def stop(self) -> None:
        self.query.stop()


def started(writer: DataStreamWriter, path: str | None = None, **trigger: object) -> StreamingQuery | Drain:
    """Start with the given trigger, or drain the source if there is none.

    `availableNow` is no way to drain a limited source: it ends after the first batch.
    """
    if trigger:
        return writer.trigger(**trigger).start(path)
    return Drain(writer.trigger(processingTime="0 seconds").start(path))


def start_table(
    aggregated: DataFrame,
    path: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame],
    state_partitions: int | None = None,
    **trigger: object,
) -> StreamingQuery | Drain:
    """Run a complete-mode aggregate and store `shape` of it after every trigger.

    Every version has a folder of its own, named by the start of the query and the batch, and
    counts as soon as Spark has marked it complete; a start always takes a higher number than
    all before it, also with a fresh checkpoint. Old versions go.
    """
    start = next_start(path)

    def store(batch: DataFrame, batch_id: int) -> None:
        write_version(shape(batch), path, start, batch_id)

    with stream_settings(aggregated.sparkSession, state_partitions):
        writer = aggregated.writeStream.outputMode("complete").foreachBatch(store)
        writer = writer.option("checkpointLocation", checkpoint)
        return started(writer, **trigger)


def next_start(path: str) -> int:
    known = _versions(path, complete=False)
    return int(known[-1].split("-")[1]) + 1 if known else 0


def write_version(table: DataFrame, path: str, start: int, batch: int) -> None:
    table.write.mode("overwrite").parquet(f"{path}/version-{start:010d}-{batch:019d}")
    files, base = open_filesystem(path)
    for old in _versions(path)[:-KEPT_VERSIONS]:
        files.delete_dir(f"{base}/{old}")


def _versions(path: str, complete: bool = True) -> list[str]:
    """Folders of versions, oldest first."""
    files, base = open_filesystem(path)
    found = files.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    names = sorted(f.base_name for f in found if f.base_name.startswith("version-"))
    if not complete:
        return names
    marks = files.get_file_info([f"{base}/{n}/_SUCCESS" for n in names])
    return [n for n, m in zip(names, marks, strict=True) if m.type == pafs.FileType.File]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version stored by `start_table`, also while it writes the next."""
    versions = _versions(path)
    if not versions:
        raise FileNotFoundError(f"No version of a table in {path}")
    return spark.read.parquet(f"{path}/{versions[-1]}")


def start_region_risk(
    cleaned: DataFrame, path: str, checkpoint: str, **options: object
) -> StreamingQuery | Drain:
    """Keep the regions by mean risk current in `path`."""
    return start_table(
        region_means(cleaned), path, checkpoint, lambda t: t.orderBy(*region_order()), **options
    )


def latest_sales(cleaned: DataFrame) -> DataFrame:
    """Latest sale per receiver as an aggregate, since streams have no ranking window."""
    newest = F.max(F.struct("timestamp", "amount"))
    latest = sales(cleaned).groupBy("receiving_address").agg(newest.alias("latest"))
    return latest.select("receiving_address", "latest.amount", "latest.timestamp")


def changed_sales(cleaned: DataFrame) -> DataFrame:
    """On a stream in update mode: receivers whose latest sale is new in the batch, and it.

    The state keeps with each latest sale the batch that brought it, the first one of equal
    sales; a receiver that only had older or equal sales in a batch is not handed on.
    """
    now = -F.unix_micros(F.current_timestamp())  # one instant for a whole batch, also when repeated
    rows = sales(cleaned).select("receiving_address", "timestamp", "amount", now.alias("brought"))
    sale = F.struct("timestamp", "amount", "brought")
    latest = rows.groupBy("receiving_address").agg(F.max(sale).alias("latest"))
    fresh = latest.where(F.col("latest.brought") == now)
    return fresh.select("receiving_address", "latest.amount", "latest.timestamp")


RECEIVERS = "receiving_address string, amount double, timestamp timestamp"


def _newest(rows: DataFrame) -> DataFrame:
    latest = rows.groupBy("receiving_address", "bucket").agg(F.max(F.struct("timestamp", "amount")).alias("latest"))
    return latest.select("receiving_address", "latest.amount", "latest.timestamp", "bucket")


class Leaders:
    """Latest sale of every receiver in runs, and the first k receivers of each hash bucket.

    A batch costs what it changes: its rows become a run, and a bucket's leaders come from its
    old leaders and its changed rows. Only where a leader's latest sale got smaller may a receiver
    that was behind move up; that bucket alone is read again.
    """

    def __init__(self, spark: SparkSession, path: str, k: int, buckets: int) -> None:
        schema = T._parse_datatype_string(RECEIVERS)
        self.store = RunStore(spark, path, schema, "receiving_address", _newest, buckets)
        self.spark, self.path, self.k = spark, path, k

    def leaders(self, manifest: Manifest) -> DataFrame:
        reader = self.spark.read.schema(self.store.stored)
        if manifest.batch < 0:
            return self.spark.createDataFrame([], self.store.stored)
        return reader.parquet(f"{self.path}/leaders/{manifest.name}")

    def merge(self, changed: DataFrame, batch: int, start: int) -> tuple[DataFrame, Manifest]:
        """The first k receivers after a batch, and the state to publish."""
        store, name = self.store, self.store.name_of(start, batch)
        before = store.before(batch, name)
        run = store.write(store.bucketed(changed), name)
        fresh, old = store.read([run]), self.leaders(before)
        now = Manifest(name, batch, [*before.runs, run])
        # at most k leaders a bucket
        moved = fresh.alias("n").join(F.broadcast(old.alias("o")), "receiving_address")
        fell = [r[0] for r in moved.where("n.amount < o.amount").select("n.bucket").distinct().collect()]
        rest = old.join(fresh.select("receiving_address"), "receiving_address", "left_anti")
        candidates = rest.unionByName(fresh)
        if fell:
            candidates = candidates.where(~F.col("bucket").isin(fell))
            candidates = candidates.unionByName(_newest(store.read(now.runs, fell)))
        place = F.row_number().over(Window.partitionBy("bucket").orderBy(*receiver_order()))
        first = candidates.withColumn("place", place).where(F.col("place") <= self.k).drop("place")
        first.select(*store.stored.names).write.mode("overwrite").parquet(f"{self.path}/leaders/{name}")
        return top_k(self.leaders(now).drop("bucket"), receiver_order(), self.k), now

    def publish(self, manifest: Manifest) -> None:
        self.store.publish(manifest)
        kept = set(documents(self.store.manifests))
        for folder in folders(f"{self.path}/leaders"):
            if folder not in kept:
                remove_folder(f"{self.path}/leaders", folder)

    def latest(self) -> DataFrame:
        """The latest sale of every receiver, as of the newest published batch."""
        manifest = self.store.newest()
        return _newest(self.store.read(manifest.runs if manifest else [])).drop("bucket")


def start_top_receivers(
    cleaned: DataFrame,
    path: str,
    checkpoint: str,
    k: int = 3,
    buckets: int = 32,
    state_partitions: int | None = None,
    **trigger: object,
) -> StreamingQuery | Drain:
    """Keep the receivers with the largest latest sale current in `path`.

    `cleaned` may hold copies: `valid_rows` is enough. Update mode: a batch gets the receivers
    that changed and nothing else. `path` also keeps the latest sale of every receiver.
    """
    spark = cleaned.sparkSession
    state = Leaders(spark, f"{path}/state", k, buckets)
    start = max(state.store.next_start(), next_start(path))

    def store(batch: DataFrame, batch_id: int) -> None:
        leaders, manifest = state.merge(batch, batch_id, start)
        write_version(leaders, path, start, batch_id)
        state.publish(manifest)

    with stream_settings(spark, state_partitions):
        writer = changed_sales(cleaned).writeStream.outputMode("update").foreachBatch(store)
        return started(writer.option("checkpointLocation", checkpoint), **trigger)


def read_latest_sales(spark: SparkSession, path: str) -> DataFrame:
    """The latest sale of every receiver that `start_top_receivers` has seen."""
    return Leaders(spark, f"{path}/state", 1, 1).latest()
