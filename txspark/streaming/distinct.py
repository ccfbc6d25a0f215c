"""Exact deduplication of a stream by sorted runs in shared storage instead of state.

Every distinct row of a stream stays known, however old it is, so memory must not hold the
keys. A batch drops its own copies, asks the Bloom filters of all runs for the rest, looks up
what a filter lets through in the sorted run, and adds what is new as a run. A task holds the
keys of one bucket of the batch and one filter at a time; what the stream has seen lies in
storage only. Rows may arrive in any order of time; none is lost as late or counted twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txspark.functions.rowkey import row_key
from txspark.functions.sqltext import ident
from txspark.plans.tables import region_order
from txspark.sinks.publish import documents, folders, get_document, put_document, remove_folder
from txspark.streaming.live import Drain, next_start, started, write_version
from txspark.streaming.runs import Manifest, RunStore

KEY = "row_key"


def _key_name(schema: T.StructType) -> str:
    name = KEY
    while name in schema.names:
        name = f"_{name}"
    return name


class DistinctRows:
    """The distinct rows of a stream, in runs with filters."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, buckets: int = 32, fan: int = 4) -> None:
        self.spark, self.path, self.rows = spark, path.rstrip("/"), schema
        self.key = _key_name(schema)
        # columns may be missing in a batch's rows, never in what is stored
        stored = T.StructType([T.StructField(f.name, f.dataType) for f in schema] + [T.StructField(self.key, T.BinaryType())])
        self.store = RunStore(spark, path, stored, self.key, None, buckets, fan, filters=True)

    def add(self, batch: DataFrame, number: int, start: int) -> tuple[DataFrame, Manifest]:
        """The rows of a batch that were never seen before, and the state to publish."""
        store, name = self.store, self.store.name_of(start, number)
        before = store.before(number, name)
        keyed = batch.withColumn(self.key, row_key(batch.schema)).dropDuplicates([self.key])
        arrived = f"{self.path}/arrived"
        # written once: the look-up and the run read it, and the batch is not computed again
        store.bucketed(keyed).write.mode("overwrite").parquet(f"{arrived}/{name}")
        rows = self.spark.read.schema(store.stored).parquet(f"{arrived}/{name}")
        key = ident(self.key)
        if any(r.rows for r in before.runs):
            fresh = store.unseen(rows.select(key, "bucket"), before.runs)
            rows = rows.join(fresh.select(key), self.key, "left_semi").select(*store.stored.names)
        run = store.write(rows, name)
        remove_folder(arrived, name)
        return self._plain(store.read([run])), Manifest(name, number, [*before.runs, run])

    def _plain(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(ident(n)) for n in self.rows.names])

    def read(self) -> DataFrame:
        """All distinct rows, as of the newest published batch."""
        manifest = self.store.newest()
        return self._plain(self.store.read(manifest.runs if manifest else []))


def start_distinct(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    then: Callable[[DataFrame, str, str], None] | None = None,
    buckets: int = 32,
    **trigger: object,
) -> StreamingQuery | Drain:
    """Keep the distinct rows of a stream in `path`; `read_distinct` reads them.

    then(new rows, name of the state before, name of the new one) runs before a batch counts, and
    again where a batch is repeated: it must leave the same when it runs twice. The state
    before a first batch has no name.
    """
    state = DistinctRows(rows.sparkSession, path, rows.schema, buckets)
    put_document(path, "schema", {"rows": rows.schema.json(), "buckets": buckets})
    start = max(state.store.next_start(), next_start(path))

    def store(batch: DataFrame, number: int) -> None:
        fresh, manifest = state.add(batch, number, start)
        if then:
            then(fresh, state.store.before(number, manifest.name).name, manifest.name)
        state.store.publish(manifest)

    writer = rows.writeStream.outputMode("append").foreachBatch(store)
    return started(writer.option("checkpointLocation", checkpoint), **trigger)


def read_distinct(spark: SparkSession, path: str) -> DataFrame:
    """The distinct rows that `start_distinct` keeps in `path`."""
    schema = T.StructType.fromJson(json.loads(get_document(path, "schema")["rows"]))
    return DistinctRows(spark, path, schema).read()


SUMS = "location_region string, total double, rated bigint, transaction_count bigint"


def start_region_risk(
    valid: DataFrame, path: str, checkpoint: str, buckets: int = 32, **trigger: object
) -> StreamingQuery | Drain:
    """Keep the regions by mean risk current in `path`; `live.read_table` reads the table.

    `valid` may hold copies (`valid_rows`): a row counts when it is seen first. Sums of each
    region are carried from batch to batch.
    """
    spark, sums = valid.sparkSession, f"{path}/sums"

    def then(fresh: DataFrame, before: str, now: str) -> None:
        own = fresh.groupBy("location_region").agg(
            F.sum("risk_score").alias("total"),
            F.count("risk_score").alias("rated"),
            F.count(F.lit(1)).alias("transaction_count"),
        )
        if before:
            own = own.unionByName(spark.read.schema(SUMS).parquet(f"{sums}/{before}"))
        added = [F.sum(c).alias(c) for c in ("total", "rated", "transaction_count")]
        own.groupBy("location_region").agg(*added).coalesce(1).write.mode("overwrite").parquet(f"{sums}/{now}")
        table = spark.read.schema(SUMS).parquet(f"{sums}/{now}").select(
            "location_region", F.round(F.col("total") / F.col("rated"), 6).alias("avg_risk_score"), "transaction_count"
        )
        start, batch = map(int, now.split("-"))
        write_version(table.orderBy(*region_order()), path, start, batch)
        for folder in folders(sums):
            if folder not in (before, now, *documents(f"{path}/manifests")):
                remove_folder(sums, folder)

    return start_distinct(valid, path, checkpoint, then, buckets, **trigger)
